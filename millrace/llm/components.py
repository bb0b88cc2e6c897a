"""Connected components of a graph given by its edges, by alternating large and small stars.

Each round joins edges with the least neighbour of their ends; minima are combined map-side and the joins can be split
by the engine where one node has a large share of all edges. Rounds are written tables, so that a lost executor costs
one round at most, and their number grows with the logarithm of the longest path. Nothing reaches the driver but two
numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import discard, written


def _large(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("of"), F.least("u", "m").alias("m"))
    tied = both.filter("v > u").join(least, F.col("u") == F.col("of"))
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """A node and all its neighbours, which are below it, are tied to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    of = least.select(F.col("u").alias("of"), "m")
    tied = edges.join(of, F.col("u") == F.col("of")).filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, its least reachable node, for each node but the least of its component.

    Edges with a null end and loops are no edges; an empty table gives no rows.
    """
    ends = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    )
    now = written(ends.distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if state == before or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before, last = state, now
        now = written(_small(_large(last).distinct()).distinct(), "stars")
        discard(last)
