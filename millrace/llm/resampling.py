"""Importance resampling towards a target: hashed features, a weight per document, an exact draw of the best scores.

``bucket_counts`` hashes the features of whole texts (all runs of 1 to ``longest`` consecutive words) into ``BUCKETS``
buckets and adds them up in an array per task. A bucket's gain is the logarithm of how much more common it is in the
target than in the documents; the gains are one array of fixed length, which ``weights`` looks a document's buckets up
in. ``scores`` adds noise that depends on the document's number only, so that the highest scores are a draw without
replacement in proportion to the weights, and writes them.

``draw`` finds the cutoff by bisection: every round counts exactly how many of the written scores reach some thresholds
between the bounds, and halves the bounds ``ROUND`` times at once. Among documents that have the score of the cutoff,
the same rounds over ``doc_id`` find the last one drawn. What is drawn is dealt by ranges, numbered within them, and
gets its rank from the sizes of the ranges before. No round moves or sorts rows, and nothing reaches the driver but
counts per threshold, per bucket and per range.

Defined cases: null and empty texts have no features and the weight 0; a row without ``doc_id`` has no noise, hence no
score, and is neither counted nor drawn; equal rows are drawn each, rows with the same score and ``doc_id`` by fewer
features first; an empty table gives no rows, an empty target gains from smoothing alone; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import flat
from millrace.llm.spans import crc32, spans
from millrace.llm.tables import discard, written

BUCKETS = 10_000
LONGEST = 1
#: Words of a document that may be drawn, at least; percent of such documents that are drawn.
LEAST_WORDS, PERCENT = 20, 10
SEED = "2024"
#: Times that one counting job halves the bounds.
ROUND = 5

# The bytes of words are digits, letters from a to z and all beyond ASCII.
_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[0x30:0x3A] = True
_INSIDE[0x61:0x7B] = True
_INSIDE[0x80:] = True

_SPACE = 0x20


def features(column: pa.Array, buckets: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buckets of all features, ordered by text, for each text the features before it (one more), and its words."""
    data, offsets = flat.texts(column)
    data = flat.LOWER[data]
    starts, ends, first = spans(_INSIDE[data], offsets)
    n_words = np.diff(first)
    if longest == 1:
        return (crc32(data, starts, ends) % np.uint32(buckets)).astype(np.int64), first, n_words
    size = ends - starts
    at = np.concatenate([[0], np.cumsum(size + 1)])  # words one after the other, each with a space behind it
    joined = np.full(at[-1], _SPACE, dtype=np.uint8)
    joined[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = data[_INSIDE[data]]
    begin, stop, owner = at[:-1], at[:-1] + size, flat.owners(first)
    found, text = [], []
    for n in range(1, longest + 1):
        heads = np.flatnonzero(np.arange(len(owner)) + n <= first[owner + 1])
        found.append(crc32(joined, begin[heads], stop[heads + n - 1]) % np.uint32(buckets))
        text.append(owner[heads])
    owner = np.concatenate(text)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(found)[order].astype(np.int64), np.searchsorted(owner[order], np.arange(len(offsets))), n_words


def _bucketed(buckets: int, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for part in flat.pieces(batch, "text"):
                total += np.bincount(features(part.column("text"), buckets, longest)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Features per bucket of all texts, an array of fixed length."""
    counted = texts.select("text").mapInArrow(_bucketed(buckets, longest), "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():  # one row per bucket at most
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the smoothed log-ratio of each bucket's shares in target and source, rounded down."""
    buckets = len(source)
    in_source, in_target = float(int(source.sum()) + buckets), float(int(target.sum()) + buckets)
    pairs = zip(target.tolist(), source.tolist())
    ratios = [(t + 1.0) * in_source / ((s + 1.0) * in_target) for t, s in pairs]
    return np.array([math.floor(1000 * math.log(x)) for x in ratios], dtype=np.int64)


def _weighed(gain: np.ndarray, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in flat.pieces(batch, "text"):
                found, first, words = features(part.column("text"), len(gain), longest)
                columns = [part.column("doc_id"), *map(pa.array, (np.diff(first), words, flat.sums(gain[found], first)))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_features", "n_words", "weight"])

    return run


def weights(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST) -> DataFrame:
    wanted = docs.select(F.col("doc_id").cast("long"), "text")
    return wanted.mapInArrow(_weighed(gain, longest), "doc_id long, n_features long, n_words long, weight long")


def noise(seed: str) -> Column:
    """A draw from the Gumbel distribution in thousandths, rounded down, which ``doc_id`` alone decides."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def scores(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, seed: str = SEED) -> DataFrame:
    """A written table of features, words, weight and score, with a number ``at`` for each row."""
    gain = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    scored = weights(docs, gain, longest).withColumn("score", (F.col("weight") + noise(seed)).cast("long"))
    return written(scored.withColumn("at", F.monotonically_increasing_id()), "scores")


def _least_reaching(rows: DataFrame, key: Column, wanted: int) -> int:
    """The least value that ``wanted`` rows do not exceed, by counting rows up to thresholds; there are that many rows."""
    low, high = rows.agg(F.min(key), F.max(key)).first()
    while low < high:
        # all halvings of the bounds that ROUND rounds could come to
        steps = min(high - low, (1 << ROUND) - 1)
        between = sorted({low + (high - low) * k // (steps + 1) for k in range(1, steps + 1)} - {high})
        counts = rows.agg(*[F.count_if(key <= F.lit(x)).alias(f"n{k}") for k, x in enumerate(between)]).first()
        reached = [x for x, n in zip(between, counts) if n >= wanted]
        short = [x for x, n in zip(between, counts) if n < wanted]
        low, high = (short[-1] + 1 if short else low), (reached[0] if reached else high)
    return low


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    part, n = (context.partitionId() if context else 0), 0
    for batch in batches:
        count = batch.num_rows
        columns = [*batch.columns, pa.array(np.full(count, part, dtype=np.int32)), pa.array(np.arange(n, n + count))]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "part", "number"])
        n += count


#: A total order of the rows.
_ORDER = (F.desc, "score"), (F.asc, "doc_id"), (F.asc, "n_features"), (F.asc, "at")


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with their ``rank`` from 1, by range partitions and the numbers of rows in those before."""
    order = [by(name) for by, name in _ORDER]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    fields = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    placed = written(dealt.mapInArrow(_numbered, f"{fields}, part int, number long"), "ranges")
    before, sizes = {}, sorted(map(tuple, placed.groupBy("part").count().collect()))  # one row per range
    total = 0
    for part, n in sizes:
        before[part], total = total, total + n
    spark = rows.sparkSession
    starts = spark.createDataFrame(sorted(before.items()), "part int, before long")
    return placed.join(starts, "part").withColumn("rank", F.col("before") + F.col("number") + 1).drop("part", "number", "before")


def draw(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """All rows of :func:`scores`, with a ``rank`` for the drawn ones."""
    usable = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    fit = scored.filter(usable)
    wanted = fit.count() * percent // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return scored.select(*columns, none)
    cut = -_least_reaching(fit, -F.col("score"), wanted)
    tied = fit.filter(F.col("score") == cut)
    last = _least_reaching(tied, F.col("doc_id"), wanted - fit.filter(F.col("score") > cut).count())
    chosen = usable & ((F.col("score") > cut) | ((F.col("score") == cut) & (F.col("doc_id") <= last)))
    placed = ranked(scored.filter(chosen))
    rank = F.when(F.col("rank") <= wanted, F.col("rank"))  # rows that repeat the last doc_id may be too many
    rest = scored.filter(~F.coalesce(chosen, F.lit(False)))
    return placed.select(*columns, rank.alias("rank")).unionAll(rest.select(*columns, none))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS,
             longest: int = LONGEST, seed: str = SEED) -> DataFrame:
    """Per document its features, weight, score and, if it is drawn, its rank."""
    return draw(scores(docs, target, buckets, longest, seed), percent, least_words)
