"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are split into halves with a codebook each, fitted on a bounded sample; the product of the codebooks is a
grid of cells. Every vector is listed in the cell of its nearest centroids. A query's distance to the border of another
centroid's region bounds from below how far a half must move to get there; the sum of the squares over the halves
orders the cells. The traversal takes both sorted sequences and visits cells in a staircase until ``reach``, the sum
that finds the target share of true links. ``reach`` is measured: a bounded set of queries is compared with all rows.
No link needs more than 2 - 2 cosine, so that a target of 1 is exact. Visited cells are verified in double precision.

Equal vectors are one row with a weight. Cells and their queries are split into blocks of ``BLOCK`` rows, and every
pair of blocks is one bounded group that yields counts and a spanning forest, never pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows without ``vec_id``,
link with nothing (the latter have no component and are kept); vectors of different lengths link with nothing; rows
that repeat a ``vec_id`` and its vector count once and get equal results; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.groups import changes, whole_groups
from millrace.llm.tables import discard, written

COSINE = 0.95
#: Rows the codebooks are fitted on, and rows compared with all others to measure recall.
SAMPLE_ROWS = 10_000
PROBE_ROWS = 256
TARGET_RECALL = 0.99999
#: The reach is at least this share of what no link exceeds, as probes do not see the rarest links.
LEAST_REACH = 0.05
#: Vectors per cell aimed at, and most centroids in a codebook.
PER_CELL = 256
MOST_CENTROIDS = 1024
BLOCK = 8192
_STEP = 512


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("vector")
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        at = np.concatenate([[0], np.cumsum(sizes)])
        units = []
        for lo, hi in zip(at[:-1], at[1:]):
            v = values[lo:hi] / np.abs(values[lo:hi]).max()  # squares must not overflow
            units.append((v / np.sqrt(v @ v) + 0.0).tobytes())  # + 0.0: one zero
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes), pa.array(units, pa.binary())], ["id", "dim", "unit"])


def _matrix(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(-1, dim)


def _centroids(points: np.ndarray, k: int) -> np.ndarray:
    """k-means by Lloyd's iterations; a centroid that loses all its points stays where it is."""
    distinct = np.unique(points, axis=0)
    k = min(k, len(distinct))
    centres = distinct[np.random.default_rng(3).choice(len(distinct), k, replace=False)].copy()
    for _ in range(12):
        nearest = ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)
        count = np.bincount(nearest, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, nearest, points)
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return centres


@dataclass(frozen=True)
class Codebooks:
    left: np.ndarray
    right: np.ndarray
    reach: float = np.inf

    @property
    def cells(self) -> int:
        return len(self.left) * len(self.right)

    @cached_property
    def apart(self) -> tuple[np.ndarray, np.ndarray]:
        """Distances between the centroids of either half, computed once in a worker."""
        out = []
        for centres in (self.left, self.right):
            norms = (centres**2).sum(axis=1)
            out.append(np.sqrt(np.maximum(norms[:, None] + norms - 2 * centres @ centres.T, 0)))
        return out[0], out[1]

    @staticmethod
    def _costs(points: np.ndarray, centres: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid, and the squared distance to the border of every centroid's region."""
        far = (points**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1) - 2 * points @ centres.T
        own = far.argmin(axis=1)
        apart = apart[own]
        gain = far - far[np.arange(len(points)), own][:, None]
        border = np.divide(gain, 2 * apart, out=np.zeros_like(gain), where=apart > 0)
        return own, np.maximum(border, 0) ** 2

    def costs(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        half = units.shape[1] // 2
        a, left = self._costs(units[:, :half], self.left, self.apart[0])
        b, right = self._costs(units[:, half:], self.right, self.apart[1])
        return a * len(self.right) + b, left, right

    def reaches(self, left: np.ndarray, right: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Rows by cells: whether the traversal of a row visits the cell."""
        a, b = np.divmod(cells, len(self.right))
        return left[:, a] + right[:, b] <= self.reach

    def visits(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and the cells they visit, by the staircase under ``reach`` over both sorted sequences."""
        by_left, by_right = left.argsort(axis=1, kind="stable"), right.argsort(axis=1, kind="stable")
        left, right = np.take_along_axis(left, by_left, 1), np.take_along_axis(right, by_right, 1)
        rows, cells = [], []
        for step in range(left.shape[1]):
            rest = self.reach - left[:, step]
            active = np.flatnonzero(rest >= right[:, 0])
            if not len(active):
                break
            deep = (right[active] <= rest[active, None]).sum(axis=1)
            row = np.repeat(active, deep)
            inner = np.arange(len(row)) - np.repeat(np.cumsum(deep) - deep, deep)
            rows.append(row)
            cells.append(by_left[row, step] * right.shape[1] + by_right[row, inner])
        return np.concatenate(rows), np.concatenate(cells)


def _measured(books: Codebooks, probes: np.ndarray, cosine: float, levels: int = 256):
    """How many links of the probes each level of ``reach`` is needed for; one row per task and level."""
    _, left, right = books.costs(probes)
    most = 2 - 2 * cosine

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(levels + 1, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            units = _matrix(batch.column("unit"), probes.shape[1])
            cell = books.costs(units)[0]
            a, b = np.divmod(cell, len(books.right))
            for at in range(0, len(probes), _STEP):
                row, col = np.nonzero(probes[at : at + _STEP] @ units.T >= cosine)
                cost = left[at + row, a[col]] + right[at + row, b[col]]
                counts += np.bincount(np.minimum(np.ceil(cost / most * levels), levels).astype(np.int64), minlength=levels + 1)
        yield pa.RecordBatch.from_pydict({"level": np.arange(levels + 1), "n": counts})

    return run


def fit(units: DataFrame, dim: int, rows: int, cosine: float, target: float) -> Codebooks:
    """Codebooks, and the reach that finds ``target`` of the links of the probes (1: the reach no link exceeds)."""
    sample = _matrix(units.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("unit").toArrow().column("unit"), dim)
    k = int(np.clip(round((rows / PER_CELL) ** 0.5), 1, MOST_CENTROIDS))
    books = Codebooks(_centroids(sample[:, : dim // 2], k), _centroids(sample[:, dim // 2 :], k))
    if target >= 1:
        return Codebooks(books.left, books.right, 2 - 2 * cosine + 1e-9)
    counts = units.mapInArrow(_measured(books, sample[:PROBE_ROWS], cosine), "level long, n long")
    table = counts.groupBy("level").agg(F.sum("n").alias("n")).orderBy("level").toArrow()
    found = np.cumsum(table.column("n").to_numpy())
    share = np.searchsorted(found, target * found[-1]) / (len(found) - 1)
    return Codebooks(books.left, books.right, (2 - 2 * cosine) * max(share, LEAST_REACH) + 1e-9)


def _listed(books: Codebooks, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = books.costs(_matrix(batch.column("unit"), dim))[0]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], ["id", "unit", "weight", "cell"])

    return run


def _visiting(books: Codebooks, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                _, left, right = books.costs(_matrix(part.column("unit"), dim))
                rows, cells = books.visits(left, right)
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(rows)), pa.array(cells)], ["id", "visited"])

    return run


def _forest(linked: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For all ids in a bipartite graph the least id of their component."""
    low_x, low_y = x.copy(), y.copy()
    most = np.iinfo(np.int64).max
    while True:
        new_y = np.minimum(low_y, np.where(linked, low_x[:, None], most).min(axis=0))
        new_x = np.minimum(low_x, np.where(linked, new_y[None, :], most).min(axis=1))
        if (new_x == low_x).all() and (new_y == low_y).all():
            return low_x, low_y
        low_x, low_y = new_x, new_y


def _verified(books: Codebooks, dim: int, cosine: float):
    """Links of one block of a cell with one block of its queries: counts per vector and forest edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["visited", "block", "q_block"]
        for table in whole_groups(batches, keys):
            heads = changes(table, keys)
            asks, ids, weights, cells = (table.column(c).to_numpy() for c in ("asks", "id", "weight", "cell"))
            units = table.column("unit")
            for lo, hi in zip(heads, [*heads[1:], table.num_rows]):
                listed, asking = np.flatnonzero(~asks[lo:hi]) + lo, np.flatnonzero(asks[lo:hi]) + lo
                if not len(listed) or not len(asking):
                    continue
                y = _matrix(units.take(pa.array(listed)), dim)
                _, left, right = books.costs(y)
                for at in range(0, len(asking), _STEP):
                    q = asking[at : at + _STEP]
                    x = _matrix(units.take(pa.array(q)), dim)
                    linked = (x @ y.T >= cosine) & (ids[q][:, None] != ids[listed][None, :])
                    if not linked.any():
                        continue
                    back = books.reaches(left, right, cells[q]).T  # the link is found from the other side, too
                    low_x, low_y = _forest(linked, ids[q], ids[listed])
                    out = [
                        (ids[q], linked @ weights[listed], low_x),
                        (ids[listed], (linked & ~back).T @ weights[q], low_y),
                    ]
                    for node, links, low in out:
                        some = (links > 0) | (low != node)
                        yield pa.RecordBatch.from_pydict({"id": node[some], "links": links[some].astype(np.int64), "low": low[some]})

    return run


def _links(units: DataFrame, dim: int, rows: int, cosine: float, target: float) -> DataFrame:
    """``id``, ``links``, ``low``: partial counts of links, and edges to the least vector of a block's component."""
    books = fit(units, dim, rows, cosine, target)
    listed = written(units.mapInArrow(_listed(books, dim), "id long, unit binary, weight long, cell long"), "cells")
    visits = written(listed.select("id", "unit").mapInArrow(_visiting(books, dim), "id long, visited long"), "visits")

    def blocks(df: DataFrame, cell: str, name: str) -> DataFrame:
        # at most as many rows as there are cells; whether that is few, the engine finds out
        return df.groupBy(F.col(cell).alias("of")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))

    of_cell, of_queries = blocks(listed, "cell", "n_blocks"), blocks(visits, "visited", "q_blocks")
    # Every vector visits its own cell, so that each listed cell has queries; cells without vectors are left out.
    asking = visits.join(of_cell, F.col("visited") == F.col("of")).drop("of").join(of_queries, F.col("visited") == F.col("of"))
    block = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block")
    mine = F.pmod(F.xxhash64("id"), F.col("q_blocks")).cast("int").alias("q_block")
    asking = asking.select("id", "visited", block, mine, F.lit(True).alias("asks")).join(listed, "id")
    told = listed.join(of_cell, F.col("cell") == F.col("of")).drop("of").join(of_queries, F.col("cell") == F.col("of"))
    block = F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)).alias("q_block")
    mine = F.pmod(F.xxhash64("id"), F.col("n_blocks")).cast("int").alias("block")
    told = told.select("id", F.col("cell").alias("visited"), mine, block, F.lit(False).alias("asks"), "unit", "weight", "cell")
    keys = ["visited", "block", "q_block"]
    both = told.unionByName(asking.select(told.columns)).repartition(*keys).sortWithinPartitions(*keys)
    found = written(both.mapInArrow(_verified(books, dim, cosine), "id long, links long, low long"), "links")
    discard(listed, visits)
    return found


def near_vectors(vectors: DataFrame, cosine: float = COSINE, target: float = TARGET_RECALL) -> DataFrame:
    """Per vector the number of others at ``cosine`` or more, its component's least ``vec_id``, and whether it is that."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    usable = rows.filter(F.col("vec_id").isNotNull() & sound & F.exists("vector", lambda x: x != 0))
    usable = usable.select(F.col("vec_id").alias("id"), "vector").mapInArrow(_unit, "id long, dim long, unit binary")
    units = written(usable.distinct(), "units")
    classes = units.groupBy("dim", "unit").agg(F.min("id").alias("rep"), F.countDistinct("id").alias("weight"))
    classes = written(classes, "classes")
    counts, edges = None, None
    for dim, n in sorted(tuple(row) for row in classes.groupBy("dim").count().collect()):  # lengths of vectors: few
        one = classes.filter(F.col("dim") == dim).select(F.col("rep").alias("id"), "unit", "weight")
        found = _links(one, dim, n, cosine, target)
        count = found.groupBy("id").agg(F.sum("links").alias("links"))
        edge = found.filter("id != low").select(F.col("id").alias("a"), F.col("low").alias("b"))
        counts, edges = (count, edge) if counts is None else (counts.union(count), edges.union(edge))
    if counts is None:
        out = [F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")]
        return rows.select("vec_id", *out)
    parts = components(edges)
    of_rep = classes.join(counts, F.col("rep") == F.col("id"), "left").drop("id").join(parts, F.col("rep") == F.col("node"), "left")
    of_rep = of_rep.select(
        "dim", "unit", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("low")
    )
    by_id = units.join(of_rep, ["dim", "unit"]).groupBy("id").agg(F.max("n_links").alias("n_links"), F.min("low").alias("low"))
    joined = rows.select("vec_id").join(by_id, F.col("vec_id") == F.col("id"), "left")
    component = F.coalesce("low", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )
