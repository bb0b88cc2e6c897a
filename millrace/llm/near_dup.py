"""Near-duplicate documents by MinHash: one permutation, optimal densification, bands, star-shaped candidates.

A document is the set of its distinct five-word shingles. ``sketches`` hashes whole texts in their Arrow batch: the
top bits of a shingle's hash choose one of ``BINS`` bins, the least hash of a bin is its value, and an empty bin copies
a filled one found by its own fixed probing order. Documents with equal sets form a class, told by a 128-bit sum over
the set, so that copies travel as one row from there on. ``ROWS`` bins make a band; in each bucket of a band every
class is paired with the least one only, which bounds pairs by the number of bands. Pairs are confirmed on the full
sets. A star can miss a pair of two members of different components; ``_missed`` compares just those, within the
mixed buckets, which it parts by further bands and into blocks of bounded size, each pair in the first band that it agrees in, so that the bound on pairs
costs no link.

At a similarity of 0.75 a pair shares no bucket with a probability of (1 - 0.75^5)^51, about one in a million.

Defined cases: null or empty text has no shingles and is linked with nothing; with fewer than five words the whole
sequence is the one shingle; a row without ``doc_id`` is linked with nothing, its component is null and it is kept;
rows are told by their sets, so that rows that repeat a ``doc_id`` are linked each by its own text, and every row is
returned once; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import flat
from millrace.llm.components import components
from millrace.llm.groups import changes, whole_groups
from millrace.llm.tables import discard, written

SHINGLE = 5
PERCENT = 75
BINS = 256
ROWS = 5
BANDS = BINS // ROWS
#: Rows of a mixed bucket that are compared with each other at once.
BLOCK = 500

#: Rows of a mixed bucket from which it is parted by the other bands, which takes a copy of each row for each of them;
#: up to here blocks take fewer.
CROWD = BLOCK * BANDS

_BIN_BITS = BINS.bit_length() - 1
_PROBES = np.random.default_rng(11).integers(0, BINS, (4096, BINS))


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, and for each text the number before it (one more)."""
    data = flat.LOWER[data]
    starts, ends, first = flat.words(data, offsets)
    words = flat.hashes(data, starts, ends)
    runs, at = flat.runs(words, first, SHINGLE)
    owner = flat.owners(first)
    keys, texts = [runs], [owner[at]]
    sizes = np.diff(first)
    for n in range(1, SHINGLE):
        few = np.flatnonzero(sizes == n)
        if len(few):
            whole = sum(flat.mix(words[first[few] + k] + np.uint64(k + 1)) * np.uint64(2 * n + 1) for k in range(n))
            keys.append(flat.mix(whole))
            texts.append(few)
    key, text = np.concatenate(keys), np.concatenate(texts)
    order = np.lexsort((key, text))
    key, text = key[order], text[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    return key[new], np.searchsorted(text[new], np.arange(len(offsets)))


def densified(keys: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One 16-bit value per text and bin; rows of texts without shingles are zero."""
    n = len(first) - 1
    owner = flat.owners(first)
    slot = owner * BINS + (keys >> np.uint64(64 - _BIN_BITS)).astype(np.int64)
    head = np.ones(len(slot), dtype=bool)
    head[1:] = slot[1:] != slot[:-1]
    values = np.zeros((n, BINS), dtype=np.uint16)
    filled = np.zeros((n, BINS), dtype=bool)
    values.ravel()[slot[head]] = (keys[head] & np.uint64(0xFFFF)).astype(np.uint16)
    filled.ravel()[slot[head]] = True
    text, empty = np.nonzero(~filled & (np.diff(first) > 0)[:, None])
    for probe in _PROBES:
        if not len(text):
            break
        source = probe[empty]
        hit = filled[text, source]
        values[text[hit], empty[hit]] = values[text[hit], source[hit]]
        text, empty = text[~hit], empty[~hit]
    if len(text):
        values[text, empty] = values[text, filled[text].argmax(axis=1)]
    return values


#: What tells a set: two sums of 64 bits over its shingles.
_SALTS = (0x5851F42D4C957F2D, 0x14057B7EF767814F)


def _total(keys: np.ndarray, first: np.ndarray, salt: int) -> np.ndarray:
    sums = np.zeros(len(keys) + 1, dtype=np.uint64)
    np.cumsum(flat.mix(keys ^ np.uint64(salt)), out=sums[1:])
    return (sums[first[1:]] - sums[first[:-1]]).view(np.int64)


def _rows(matrix: np.ndarray) -> pa.Array:
    """Each row of a matrix as bytes."""
    width = matrix.shape[1] * matrix.itemsize
    places = np.arange(len(matrix) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(matrix))])


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in flat.pieces(batch, "text"):
            keys, first = shingles(*flat.texts(part.column("text")))
            columns = [
                part.column("doc_id"),
                pa.array(np.diff(first)),
                *(pa.array(_total(keys, first, salt)) for salt in _SALTS),
                _rows(densified(keys, first)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "k1", "k2", "sketch"])


def sketches(docs: DataFrame) -> DataFrame:
    wanted = docs.select(F.col("doc_id").cast("long"), "text")
    return wanted.mapInArrow(_sketched, "doc_id long, n_shingles long, k1 long, k2 long, sketch binary")


def _values(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, BINS)


def _band_keys(values: np.ndarray) -> Iterator[np.ndarray]:
    """For each band the hash of its bins, one per row."""
    for band in range(BANDS):
        key = np.full(len(values), band + 1, dtype=np.uint64)
        for k in range(ROWS):
            key = flat.mix(key * np.uint64(0x9E3779B97F4A7C15) + values[:, band * ROWS + k])
        yield key


def _of_band(key: np.ndarray, band) -> pa.Array:
    """Buckets that tell their band."""
    return pa.array(((key & ~np.uint64(63)) | np.uint64(band)).view(np.int64))


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        for band, key in enumerate(_band_keys(_values(batch.column("sketch")).astype(np.uint64))):
            yield pa.RecordBatch.from_arrays([_of_band(key, band), batch.column("cls")], ["bucket", "doc"])


def _refined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a bucket once for each other band, in the buckets of that band within theirs."""
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket = batch.column("bucket").to_numpy().view(np.uint64)
        own = bucket & np.uint64(63)
        for band, key in enumerate(_band_keys(_values(batch.column("sketch")).astype(np.uint64))):
            other = own != band
            finer = flat.mix(bucket * np.uint64(0xD6E8FEB86659FD93) + key)
            rows = batch.select(["doc", "comp"]).filter(pa.array(other))
            yield pa.RecordBatch.from_arrays([_of_band(finer[other], own[other]), *rows.columns], ["bucket", "doc", "comp"])


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of texts that are those of the classes they are fetched for."""
    for batch in batches:
        for part in flat.pieces(batch, "text"):
            keys, first = shingles(*flat.texts(part.column("text")))
            held = pa.Array.from_buffers(
                pa.large_binary(), part.num_rows, [None, pa.py_buffer(first * 8), pa.py_buffer(np.ascontiguousarray(keys))]
            )
            wanted = np.diff(first) == part.column("n_shingles").to_numpy()
            for salt, name in zip(_SALTS, ("k1", "k2")):
                wanted &= _total(keys, first, salt) == part.column(name).to_numpy()
            rows = pa.RecordBatch.from_arrays([part.column("cls"), held.cast(pa.binary())], ["of", "shingles"])
            yield rows.filter(pa.array(wanted))


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hits = []
        for i, (one, other) in enumerate(zip(batch.column("one"), batch.column("other"))):
            x, y = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(other.as_buffer(), np.uint64)
            if len(x) > len(y):
                x, y = y, x
            if 100 * len(x) < PERCENT * len(y):
                continue
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            shared = int((y[at] == x).sum())
            if 100 * shared >= PERCENT * (len(x) + len(y) - shared):
                hits.append(i)
        yield batch.take(pa.array(hits, pa.int64())).select(["a", "b"])


def shingle_sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame, repeated: bool) -> DataFrame:
    """The full sets of the classes in ``pairs``, from the texts of their least documents; ``repeated`` if rows repeat a
    ``doc_id``.

    Their number follows the corpus, so that the join never is a broadcast.
    """
    ends = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    wanted = classes.join(ends, F.col("cls") == F.col("id"), "left_semi").select("cls", "rep", "k1", "k2", "n_shingles").hint("merge")
    held = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(wanted, F.col("id") == F.col("rep"))
    sets = held.mapInArrow(_set_rows, "of long, shingles binary")
    return sets.dropDuplicates(["of"]) if repeated else sets


def confirm(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those pairs (``a``, ``b``) whose full sets are similar enough.

    The shingles of ``a`` travel to ``b``. Where many pairs share ``b``, as in a star, the engine may split that join.
    """
    one = pairs.join(sets.select(F.col("of").alias("a"), F.col("shingles").alias("one")), "a")
    both = one.join(sets.select(F.col("of").alias("b"), F.col("shingles").alias("other")), "b")
    return both.select("a", "b", "one", "other").mapInArrow(_confirmed, "a long, b long").distinct()


_GROUP = ["bucket", "i", "j"]


def _promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a group that have a partner in another component whom their sketches do not rule out."""
    for table in whole_groups(batches, _GROUP):
        begins = changes(table, _GROUP)
        names = ("bucket", "doc", "comp", "n_shingles", "block", "i", "j")
        bucket, doc, comp, size, block, i, j = (table.column(c).to_numpy() for c in names)
        values = _values(table.column("sketch"))
        chosen = np.zeros(table.num_rows, dtype=bool)
        for lo, hi in zip(begins, [*begins[1:], table.num_rows]):
            left = np.flatnonzero(block[lo:hi] == i[lo]) + lo
            right = np.flatnonzero(block[lo:hi] == j[lo]) + lo
            for x in left:
                y = right[comp[right] != comp[x]]
                small, large = np.minimum(size[y], size[x]), np.maximum(size[y], size[x])
                y, small = y[100 * small >= PERCENT * large], small[100 * small >= PERCENT * large]
                if not len(y):
                    continue
                # four standard deviations below the threshold, where the bins hold the less distinct elements the wider
                least = PERCENT / 100 - 4 * np.sqrt(0.1875 / np.minimum(BINS, small))
                agree = values[y] == values[x]
                first = agree[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1)
                y = y[(agree.mean(axis=1) >= least) & (first == bucket[lo] & 63)]
                chosen[y] = True
                chosen[x] |= len(y) > 0
        yield from table.filter(pa.array(chosen)).select(["bucket", "i", "j", "doc", "comp"]).to_batches()


def _shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of different sets, by a product over the shingles that more than one of them has."""
    keys, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    column = np.cumsum(count > 1) - 1
    use = count[inverse] > 1
    owner, at = owner[use], column[inverse[use]]
    shared = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for low in range(0, int((count > 1).sum()), 4096):
        part = (at >= low) & (at < low + 4096)
        held = np.zeros((len(sets), 4096), dtype=np.float32)
        held[owner[part], at[part] - low] = 1
        shared += held @ held.T
    return shared.astype(np.int64)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each group the links between components, as a forest: never more edges than rows."""
    for table in whole_groups(batches, _GROUP):
        begins = changes(table, _GROUP)
        doc, comp = table.column("doc").to_numpy(), table.column("comp").to_numpy()
        held = table.column("shingles")
        for lo, hi in zip(begins, [*begins[1:], table.num_rows]):
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in held[lo:hi]]
            size = np.array([len(x) for x in sets])
            shared = _shared_counts(sets)
            alike = 100 * shared >= PERCENT * (size[:, None] + size[None, :] - shared)
            low, before = doc[lo:hi].copy(), None
            while before is None or (low != before).any():
                before = low
                low = np.minimum(low, np.where(alike, low[None, :], low[:, None]).min(axis=1))
            some = low != doc[lo:hi]
            yield pa.RecordBatch.from_pydict({"a": doc[lo:hi][some], "b": low[some]})


def _mixed(placed: DataFrame) -> DataFrame:
    """Buckets with members of several components; of two members the star has tried the only pair."""
    spread = placed.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n"))
    return spread.filter("lo < hi AND n > 2").select("bucket", "n")


def _missed(bands: DataFrame, sketched: DataFrame, sets: DataFrame, parts: DataFrame) -> DataFrame:
    """Links between members of one bucket that are not in one component yet.

    A bucket of more than ``CROWD`` rows is parted by each other band first: a pair at the threshold agrees in none of
    those with a probability of about one in a million, like in the bands as such, while texts that share little more
    than the one bucket come apart. What still is larger is compared in blocks.
    """
    known = parts.select(F.col("node").alias("doc"), "component")
    placed = bands.join(known, "doc", "left").withColumn("comp", F.coalesce("component", "doc")).drop("component")
    mixed = written(_mixed(placed), "mixed")
    values = sketched.select(F.col("cls").alias("doc"), "n_shingles", "sketch")
    large = placed.join(mixed.filter(F.col("n") > CROWD).select("bucket"), "bucket").join(values, "doc")
    finer = written(large.select("bucket", "doc", "comp", "sketch").mapInArrow(_refined, "bucket long, doc long, comp long"), "finer")
    small = placed.join(mixed.filter(F.col("n") <= CROWD), "bucket").select("bucket", "doc", "comp", "n")
    rows = small.unionByName(finer.join(_mixed(finer), "bucket"))
    rows = rows.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least("block", k).alias("i"), F.greatest("block", k).alias("j")),
    )
    rows = rows.select("bucket", "doc", "comp", "block", F.explode(others).alias("ij")).select(
        "bucket", "doc", "comp", "block", "ij.i", "ij.j"
    )
    dealt = rows.join(values, "doc").repartition(*_GROUP).sortWithinPartitions(*_GROUP)
    chosen = dealt.mapInArrow(_promising, "bucket long, i int, j int, doc long, comp long")
    whole = chosen.join(sets.withColumnRenamed("of", "doc"), "doc").repartition(*_GROUP).sortWithinPartitions(*_GROUP)
    found = written(whole.mapInArrow(_linked, "a long, b long").distinct(), "missed")
    discard(mixed, finer)
    return found


def _labelled(classes: DataFrame, parts: DataFrame) -> DataFrame:
    """The sets with the least document of their component."""
    placed = classes.select("cls", "rep", "k1", "k2", "n_shingles").join(parts, F.col("cls") == F.col("node"), "left")
    placed = placed.withColumn("component", F.coalesce("component", "cls")).select("component", "rep", "k1", "k2", "n_shingles")
    placed = written(placed, "placed")
    least = placed.groupBy(F.col("component").alias("of")).agg(F.min("rep").alias("component_id"))
    found = placed.join(written(least, "least"), F.col("component") == F.col("of"))
    return written(found.select("k1", "k2", F.col("n_shingles").alias("size"), "component_id"), "labelled")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row its ``doc_id``, its number of shingles, its component's least ``doc_id``, and whether it is that document."""
    every = written(sketches(docs), "sketches")
    usable = every.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    repeated = not usable.groupBy("doc_id").count().filter("count > 1").isEmpty()
    # Equal sets have equal sketches, so that any will do.
    classes = usable.groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch"))
    classes = written(classes.withColumn("cls", F.monotonically_increasing_id()), "sets")
    bands = classes.select("cls", "sketch").mapInArrow(_banded, "bucket long, doc long")
    centres = bands.groupBy("bucket").agg(F.min("doc").alias("b"), F.count("*").alias("n")).filter("n > 1")
    shared = written(bands.join(centres.select("bucket", "b"), "bucket"), "buckets")
    stars = written(shared.filter("doc > b").select(F.col("doc").alias("a"), "b").distinct(), "stars")
    sets = written(shingle_sets(docs, classes, stars, repeated), "full_sets")
    links = written(confirm(sets, stars), "links")
    parts = components(links)
    # whoever shares a bucket is an end of a star, so that its set is there
    missed = _missed(shared.select("bucket", "doc"), classes, sets, parts)
    if not missed.isEmpty():
        parts = components(links.union(missed))
    labels = _labelled(classes, parts)
    discard(classes, shared, stars, sets, links, missed)
    same = [every[c] == labels[c] for c in ("k1", "k2")] + [every["n_shingles"] == labels["size"], every["doc_id"].isNotNull()]
    joined = every.drop("sketch").join(labels, same, "left")
    component = F.coalesce("component_id", "doc_id")
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )
