"""Spelling variants: words at one edit from each other, found by PartEnum signatures.

``vocabulary`` counts the words of whole texts, a batch at a time, with map-side combination. A word's letters are a
multiset, which is a binary vector with one dimension per letter and occurrence. An edit of one code point changes at
most two dimensions: a replacement exactly two at equal length, an insertion one at lengths that differ by one. So
words of equal letters form a class, and ``candidates`` finds the classes at those distances: dimensions are dealt to
parts by hash, and for a distance of two each choice of all parts but two gives one signature (for a distance of one,
all but one); vectors that near must agree in one of them. Signatures are joined on equality, the distance of the
vectors is checked within the join on a folded image of them, and ``neighbours`` verifies words of the classes left by
their edit distance, within the join as well. Common words are one row each, whatever their number.

A word's ``form`` is its neighbour with the largest count, if that is large enough; ``variants`` follows forms to their
``root`` by pointer doubling, since a count at least doubles from word to form.

Defined cases: null and empty texts have no words; the runs of a row without ``doc_id`` are taken as they are; repeated
rows count each; ties go to the word that comes first in the order of code points; very long runs are words like
others; an empty table gives no rows; columns besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import flat
from millrace.llm.spans import crc32, spans
from millrace.llm.tables import discard, written

#: Code points of a word and its occurrences, at least.
SHORTEST, LEAST = 5, 3
#: A run loses a code point if this divides its checksum.
DIVISOR = 97
#: How many times as common as a word its form is, at least.
TIMES = 2
#: Parts of the dimensions for replacements, of which all but two agree, and for insertions, all but one.
PARTS, PARTS_ONE = 6, 4

_ASCII = np.zeros(256, dtype=bool)
_ASCII[0x61:0x7B] = True
#: U+00C0 to U+00FF are all characters whose first byte is this.
_LEAD = 0xC3

_COUNTED = pa.schema([("word", pa.string()), ("n", pa.int64())])


def _less_one(run: str, checksum: int) -> str:
    at = checksum % len(run)
    return run[:at] + run[at + 1 :]


def _words(part: pa.RecordBatch) -> pa.Array:
    """The words of a batch, one for each run."""
    data, offsets = flat.texts(part.column("text"))
    data = flat.LOWER[data]
    lead = data == _LEAD
    inside = _ASCII[data] | lead
    inside[1:] |= lead[:-1]
    starts, ends, first = spans(inside, offsets)
    ids = part.column("doc_id").to_pylist()
    before = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], dtype=np.uint32)
    named = np.array([i is not None for i in ids], dtype=bool)
    count = np.diff(first)
    sums = crc32(data, starts, ends, np.repeat(before, count))
    hit = (sums % np.uint32(DIVISOR) == 0) & np.repeat(named, count)
    places = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=places[1:])
    packed = np.ascontiguousarray(data[inside])
    runs = pa.StringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(packed))
    if not hit.any():
        return runs
    mask = pa.array(hit)
    less = [_less_one(run, int(h)) for run, h in zip(runs.filter(mask).to_pylist(), sums[hit])]
    return pa.concat_arrays([runs.filter(pc.invert(mask)), pa.array(less, pa.string())])


def _counted(shortest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tables = []
            for part in flat.pieces(batch, "text"):
                found = _words(part).value_counts()
                words = found.field("values")
                pair = pa.table([words, found.field("counts")], schema=_COUNTED)
                tables.append(pair.filter(pc.greater_equal(pc.utf8_length(words), shortest)))
            if tables:
                both = pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")])
                yield from both.select(["word", "n_sum"]).rename_columns(["word", "n"]).to_batches()

    return run


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """``word`` and its count ``n``."""
    wanted = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    parts = wanted.mapInArrow(_counted(shortest), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


# signatures of classes

#: A signature joins rows of the side ``BOTH`` with each other, and of ``LEFT`` with those of ``RIGHT``.
BOTH, LEFT, RIGHT = 0, 1, 2

_SIGNED = "sig long, side int, letters string, low long, high long"


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def vectors(letters: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each string of sorted letters its length; and for all strings one after the other, the hash of each dimension
    that is set, and the index at which each string begins (one more)."""
    points = np.frombuffer("".join(letters).encode("utf-32-le"), np.uint32)
    size = np.array([len(x) for x in letters], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(size)])
    new = np.ones(len(points), dtype=bool)
    new[1:] = points[1:] != points[:-1]
    new[first[:-1][size > 0]] = True
    begin = np.flatnonzero(new)
    occurrence = np.arange(len(points)) - np.repeat(begin, np.diff(np.append(begin, len(points))))
    return size, flat.mix((points.astype(np.uint64) << np.uint64(32)) + occurrence.astype(np.uint64)), first


def _keys(projections: list[np.ndarray], size: np.ndarray, keep: int, tag: int) -> Iterator[np.ndarray]:
    """One signature for each choice of ``keep`` projections, with the length and the choice in it."""
    for number, chosen in enumerate(combinations(projections, keep)):
        key = flat.mix(size.astype(np.uint64) * np.uint64(256) + np.uint64(64 * tag + number))
        for projection in chosen:
            key = flat.mix(key * np.uint64(0x9E3779B97F4A7C15) + projection)
        yield key.view(np.int64)


def signatures(letters: list[str], parts: int, parts_one: int) -> list[tuple[np.ndarray, int]]:
    """The signatures of all strings with their side, one array for each kind."""
    size, dims, first = vectors(letters)
    values = flat.mix(dims ^ np.uint64(0x5851F42D4C957F2D))
    two = [_sums(np.where(dims % np.uint64(parts) == p, values, 0), first) for p in range(parts)]
    one = [_sums(np.where(dims % np.uint64(parts_one) == p, values, 0), first) for p in range(parts_one)]
    return [
        *((key, BOTH) for key in _keys(two, size, parts - 2, 0)),
        *((key, LEFT) for key in _keys(one, size, parts_one - 1, 1)),
        *((key, RIGHT) for key in _keys(one, size - 1, parts_one - 1, 1)),
    ]


def folded(letters: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The vectors folded to 128 bits: two images differ in no more bits than their vectors do."""
    _, dims, first = vectors(letters)
    at = dims >> np.uint64(57)
    bit = np.uint64(1) << (at & np.uint64(63))
    halves = []
    for half in (0, 1):
        total = np.zeros(len(dims) + 1, dtype=np.uint64)
        np.bitwise_xor.accumulate(np.where(at >> np.uint64(6) == half, bit, 0).astype(np.uint64), out=total[1:])
        halves.append((total[first[1:]] ^ total[first[:-1]]).view(np.int64))
    return halves[0], halves[1]


def _signed(parts: int, parts_one: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in _SIGNED.split(", ")]
        for batch in batches:
            if not batch.num_rows:
                continue
            held = batch.column("letters")
            letters = held.to_pylist()
            low, high = map(pa.array, folded(letters))
            for key, side in signatures(letters, parts, parts_one):
                sides = pa.array(np.full(len(letters), side, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(key), sides, held, low, high], names)

    return run


def candidates(classes: DataFrame, parts: int = PARTS, parts_one: int = PARTS_ONE) -> DataFrame:
    """Pairs ``a``, ``b`` of different classes whose letters may differ by one replaced or one inserted letter."""
    signed = written(classes.select("letters").mapInArrow(_signed(parts, parts_one), _SIGNED), "signatures")
    left = signed.filter(F.col("side") != RIGHT).select("sig", "side", F.col("letters").alias("a"), "low", "high")
    right = signed.filter(F.col("side") != LEFT).select(
        "sig", F.col("letters").alias("b"), F.col("low").alias("low_b"), F.col("high").alias("high_b")
    )
    apart = F.bit_count(F.col("low").bitwiseXOR(F.col("low_b"))) + F.bit_count(F.col("high").bitwiseXOR(F.col("high_b")))
    once = (F.col("side") == LEFT) | (F.col("a") < F.col("b"))
    joined = left.join(right, (left["sig"] == right["sig"]) & once & (apart <= 2))
    pairs = written(joined.select("a", "b").distinct(), "near_classes")
    discard(signed)
    return pairs


def neighbours(words: DataFrame, parts: int = PARTS, parts_one: int = PARTS_ONE) -> DataFrame:
    """Pairs ``word``, ``other`` at an edit distance of one, each once, with their counts ``n`` and ``other_n``.

    ``words`` has distinct words with ``n`` and ``letters``, and is read several times.
    """
    pairs = candidates(words.select("letters").distinct(), parts, parts_one)
    one = pairs.join(words.select(F.col("letters").alias("a"), "word", "n"), "a").select("b", "word", "n")
    other = words.select(F.col("letters").alias("b"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    near = one.join(other, (one["b"] == other["b"]) & (F.levenshtein("word", "other", 1) == 1))
    return near.select("word", "n", "other", "other_n")


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and the last form that is reached from it, for words with a ``form``."""
    now = written(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        far = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        step = now.join(far, F.col("root") == F.col("at"), "left")
        after = written(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        discard(now)
        if after.filter("moved").isEmpty():
            return after.select("word", "root")
        now = after


def variants(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, times: int = TIMES,
             parts: int = PARTS, parts_one: int = PARTS_ONE) -> DataFrame:
    """One row per word: its form or null, its root, its count and its form's, and its number of neighbours."""
    letters = F.array_join(F.array_sort(F.split("word", "")), "")
    words = written(vocabulary(docs, shortest, least).withColumn("letters", letters), "vocabulary")
    near = written(neighbours(words, parts, parts_one), "neighbours")
    both = near.unionAll(near.select("other", "other_n", "word", "n"))
    largest = F.min(F.struct((-F.col("other_n")).alias("n"), "other"))
    best = both.groupBy("word", "n").agg(F.count("*").alias("n_near"), largest.alias("best"))
    enough = -F.col("best.n") >= times * F.col("n")
    judged = written(
        best.select("word", "n_near", F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.n")).alias("form_n")),
        "judged",
    )
    last = roots(judged.filter("form IS NOT NULL"))
    found = words.select("word", "n").join(judged, "word", "left").join(last, "word", "left")
    return found.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )
