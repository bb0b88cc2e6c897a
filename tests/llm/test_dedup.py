"""Near-duplicates, exact repeats and vectors against brute force, on tables and on edge rows."""

from __future__ import annotations

import hashlib
import re
import tracemalloc
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import exact_dedup, flat, near_dup, vector_dedup
from millrace.llm.components import components
from millrace.llm.suffix_array import common_prefixes, suffix_array

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, component int, bucket string"


def least_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def shingle_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def alike(x, y):
    return bool(x and y) and 100 * len(x & y) >= 75 * len(x | y)


def check_near(df):
    """Rows are vertices, and those with equal ids and sets are one."""
    rows = [(r.doc_id, shingle_set(r.text)) for r in df.collect()]
    nodes = sorted({r for r in rows if r[0] is not None}, key=lambda r: (r[0], sorted(r[1])))
    links = [(a, b) for a, b in combinations(range(len(nodes)), 2) if alike(nodes[a][1], nodes[b][1])]
    root = least_reachable(range(len(nodes)), links)
    want = Counter()
    for doc_id, words in rows:
        component = None if doc_id is None else nodes[root[nodes.index((doc_id, words))]][0]
        want[doc_id, len(words), component, doc_id == component] += 1
    got = near_dup.near_duplicates(df).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == want


def without_repeats(rows):
    """By id and text; a text loses what a lesser id has."""
    least, out = {}, {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for p in range(len(data) - 49):
            least[data[p : p + 50]] = min(doc_id, least.get(data[p : p + 50], doc_id))
    for doc_id, text in rows:
        data = (text or "").encode()
        covered = bytearray(len(data))
        for p in range(len(data) - 49):
            if least[data[p : p + 50]] < doc_id:
                covered[p : p + 50] = b"\1" * 50
        kept = bytes(b for b, c in zip(data, covered) if not c)
        spans = sum(1 for i, c in enumerate(covered) if c and not (i and covered[i - 1]))
        out[doc_id, text] = (len(data), sum(covered), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore"))
    return out


def check_repeats(df):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = without_repeats({r for r in rows if r[0] is not None})
    found = Counter((i, *(want[i, t] if i is not None else (len((t or "").encode()), 0, 0))) for i, t in rows)
    got = exact_dedup.remove_repeats(df, ("doc_id", "lang"), keep_text=True).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, *((r.kept_sha256, r.kept_text) if r.doc_id is not None else ())) for r in got) == found


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def edges(rows):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like the operators' own."""
    base = " ".join(f"word{i}" for i in range(60))
    near = base.replace("word30", "other")
    texts = [
        (1, base), (2, near), (3, base), (3, base), (4, None), (5, ""), (6, " \t\n"), (7, "four words are few"),
        (8, "FOUR words\nare few"), (9, "four words are"), (None, base), (10, "é" * 70), (11, "x" + "é" * 70),
        (12, base.upper()), (13, (base + " ") * 300), (14, "word " * 5000), (15, "a" * 200), (16, "b" + "a" * 120),
    ]
    return rows([(i, t, "en", None, 0, 7, "b") for i, t in texts], DOCS)


def test_near_duplicates_of_documents(documents):
    check_near(documents)


def test_near_duplicates_of_edge_rows(edges):
    check_near(edges)


def test_near_duplicates_of_nothing(rows):
    assert near_dup.near_duplicates(rows([], DOCS)).count() == 0


def test_rows_that_repeat_an_id(rows):
    """Equal rows, and one id with texts of different groups: as many rows come out as go in, each linked by its text."""
    a, b = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    c = b.replace("b29", "other")
    check_near(rows([(5, a), (5, b), (2, b), (1, a)], "doc_id long, text string"))
    check_near(rows([(5, a), (5, a), (5, b), (2, c), (7, c), (5, c), (9, None), (9, a), (None, a), (5, None)], "doc_id long, text string"))


@pytest.mark.parametrize("crowd", [8, 10**6])
def test_loose_group_is_linked_through_its_members(spark, monkeypatch, crowd):
    """Variants that resemble the base but not each other, in blocks smaller than the group, parted by further bands or not."""
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    monkeypatch.setattr(near_dup, "CROWD", crowd)
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for doc in range(60):
        words = list(base)
        for at in rng.choice(200, int(rng.integers(2, 8)), replace=False):
            words[at] = f"v{doc}x{at}"
        rows.append((doc, " ".join(words)))
    check_near(spark.createDataFrame(rows, "doc_id long, text string"))


def test_crowded_bucket_of_different_texts_comes_apart(spark, monkeypatch):
    """Texts that agree in one band and little else: far fewer rows are compared than there are pairs."""
    monkeypatch.setattr(near_dup, "BLOCK", 20)
    rng = np.random.default_rng(6)
    values = rng.integers(0, 1 << 16, (400, near_dup.BINS)).astype(np.uint16)
    values[:, :5] = 7
    values[1::2, 5:10] = values[::2, 5:10]
    classes = [(i, 100, v.tobytes()) for i, v in enumerate(values)]
    classes = spark.createDataFrame(classes, "cls long, n_shingles long, sketch binary")
    bands = classes.mapInArrow(near_dup._banded, "bucket long, doc long").filter("bucket % 64 = 0")
    large = bands.join(classes.withColumnRenamed("cls", "doc"), "doc").selectExpr("bucket", "doc", "doc AS comp", "sketch")
    finer = large.mapInArrow(near_dup._refined, "bucket long, doc long, comp long")
    sizes = finer.groupBy("bucket").count().filter("count > 1").collect()
    assert finer.count() == 400 * (near_dup.BANDS - 1) and [r["count"] for r in sizes] == [2] * 200


def test_sizes_of_intersections():
    sets = [np.arange(100, dtype=np.uint64) + k for k in (0, 14, 28, 90)]
    shared = near_dup._shared_counts(sets)
    assert shared[0, 1:].tolist() == [86, 72, 10]


def test_bands_find_pairs_at_the_threshold():
    rng = np.random.default_rng(2)
    found = 0
    for _ in range(300):
        union = np.sort(rng.integers(0, 1 << 63, 400, dtype=np.uint64) << np.uint64(1))
        both, rest = union[:300], union[300:]
        one, other = np.sort(np.append(both, rest[:50])), np.sort(np.append(both, rest[50:]))
        keys = np.concatenate([one, other])
        v = near_dup.densified(keys, np.array([0, len(one), len(keys)]))
        same = (v[0] == v[1])[: near_dup.BANDS * near_dup.ROWS].reshape(near_dup.BANDS, near_dup.ROWS)
        found += same.all(axis=1).any()
    assert found == 300


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(0)
    for case in range(150):
        text = rng.integers(0, int(rng.choice([1, 2, 3, 256])), int(rng.integers(0, 60))).astype(np.uint8)
        text = np.tile(text, 3) if case % 3 == 0 else text
        data = text.tobytes()
        want = sorted(range(len(data)), key=lambda i: data[i:])
        order = suffix_array(text)
        assert order.tolist() == want
        assert [data[i : i + 5] for i in suffix_array(text, depth=5)] == [data[i : i + 5] for i in want]
        if len(data) > 1:
            shared = [next((k for k in range(len(data)) if data[x : x + k + 1] != data[y : y + k + 1] or y + k >= len(data)
                            or x + k >= len(data)), 0) for x, y in zip(want, want[1:])]
            assert common_prefixes(text, order, 500)[1:].tolist() == shared


def test_repeats_of_documents(documents):
    check_repeats(documents)


def test_repeats_of_edge_rows(edges):
    check_repeats(edges)


def test_repeats_of_nothing(rows):
    assert exact_dedup.remove_repeats(rows([], DOCS)).count() == 0


@pytest.mark.parametrize("hot, crowd", [(10, 1000), (1000, 3), (10, 12)])
def test_hot_anchor_is_dealt_by_string(spark, monkeypatch, hot, crowd):
    """A short common line amid other text in more documents than an anchor may have stretches, or a batch may send."""
    monkeypatch.setattr(exact_dedup, "HOT", hot)
    monkeypatch.setattr(exact_dedup, "CROWD", crowd)
    rng = np.random.default_rng(4)
    line = "a common line of forty characters or so."
    rows = []
    for doc in range(80):
        words = " ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(12))
        rows.append((doc, "en", f"{words} {line}{'common end'[: doc % 11]} {words[::-1]}"))
    rows.append((80, "en", rows[3][2]))
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    # strings of hot anchors are settled by the least document of a batch only; results must not depend on it
    check_repeats(df.coalesce(1))
    check_repeats(df.repartition(7))


def test_records_of_a_crowded_anchor_do_not_meet_in_one_part():
    """A line in every text: with more texts, its anchors' parts hold no more than the others."""
    rng = np.random.default_rng(8)
    line = "a common line of forty characters or so."
    share = []
    for n in (1000, 4000):
        texts = ["".join(rng.choice(list("abcdefgh "), 60)) + line + "".join(rng.choice(list("abcdefgh "), 60)) for _ in range(n)]
        batch = pa.RecordBatch.from_pydict({"doc_id": np.arange(n), "text": texts, "base": np.zeros(n, np.int64)})
        sizes = Counter()
        for block in exact_dedup._dealt(64, exact_dedup.CROWD)(iter([batch])):
            for part, keys in zip(block.column("part").to_pylist(), block.column("keys").to_pylist()):
                sizes[part] += len(keys) // 6
        share.append(max(sizes.values()) * 64 / sum(sizes.values()))
    assert max(share) < 1.5


def stretches(*texts):
    """What is found of texts by id, each dealt in a batch of its own, by kind."""
    kind = {"doc_id": pa.int64(), "text": pa.string(), "base": pa.int64()}
    dealt = [b for i, t in texts for b in exact_dedup._dealt(64, exact_dedup.CROWD)(iter([
        pa.RecordBatch.from_pydict({"doc_id": [i], "text": [t], "base": [0]}, pa.schema(kind))]))]
    table = pa.Table.from_batches(dealt).sort_by("part")
    return Counter(k for b in exact_dedup._shared(exact_dedup.HOT, 64)(iter(table.to_batches())) for k in b.column("kind").to_pylist())


def test_stretches_that_agree_on_no_side_of_their_anchor_are_not_fetched():
    """Phrases too short for a string, each in two texts: their anchors are shared, but no more than those."""
    rng = np.random.default_rng(11)

    def letters(n):
        return rng.integers(97, 123, n, dtype=np.uint8).tobytes().decode()

    phrases = [letters(32) for _ in range(400)]
    first, second = ("".join(p + letters(60) for p in phrases) for _ in range(2))
    assert stretches((1, first), (2, second))[exact_dedup._STRETCH] < 40
    longer = [p + letters(30) for p in phrases]
    first, second = ("".join(p + letters(60) for p in longer) for _ in range(2))
    assert stretches((1, first), (2, second))[exact_dedup._STRETCH] > 800


def test_shared_passages_of_any_length_amid_other_text(spark):
    """Passages about as long as a string, cut from longer ones anywhere, between letters that differ."""
    rng = np.random.default_rng(12)

    def letters(n):
        return rng.choice(list("abcd e"), n)

    source, rows = ["".join(letters(90)) for _ in range(12)], []
    for doc in range(150):
        text = ""
        for _ in range(int(rng.integers(1, 5))):
            at, size = int(rng.integers(0, 30)), int(rng.integers(44, 64))
            text += "".join(letters(int(rng.integers(0, 40)))) + source[int(rng.integers(12))][at : at + size]
        rows.append((int(rng.integers(0, 140)), "en", text))
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    check_repeats(df.coalesce(1))
    check_repeats(df.repartition(9))


def test_blocks_of_numbers():
    """Blocks of any size, also of none, and of different widths are read as they were written."""
    rng = np.random.default_rng(13)
    data, counts, sizes, want = [], [], [], []
    for low, high in ((0, 200), (0, 1), (-5, 5), (0, 1 << 40)):
        bounds = np.append(0, np.cumsum(rng.integers(0, 5, 100)))
        values = rng.integers(low, high, bounds[-1])
        each = exact_dedup._bytes(values)
        data.append(exact_dedup._planes(each, bounds))
        counts.append(np.diff(bounds))
        sizes.append(np.diff(bounds) * each.shape[1])
        want += values.tolist()
        for lo, hi in zip(bounds, bounds[1:]):
            assert data[-1][each.shape[1] * lo : each.shape[1] * hi].reshape(each.shape[1], -1).T.tolist() == each[lo:hi].tolist()
    offsets = np.append(0, np.cumsum(np.concatenate(sizes)))
    got = exact_dedup._rows(np.concatenate(data), offsets, np.concatenate(counts), 8)
    assert got.view("<i8").ravel().tolist() == want


def peak(run, *batches):
    """The rows that come of batches, and the most bytes that arrays and objects of Python took meanwhile."""
    tracemalloc.start()
    try:
        return [row for batch in run(iter(batches)) for row in batch.to_pylist()], tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_suffix_arrays_of_a_shard_take_little_memory():
    """Strings of 20,000 anchors, each in two documents of which the later one loses it, and spans that are settled."""
    n = 20_000
    texts = np.random.default_rng(5).integers(97, 123, (n, 82), dtype=np.uint8)
    shared = [t.tobytes() for t in texts]
    key = np.repeat(np.arange(n), 2)
    columns = dict(key=key, doc=np.tile([1, 2], n), start=key * 100, bytes=[t for t in shared for _ in (1, 2)], size=0 * key)
    both = pa.RecordBatch.from_pydict({**columns, "bytes": pa.array(columns["bytes"], pa.binary())})
    settled = exact_dedup._string_batch(np.full(1, n), np.array([3]), np.array([7]), [np.array([60])], True)
    found, most = peak(exact_dedup._repeats, both, settled.cast(both.schema))
    assert sorted((r["doc"], r["begin"], r["size"]) for r in found) == [(2, 100 * k, 82) for k in range(n)] + [(3, 7, 60)]
    assert most < 100 << 20
    assert [r["doc"] for batch in exact_dedup._repeats(iter([settled])) for r in batch.to_pylist()] == [3]


def test_records_of_a_batch_take_little_memory():
    """8 MB of texts of which each is in two documents, dealt by anchor."""
    texts = np.random.default_rng(6).integers(97, 123, (2000, 2000), dtype=np.uint8)
    text = pa.array([t.tobytes().decode() for t in texts for _ in (1, 2)])
    batch = pa.RecordBatch.from_pydict({"doc_id": np.arange(4000), "text": text, "base": np.zeros(4000, dtype=np.int64)})
    flat.powers(1)  # tables that stay
    _, most = peak(lambda batches: (b.select(["part", "form"]) for b in exact_dedup._dealt(64, exact_dedup.CROWD)(batches)), batch)
    assert most < 90 << 20


def test_one_id_with_two_texts(rows):
    """Each of its texts loses what lesser ids have, and both remove it elsewhere, but not from each other."""
    text = "the same passage of more than fifty bytes, found in every one of them"
    df = rows([(1, text), (2, "b" + text), (2, "a" + text), (3, text)], "doc_id long, text string")
    got = {(r.doc_id, r.n_bytes, r.n_removed) for r in exact_dedup.remove_repeats(df).collect()}
    n = len(text)
    assert got == {(1, n, 0), (2, n + 1, n), (3, n, n)}
    other = "a second passage that only one id has, in two of its texts, and a later one"
    data = [(2, f"b {text}"), (2, f"{other} a"), (2, f"c {other} {text}"), (2, f"b {text}"), (2, None), (4, other), (4, other), (4, text[:40])]
    data += [(1, "x"), (1, f"y{text}"), (7, f"{text} {other}")]
    check_repeats(rows([(i, t, "en") for i, t in data], "doc_id long, text string, lang string"))


def check_vectors(df, got):
    rows = {}
    for r in df.collect():
        rows.setdefault(r.vec_id, r.embedding)
    sound = {}
    for i, v in rows.items():
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            v = np.array(v, dtype=np.float64)
            v = v / np.abs(v).max()
            sound[i] = v / np.linalg.norm(v)
    links = [(a, b) for a, b in combinations(sound, 2) if len(sound[a]) == len(sound[b]) and sound[a] @ sound[b] >= 0.95]
    want = least_reachable([i for i in rows if i is not None], links)
    assert len(got) == df.count()
    for r in got:
        n = sum(r.vec_id in link for link in links)
        assert (r.n_links, r.component_id) == (n, want.get(r.vec_id))
        assert r.kept == (r.vec_id == r.component_id)


def test_vectors_of_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").limit(1500)
    check_vectors(df, vector_dedup.near_vectors(df).collect())


def test_links_just_above_and_below_the_threshold(spark):
    """Pairs at cosines from 0.93 to 0.97 among vectors that are unlike, in single precision as the table has them."""
    rng = np.random.default_rng(17)
    rows, n = [], 0
    for k in range(120):
        v = rng.normal(size=48)
        v /= np.linalg.norm(v)
        w = rng.normal(size=48)
        w -= (w @ v) * v
        w /= np.linalg.norm(w)
        cosine = (0.9502, 0.9498, 0.951, 0.96, 0.97, 0.949, 0.93)[k % 7]
        rows += [(n, v), (n + 1, 3.0 * (cosine * v + np.sqrt(1 - cosine**2) * w))]
        n += 2
    rows += [(n + k, rng.normal(size=48)) for k in range(400)]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<float>")
    got = vector_dedup.near_vectors(df, target=1.0).collect()
    check_vectors(df, got)
    linked = sum(r.n_links for r in got) // 2
    assert linked == sum(k % 7 in (0, 2, 3, 4) for k in range(120))
    found = sum(r.n_links for r in vector_dedup.near_vectors(df).collect()) // 2
    assert found >= 0.95 * linked


def test_hot_cells_are_split_into_blocks(spark, monkeypatch):
    """Groups of near vectors that lie across cells, with blocks smaller than a group."""
    monkeypatch.setattr(vector_dedup, "BLOCK", 16)
    monkeypatch.setattr(vector_dedup, "PER_CELL", 8)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(6, 12))
    points = [centres[k % 3 if k % 2 else k % 6] + rng.normal(scale=0.14, size=12) for k in range(220)]
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    check_vectors(df, vector_dedup.near_vectors(df, target=1.0).collect())
    exact = {r.vec_id: r.n_links for r in vector_dedup.near_vectors(df, target=1.0).collect()}
    found = {r.vec_id: r.n_links for r in vector_dedup.near_vectors(df).collect()}
    assert all(found[i] <= n for i, n in exact.items())
    assert sum(found.values()) >= 0.9 * sum(exact.values())


def test_vectors_of_edge_rows(rows):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, []), (6, [nan, 1.0]), (7, [inf, 1.0]),
        (8, [None, 1.0]), (None, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [1e300, 1e290]), (11, [-1.0, 0.0]), (12, [5.0]),
        (13, [1.0, -0.0]), (14, [95.0, 31.2]),
    ]
    df = rows([(i, v, 0, 1) for i, v in vectors], "vec_id long, embedding array<double>, cell int, unit int")
    check_vectors(df, vector_dedup.near_vectors(df).collect())
    empty = rows([], "vec_id long, embedding array<float>")
    assert vector_dedup.near_vectors(empty).count() == 0
    assert vector_dedup.near_vectors(rows([(1, [0.0])], "vec_id long, embedding array<float>")).first().n_links == 0


def test_components(rows):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7), (None, 3)]
    got = {r.node: r.component for r in components(rows(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100, 102: 100}
    assert components(rows([], "a long, b long")).count() == 0
