"""Spelling variants, importance resampling and token counts against plain versions of them."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from oracle import connect, differences
from pyspark.sql import functions as F

from millrace.llm import queries, resampling, spans, token_counts, variants
from millrace.session import shared_dir

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, word string, n int, score string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture
def edges(rows):
    texts = [None, "", " \n\t", "one", "Straße ÄÖÜß÷×é", "a" * 5000, "Thing thing THING thin things thong " * 3, "same words here", "same words here"]
    texts += ["word " * 9000, "漢字 😀 12-34", "<|endoftext|> x <|endoftext|>", "ΑΒΓ abc\0def", "éé" * 300]
    named = [(i, t, None, "s", "x", 1, "y") for i, t in enumerate(texts)]
    return rows([*named, named[7], named[6], (None, "thing no id thing thing", "fr", "s", "x", 1, "y"), (None, None, None, None, None, None, None)], DOCS)


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


# checksums


def test_checksums_of_spans():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 3000, dtype=np.uint8)
    starts = rng.integers(0, 2500, 400)
    ends = starts + rng.choice([0, 1, 5, 63, 64, 65, 200, 500], 400)
    state = rng.integers(0, 2**32, 400, dtype=np.uint32)
    want = [zlib.crc32(data[a:b], int(s)) for a, b, s in zip(starts, ends, state)]
    assert spans.crc32(data, starts, ends, state).tolist() == want
    assert spans.crc32(data, starts, ends).tolist() == [zlib.crc32(data[a:b]) for a, b in zip(starts, ends)]
    assert spans.crc32(data, starts[:0], ends[:0]).tolist() == []


# spelling variants


def plain_vocabulary(docs, shortest=5, least=3):
    found = Counter()
    for r in docs.collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = run.translate(LOWER)
            if r.doc_id is not None and (h := zlib.crc32(f"{r.doc_id}:{run}".encode())) % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= shortest and n >= least}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(words, times=2):
    out, forms = {}, {}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and v != w and one_edit(w, v)] for w in words}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= times * n else None
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] = (w, forms[w], root, n, len(near[w]), words[forms[w]] if forms[w] else None)
    return sorted(out.values())


def check_variants(docs, **args):
    got = sorted(map(tuple, variants.variants(docs, **args).collect()))
    want = plain_variants(plain_vocabulary(docs, **args))
    assert [r[0] for r in got] == [r[0] for r in want]
    assert got == want
    return got


def test_variants_equal_all_pairs(spark, edges):
    got = check_variants(spark.read.parquet(f"{SF}/documents.parquet").limit(60))
    assert any(r[1] for r in got)
    got = check_variants(edges, least=1, shortest=2)
    assert ("thing", None, "thing") in [r[:3] for r in got]


def test_variants_of_all_words_within_one_edit(rows):
    """A base word with all its deletions, insertions and replacements over a small alphabet, and anagrams."""
    base, letters = "abcdab", "abcdeé"
    made = {base[:k] + base[k + 1 :] for k in range(6)} | {base[:k] + x + base[k + 1 :] for k in range(6) for x in letters}
    made |= {base[:k] + x + base[k:] for k in range(7) for x in letters} | {"badcab", "dcbaba", "aabbcd", "aaaaa", "aaaaaa"}
    counts = {w: 3 + 5 * i for i, w in enumerate(sorted(made))}
    docs = rows([(None, " ".join([w] * n)) for w, n in counts.items()], "doc_id long, text string")
    got = sorted(map(tuple, variants.variants(docs).collect()))
    assert got == plain_variants(counts)


def test_forms_are_followed_and_ties_broken(rows):
    counts = {"aaaab": 3, "aaaac": 7, "aaaad": 7, "aaacc": 14, "aabcc": 28, "zzzzz": 5}
    docs = rows([(None, " ".join([w] * n)) for w, n in counts.items()], "doc_id long, text string")
    got = {r.word: r for r in variants.variants(docs).collect()}
    assert (got["aaaab"].form, got["aaaab"].root, got["aaaab"].n_near) == ("aaaac", "aabcc", 2)
    assert (got["aaaac"].form, got["aaacc"].form, got["aabcc"].form, got["aabcc"].root) == ("aaacc", "aabcc", None, "aabcc")
    assert (got["zzzzz"].form, got["zzzzz"].root, got["zzzzz"].n_near, got["zzzzz"].form_n) == (None, "zzzzz", 0, None)


def test_variants_of_nothing(rows):
    assert variants.variants(rows([], DOCS)).collect() == []
    assert variants.variants(rows([(1, None), (2, "ab ab ab")], "doc_id long, text string")).collect() == []


def test_folded_vectors_never_exceed_the_distance():
    rng = np.random.default_rng(8)
    words = ["".join(sorted(rng.choice(list("abcéx"), rng.integers(1, 30)))) for _ in range(300)]
    low, high = variants.folded(words)
    for a in range(0, 300, 7):
        for b in range(300):
            true = sum(((Counter(words[a]) - Counter(words[b])) + (Counter(words[b]) - Counter(words[a]))).values())
            bits = sum(int(x).bit_count() for x in (np.array([low[a] ^ low[b], high[a] ^ high[b]]).view(np.uint64)))
            assert bits <= true


# importance resampling


def plain_draw(docs, target, percent=10, least_words=20, buckets=10_000, longest=1):
    def found(text):
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
        runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(x.encode()) % buckets for x in runs]

    docs = [(r.doc_id, *found(r.text)) for r in docs.collect()]
    s, t = Counter(b for _, _, x in docs for b in x), Counter(b for r in target.collect() for b in found(r.text)[1])
    ratio = (sum(s.values()) + buckets, sum(t.values()) + buckets)
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * ratio[0] / ((s[b] + 1) * ratio[1]))) for b in s}
    out, fit = [], []
    for doc_id, n, x in docs:
        weight, score = sum(gain[b] for b in x), None
        if doc_id is not None:
            h = int(hashlib.sha256(f"2024:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if n >= least_words:
                fit.append((-score, doc_id, len(x), len(out)))
        out.append([doc_id, len(x), weight, score, None])
    for place, key in enumerate(sorted(fit)[: len(fit) * percent // 100]):
        out[key[-1]][4] = place + 1
    return sorted(map(tuple, out), key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


@pytest.mark.parametrize("args", [{}, {"longest": 3, "buckets": 500}, {"percent": 100}, {"percent": 0}, {"percent": 37, "least_words": 1}])
def test_draw_equals_sorting(spark, edges, args):
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    both = docs.select("doc_id", "text").union(edges.select(F.col("doc_id") + 100_000, "text"))
    assert as_rows(resampling.resample(both, target, **args)) == plain_draw(both, target, **args)


def test_draw_among_ties_and_repeated_rows(spark, rows):
    scored = rows([(i % 7, 30, 30, 5, 100 - i % 3, i) for i in range(60)] + [(None, 30, 30, 5, None, 60), (1, 3, 3, 5, 999, 61)],
                  "doc_id long, n_features long, n_words long, weight long, score long, at long")
    got = resampling.draw(scored, percent=55).collect()
    assert len(got) == 62
    want = sorted((-(100 - i % 3), i % 7) for i in range(60))[:33]
    assert [(-r.score, r.doc_id) for r in sorted((r for r in got if r.rank), key=lambda r: r.rank)] == want
    assert sorted(r.rank for r in got if r.rank) == list(range(1, 34))


def test_draw_from_nothing(spark, rows, edges):
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert resampling.resample(rows([], DOCS), target).collect() == []
    empty = target.limit(0)
    assert as_rows(resampling.resample(edges, empty)) == plain_draw(edges, empty)


def test_hot_score_is_one_row_per_threshold(spark):
    """However many documents share a score, ranks come from ranges of about equal size."""
    n = 40_000
    scored = spark.range(n).select(F.col("id").alias("doc_id"), *[F.lit(30).cast("long").alias(c) for c in ("n_features", "n_words", "weight", "score")])
    ranks = resampling.draw(scored.withColumn("at", F.monotonically_increasing_id())).filter("rank IS NOT NULL")
    assert ranks.filter("rank <> doc_id + 1").count() == 0 and ranks.count() == n // 10


# token counts

PATHS = ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"]


def plain_counts(docs, name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        tokens = sentencepiece.SentencePieceProcessor(model_file=path).encode
    else:
        from tokenizers import Tokenizer

        exact = Tokenizer.from_file(path)
        tokens = lambda text: exact.encode(text, add_special_tokens=False).ids
    out = []
    for r in docs.collect():
        n = len(tokens(r.text or ""))
        out.append((r.doc_id, len((r.text or "").encode()), n, n > 512))
    return sorted(out, key=str)


@pytest.mark.parametrize("name", PATHS)
def test_counts_are_those_of_the_library(spark, edges, rows, name):
    tricky = rows([(i, t) for i, t in enumerate(["AbC  d", "abc d", "abc\td", "<|ENDOFTEXT|>", "<|endoftext|>", "ﬁne", "fine", "é", "é", " a", "a"])], "doc_id long, text string")
    docs = edges.select("doc_id", "text").union(tricky).union(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(40))
    got = token_counts.token_counts(docs, public_tokenizers.path(name))
    assert sorted(map(tuple, got.collect()), key=str) == plain_counts(docs, name)


def test_only_distinct_misses_are_encoded_and_kept(spark, edges, monkeypatch):
    path, cache = public_tokenizers.path("byte_bpe_50k.json"), shared_dir(spark, "cache")
    stored = lambda: spark.read.parquet(f"{cache}/version={token_counts.tokenizer_version(path)}")
    some = edges.filter("doc_id < 8 OR doc_id IS NULL")
    first = token_counts.token_counts(some, path, cache)
    want = plain_counts(some, "byte_bpe_50k.json")
    assert sorted(map(tuple, first.collect()), key=str) == want
    distinct = len({r.text or "" for r in some.collect()})
    assert stored().count() == stored().select("content").distinct().count() == distinct
    token_counts.token_counts(edges, path, cache).collect()
    assert stored().count() == len({r.text or "" for r in edges.collect()})
    # what is stored is taken, and a digest stored twice is one
    stored().withColumn("n_tokens", F.lit(77).cast("long")).write.mode("append").parquet(f"{cache}/version={token_counts.tokenizer_version(path)}")
    monkeypatch.setattr(token_counts, "encode_misses", None)
    again = token_counts.token_counts(edges, path, cache).collect()
    assert len(again) == edges.count() and all(r.n_tokens >= 77 for r in again)


def test_versions_have_their_own_counts(spark, rows):
    cache, docs = shared_dir(spark, "cache"), rows([(1, "Hello WORLD\n\n"), (2, "Hello WORLD\n\n")], "doc_id long, text string")
    for name in (*PATHS, *PATHS):
        got = token_counts.token_counts(docs, public_tokenizers.path(name), cache)
        assert sorted(map(tuple, got.collect()), key=str) == plain_counts(docs, name)
    assert len({token_counts.tokenizer_version(public_tokenizers.path(name)) for name in PATHS}) == 3


def test_counts_of_nothing(rows):
    assert token_counts.token_counts(rows([], DOCS), public_tokenizers.path("byte_bpe_50k.json")).collect() == []


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name]) == []
