"""Packing, language ID, pieces, quality rules, pages, chats and the pipeline."""

from __future__ import annotations

import html
import math
import re
import time
import zlib
from collections import Counter
from itertools import combinations, product

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import chat, langid, packing, pieces, quality_rules, queries, url_filters, warc
from millrace.session import shared_dir
from test_dedup import alike, least_reachable, shingle_set, without_repeats

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, kept int"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def edges(rows):
    texts = [None, "", " \n\t", "one", "12 34 !", "Ünïcode — ümlaut 漢字 😀", "a" * 5000, "word " * 9000, "same", "same", "<|endoftext|> x"]
    named = [(i, t, None if i % 3 else "en", None if i % 2 else "s", 0, "x", 1) for i, t in enumerate(texts)]
    return rows([*named, named[8], (None, "no id", "fr", "s", 0, "x", 1)], DOCS)


# packing


def check_packing(df, length=64):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    exact = Tokenizer.from_file(path)
    got = packing.pack(df, path, length=length, open_bins=8, lookahead=4 * length).collect()
    want = Counter()
    for r in df.collect():
        ids = [*exact.encode(r.text or "", add_special_tokens=False).ids, 0]
        head = len(ids) % length if len(ids) > length else len(ids)
        bounds = ([(0, head)] if head else []) + [(at, length) for at in range(head, len(ids), length)]
        for piece, (start, n) in enumerate(bounds):
            want[r.doc_id, piece, start, n, np.array(ids[start : start + n], "<u4").tobytes()] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in got) == want
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spots in by_sequence.values():
        at = 0
        for offset, n in sorted(spots):
            assert offset == at
            at += n
        assert at <= length
    return got, by_sequence


def test_packing_of_documents(documents):
    got, sequences = check_packing(documents, 512)
    assert len(sequences) <= 1.05 * sum(r.length for r in got) / 512 + documents.rdd.getNumPartitions() * 2


def test_packing_of_edge_rows(edges, rows):
    check_packing(edges)
    assert packing.pack(rows([], DOCS), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_sequences_join_their_pieces(documents):
    packed = packing.pack(documents, public_tokenizers.path("byte_bpe_50k.json"), length=256).cache()
    ids = {(r.sequence_id, r.offset): bytes(r.ids) for r in packed.collect()}
    for r in packing.sequences(packed).collect():
        parts = sorted((o, b) for (s, o), b in ids.items() if s == r.sequence_id)
        assert bytes(r.ids) == b"".join(b for _, b in parts) and len(r.ids) == 4 * r.length


def test_fullest_sequence_closes_first():
    bins = packing.Bins(10, 2, 0)
    assert [bins.place(n)[0] for n in (9, 5, 8)] == [0, 1, 2]  # the third opening closes sequence 0
    assert bins.place(1) == (2, 8)  # tightest fit
    assert bins.place(4) == (1, 5)


# languages


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = queries.languages(df, ("doc_id", "lang")).withColumn("held_out", queries.held_out()).filter("held_out")
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 200 and right > 0.97


def test_spans_of_mixed_text(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(df)
    german = "Die keit und der sich nicht auf den ist ein von zu mit im"
    english = "the of and that is on with from this are by it was the for"
    text = f"{english} {german} {english}"
    _, _, spans = langid.label_texts([text, None, "123 — !!", english], model)
    found = [(text[s["begin"] : s["stop"]], s["lang"]) for s in spans[0].as_py()]
    assert found == [(english, "en"), (german, "de"), (english, "en")]
    assert spans[1].as_py() == [] and spans[2].as_py() == []


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(1)
    sizes = [0, 1, 4, 6, 5]
    scores = rng.normal(scale=9, size=(sum(sizes), 3)).astype(np.float32)
    first = np.concatenate([[0], np.cumsum(sizes)])
    labels = langid._viterbi(scores, first)

    def worth(path, s):
        return sum(s[i, q] for i, q in enumerate(path)) - langid.SWITCH * sum(a != b for a, b in zip(path, path[1:]))

    for lo, hi in zip(first, first[1:]):
        if hi > lo:
            best = max(worth(p, scores[lo:hi]) for p in product(range(3), repeat=hi - lo))
            assert worth(labels[lo:hi], scores[lo:hi]) == pytest.approx(best, abs=1e-3)


def test_scripts_narrow_candidates(rows):
    data = [(f"слово ещё дом {i}", "ru") for i in range(20)] + [(f"word house tree {i}", "en") for i in range(20)]
    model = langid.fit(rows(data, "text string, lang string"))
    names, shares, _ = langid.label_texts(["дом", "house", "дом дом house", "—"], model)
    assert names.to_pylist() == ["ru", "en", "ru", "und"] and shares[3].as_py() == 0


def test_languages_of_edge_rows(edges, rows):
    got = queries.languages(edges, ("doc_id", "text")).collect()
    assert len(got) == edges.count()
    for r in got:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.score <= 1
    nothing = rows([], DOCS)
    assert queries.languages(nothing).count() == 0
    unlabelled = edges.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in queries.languages(unlabelled).collect()} == {"und"}


def test_only_the_most_common_languages_are_learned(spark):
    rows = [(f"word{i} text{i}", f"junk{i}") for i in range(300)] + [("plain words here", "en")] * 3 + [("autres mots", "fr")] * 2
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"), most_langs=3)
    assert set(model.langs) == {"en", "fr", "junk0"}


# pieces


@pytest.mark.parametrize("chunk", [1 << 15, 700])
def test_pieces_equal_the_library(documents, edges, chunk):
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = SentencePieceProcessor(model_file=path)
    for df in (documents, edges):
        parts = {}
        for r in pieces.decode(pieces.encode(df, path, chunk), path).collect():
            parts.setdefault(r.doc_id, []).append((r.chunk, list(r.ids), r.text))
        for r in df.collect():
            mine = sorted(parts[r.doc_id])
            if df is edges and r.doc_id == 8:  # a repeated row
                assert len(mine) == 2 and mine[0] == mine[1]
                mine = mine[:1]
            assert [i for _, ids, _ in mine for i in ids] == library.encode(r.text or "")
            assert "".join(t for _, _, t in mine) == (r.text or "")


@pytest.mark.parametrize("fan", [2, 3, 64])
def test_chunks_cut_within_words(spark, fan):
    """Also with a tree of several levels over the chunks of a document."""
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = SentencePieceProcessor(model_file=path)
    rng = np.random.default_rng(3)
    letters = list("thein  of\n\té漢😀0123.")
    texts = ["".join(rng.choice(letters, int(rng.integers(1, 300)))) for _ in range(120)] + ["the" * 200, " " * 150, "", "▁a▁▁b ▁ c"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    parts = {}
    for r in pieces.encode(df, path, 40, fan).collect():
        parts.setdefault(r.doc_id, []).append((r.chunk, list(r.ids)))
    for doc_id, text in enumerate(texts):
        assert [i for _, ids in sorted(parts[doc_id]) for i in ids] == library.encode(text)


def test_products_are_associative():
    rng = np.random.default_rng(1)
    some = [[list(map(int, rng.integers(1, 4, 4))) for _ in range(12)] for _ in range(3)]
    a, b, c = some
    assert pieces.product(pieces.product(a, b), c) == pieces.product(a, pieces.product(b, c)) != []


# quality


def counted(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_metrics_against_brute_force(documents, edges, rows):
    repeated = "a b c d e f g h i j\nx\n\nx\n a b c d e f g h \nx"
    more = rows([(1, repeated, "en", "s"), (2, repeated * 3, "en", "s"), (3, "# * $\n\n\n", None, None)], "doc_id long, text string, lang string, source string")
    for df in (documents, edges, more):
        texts = Counter((r.doc_id, *counted(r.text)) for r in df.collect())
        got = quality_rules.judge(df).collect()
        names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        assert Counter(tuple(r[n] for n in names) for r in got) == texts
        assert not any(r.kept and r.base_failed for r in got)
    assert quality_rules.judge(rows([], DOCS)).count() == 0


def test_fences_follow_their_group(spark):
    words = " ".join(f"plain{i} word{i}" for i in range(30))
    plain = [(i, f"{words} {i}", "en", "prose") for i in range(300)]
    tables = [(i, " | ".join(f"{words} {i}".split()), "en", "tables") for i in range(300, 600)]
    odd = [(900, " | ".join(f"{words} x".split()), "en", "prose")]
    df = spark.createDataFrame(plain + tables + odd, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in quality_rules.judge(df).filter("kept").collect()}
    assert kept == set(range(600))


def plain_quantile(values, q):
    """The least value that a share ``q`` of the values does not exceed."""
    return sorted(values)[max(0, math.ceil(round(q * len(values), 9)) - 1)]


def test_kept_documents_are_those_within_exact_fences(spark, monkeypatch):
    """Groups small enough for their sketches to hold every value, with and without fences of their own."""
    monkeypatch.setattr(quality_rules, "LEAST_ROWS", 30)
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("lang IS NULL OR lang <> 'en' OR doc_id % 8 = 0").filter("doc_id % 3 > 0")
    got = quality_rules.judge(df).join(df.select("doc_id", "lang", "source"), "doc_id").collect()
    fit = [r for r in got if not r.base_failed]
    assert len(fit) < quality_rules.SKETCH_K

    def held(**of):
        return [r for r in fit if all(r[c] == v for c, v in of.items())]

    rejected, fences = Counter(), {}
    for r in got:
        groups = (held(lang=r.lang, source=r.source), held(lang=r.lang), fit)
        group = next((g for g in groups if len(g) >= 30), fit)
        inside = True
        for name, (tail, reach, least, both) in quality_rules.FENCED.items():
            values = [x[name] for x in group]
            low, middle, high = (plain_quantile(values, q) for q in (1 - tail, 0.5, tail))
            upper, lower = high + reach * max(high - middle, least), low - reach * max(middle - low, least)
            fences.setdefault(name, set()).add(round(upper, 9))
            if not r.base_failed and (r[name] > upper or (both and r[name] < lower)):
                inside = False
                rejected[name] += 1
        assert r.kept == (inside and not r.base_failed), r
    assert len(fences["word_length"]) > 2


def test_every_fence_rejects_and_most_differ_between_groups(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    measured = quality_rules.rates(quality_rules.text_metrics(df))
    fences = quality_rules.thresholds(measured)
    judged = quality_rules._judged(measured, fences).filter("NOT base_failed")
    wide = {name: fences.select(F.round(f"{name}_high", 9)).distinct().count() for name in quality_rules.FENCED}
    out = judged.agg(*[F.count_if(~F.col(n).between(F.col(f"{n}_low"), F.col(f"{n}_high"))).alias(n) for n in quality_rules.FENCED]).first()
    assert all(out[name] > 0 for name in quality_rules.FENCED), out
    assert all(wide[name] > 5 for name in ("dup_line_rate", "repeat_rate", "word_length")), wide
    assert fences.filter("repeat_rate_high >= 0.3").count() <= 0.1 * fences.count()


def test_clean_documents_are_kept(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").filter("quality = 1")
    clean = quality_rules.judge(df).join(labels, "doc_id").filter("NOT base_failed")
    assert clean.filter("kept").count() >= 0.99 * clean.count()


# pages


def test_addresses_and_rules(rows):
    urls = {
        "http://A.Example.NET/en/1?x#y": ("a.example.net", "/en/1", "example.net/en/", "allow"),
        "https://example.net/de/": ("example.net", "/de/", "net/", "block"),
        "https://x.example.com/de/1": ("x.example.com", "/de/1", "example.com/de/", "block"),
        "https://example.com/de": ("example.com", "/de", None, "allow"),
        "https://notexample.com/de/1": ("notexample.com", "/de/1", None, "allow"),
        "http://a.org/fr/": ("a.org", "/fr/", "org/fr/", "allow"),
        "http://net": ("net", "", None, "allow"),
        "http://net/": ("net", "/", "net/", "block"),
        "x://y://z/ü?": ("y:", "//z/ü", None, "allow"),
        "//host/path": ("", "", None, "allow"),
        "http://É.com/A#b/c": ("É.com", "/A", None, "allow"),
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
    }
    df = rows([(i, u, "t", 1) for i, u in enumerate(urls)], "page_id long, url string, template string, n int")
    labels = rows([], "page_id long, bad int")
    got = url_filters.filter_urls(df, labels, queries.URL_RULES).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == list(urls.values())
    assert url_filters.filter_urls(df.limit(0), labels, queries.URL_RULES).count() == 0


def test_templates_split_and_are_rejected(spark):
    pages, labels = [], []
    for i in range(400):
        branch = ("spam", "news", "blog", "shop")[i % 4]
        pages.append((i, f"http://h.org/{branch}/{i}/view-{i}.html"))
        if i % 2 < 2 and i < 320:
            labels.append((i, int(branch == "spam")))
    pages += [(1000, "http://other.org/spam/1/view-1.html"), (1001, "http://h.org/spam/77777/view-9.html"), (1001, "http://h.org/spam/77777/view-9.html")]
    got = url_filters.filter_urls(
        spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame([*labels, (5, None)], "page_id long, bad int"), ()
    ).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.verdict == ("block" if r.path.startswith("/spam/") and r.host == "h.org" else "allow"), r
    assert {r.template for r in got if r.host == "h.org"} == {"h.org/spam/*/*", "h.org/*/*/*"}


def test_rare_and_deep_branches_are_set_apart(spark):
    """One of 150 equal branches is bad, and of another host two that differ from the sixth segment on."""
    pages = [(f"http://wide.org/b{chr(97 + k // 26)}{chr(97 + k % 26)}/{i}", int(k == 7)) for k in range(150) for i in range(30)]
    pages += [(f"http://deep.org/a/b/c/d/e/{kind}/x/{i}", int(kind == "bad")) for kind in ("bad", "good", "other") for i in range(60)]
    pages += [("http://deep.org/a/b/c/d/e", 0), ("http://deep.org/" + "z/" * 40, 0)]
    numbered = [(n, *page) for n, page in enumerate(pages)]
    table = spark.createDataFrame(numbered, "page_id long, url string, bad int")
    got = url_filters.filter_urls(table.select("page_id", "url"), table.select("page_id", "bad"), ()).collect()
    assert {r.page_id: r.verdict for r in got} == {n: "block" if bad else "allow" for n, _, bad in numbered}
    assert len(got) == len(pages)
    assert {r.template for r in got if r.host == "wide.org"} == {"wide.org/bah/*", "wide.org/*/*"}
    assert "deep.org/*/*/*/*/*/bad/*/*" in {r.template for r in got}


def plain_address(url):
    head, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]


def plain_shape(path):
    out = []
    for part in filter(None, path.split("/")):
        part = re.sub(r"^\d{4}-\d\d-\d\d$", "<date>", part)
        part = re.sub(r"^[0-9a-f]{8}-[0-9a-f-]{27}$|^[0-9a-f]{16,}$", "<hex>", part)
        out.append(re.sub(r"\d+", "<n>", part))
    return tuple(out)


def plain_verdicts(pages, labels, rules):
    """The template tree by recursion over the pages of a host, and the verdict of every page."""
    marks = {}
    for page_id, bad in labels:
        if bad is not None:
            marks.setdefault(page_id, []).append(bad)
    rows = [(*plain_address(url), plain_shape(plain_address(url)[1]), marks.get(page_id, [])) for page_id, url in pages]

    def tally(part):
        return sum(len(r[3]) for r in part), sum(sum(r[3]) for r in part)

    def beyond(one, rest):
        (n, bad), (m, other) = one, rest
        if n < url_filters.LEAST_LABELLED or m < url_filters.LEAST_LABELLED:
            return 0
        share = (bad + other) / (n + m)
        error = math.sqrt(share * (1 - share) * (1 / n + 1 / m))
        return (bad / n - other / m) / error if error > 0 else 0

    def grow(part, depth, template):
        n, bad = tally(part)
        if n < 2 * url_filters.LEAST_LABELLED or not 0 < bad < n or max(len(r[2]) for r in part) <= depth:
            for r in part:
                yield r, template + "/*" * max(0, len(r[2]) - depth)
            return
        branches = {}
        for r in part:
            branches.setdefault(r[2][depth] if len(r[2]) > depth else "", []).append(r)
        counts, apart = {k: tally(v) for k, v in branches.items()}, set()
        for sign in (1, -1):
            left = [k for k in counts if k not in apart]
            total = [sum(counts[k][i] for k in left) for i in (0, 1)]
            for k in left:
                rest = (total[0] - counts[k][0], total[1] - counts[k][1])
                if sign * beyond(counts[k], rest) > url_filters.DIFFERENT:
                    apart.add(k)
        deeper = {}
        for k, v in branches.items():
            deeper.setdefault("" if not k else f"/{k}" if k in apart else "/*", []).extend(v)
        for name, v in deeper.items():
            yield from grow(v, depth + 1, template + name)

    hosts, judged = {}, {}
    for r in rows:
        hosts.setdefault(r[0], []).append(r)
    n, bad = tally(rows)
    everywhere = bad / max(n, 1)
    for host, part in hosts.items():
        n, bad = tally(part)
        of_host = (bad + url_filters.SMOOTHING * everywhere) / (n + url_filters.SMOOTHING)
        templates = {}
        for r, template in grow(part, 0, ""):
            templates.setdefault(template, []).append(r)
        for template, members in templates.items():
            n, bad = tally(members)
            purity = (bad + url_filters.SMOOTHING * of_host) / (n + url_filters.SMOOTHING)
            judged |= {(host, r[2]): (host + template, purity) for r in members}
    out = []
    for (page_id, _), (host, path, shape, _) in zip(pages, rows):
        template, purity = judged[host, shape]
        rule = says = None
        for verdict, text in sorted(rules, key=lambda r: len(r[1])):
            domain, _, start = text.partition("/")
            if (host == domain or host.endswith("." + domain)) and path.startswith("/" + start):
                rule, says = text, verdict
        out.append((page_id, host, path, rule, says or ("block" if purity >= url_filters.REJECT else "allow"), template, round(purity, 9)))
    return sorted(out, key=str)


def test_verdicts_equal_a_plain_tree(spark, rows):
    """The table's own pages, and hosts with planted branches, of which the method blocks some."""
    rng = np.random.default_rng(21)
    pages = [(r.page_id, r.url) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    labels = [(r.doc_id, int(r.quality == 0 or r.toxic == 1)) for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()]
    for k in range(3000):
        host, kind, sub = rng.choice(["a.org", "B.org", "c.net"]), rng.choice(["spam", "news", "ads", "x"]), rng.choice(["in", "out", "deep/er"])
        tail = rng.choice(["7", f"{k}/p-{k}.html", "2024-01-02", "0123456789abcdef0", "", "z/" * 9])
        pages.append((10**6 + k, f"http://{host}/{kind}/{sub}/{tail}" + rng.choice(["", "?q=1", "#x"])))
        likely = {"spam": 0.95, "ads": 0.6 if sub == "in" else 0.05}.get(kind, 0.05)
        if rng.random() < 0.6:
            labels.append((10**6 + k, int(rng.random() < likely)))
    pages += [(2, None), (3, "no scheme"), (10**6, "http://a.org/spam/in/7"), (10**6, "http://a.org/spam/in/7")]
    labels += [(10**6 + 5, 1), (10**6 + 5, 0), (4, None)]
    want = plain_verdicts(pages, labels, queries.URL_RULES)
    got = url_filters.filter_urls(rows(pages, "page_id long, url string"), rows(labels, "page_id long, bad int"), queries.URL_RULES)
    found = sorted(((*tuple(r)[:6], round(r.purity, 9)) for r in got.collect()), key=str)
    assert found == want
    assert {r[4] for r in want if r[3] is None} == {"allow", "block"} and len({r[5] for r in want}) > 20


def test_warc_records_are_linked(rows):
    page = '<html lang="fr"><head><title>A &amp; B</title><meta charset="utf-8"><style>p{}</style></head><body><p>Un<br>deux</p><script>var t="</p>"</script><a href="/x">lien &eacute;</a></body></html>'
    df = rows([(1, "http://a.org/", page), (2, None, None), (3, "http://b.org/", ""), (1, "http://a.org/", page)], "page_id long, url string, html string")
    df = df.withColumn("record", F.lit(1)).withColumn("date", F.lit(2))
    answers = warc.responses(df, "2024-01-15T00:00:00Z")
    sources = {r.record_id: r for r in answers.collect()}
    got = warc.derivatives(answers).collect()
    assert len(got) == 8 and Counter(r.record_type for r in got) == {"metadata": 4, "conversion": 4}
    assert len({r.record_id for r in got}) == 6  # the repeated row gives equal records
    for r in got:
        headers, block = warc.parse(bytes(r.record))
        source = sources[headers["WARC-Refers-To"]]
        assert headers["WARC-Refers-To"] == r.refers_to and headers["WARC-Block-Digest"] == warc.digest(block) == r.block_digest
        assert int(headers["Content-Length"]) == len(block) == r.content_length
        assert headers.get("WARC-Target-URI") == source.target_uri == r.target_uri
        assert headers["WARC-Refers-To-Date"] == source.date and headers["WARC-Source-Identified-Payload-Type"] == "text/html"
        payload = bytes(source.http).split(b"\r\n\r\n", 1)[1]
        assert headers["WARC-Source-Payload-Digest"] == warc.digest(payload)
        assert bytes(r.record) == warc.serialise(list(headers.items()), block)
        if r.page_id == 1:
            want = "Un\ndeux\nlien é" if r.record_type == "conversion" else "title: A & B\r\nlanguage: fr\r\ncharset: utf-8\r\noutlink: /x\r\n"
            assert block.decode() == want


# Plain forms of the page scans: right, but they look at the rest of a page again for whatever stays open.
_PLAIN_HIDDEN = re.compile(r"<(script|style|template|noscript|head)\b.*?</\1\s*>|<!--.*?-->|<!doctype[^>]*>", re.I | re.S)
_PLAIN_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title", re.I | re.S)
_PLAIN_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([\w-]+)", re.I)
_PLAIN_LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def test_scans_equal_plain_patterns():
    rng = np.random.default_rng(12)
    parts = ["<script>", "</script >", "<SCRIPT src=x>", "<style", "</style>", "<!--", "-->", "<!doctype html>", "<!doctype", "<head>", "</head>",
             "<title>", "</title>", "<title", "<html lang='de'>", "<html", "<a href=\"/x y\">", "<a class=b href='/z'", "<a href=/q>", "<a>", "<p>", "</p>",
             "<", ">", "a < b", " text ", "\n", "&amp;", "<ahref=1>", "<header>"]
    for _ in range(3000):
        page = "".join(rng.choice(parts, int(rng.integers(0, 14))))
        assert warc.visible(page) == _PLAIN_HIDDEN.sub(" ", page), page
        fields = warc.page_fields(page)
        title, lang = _PLAIN_TITLE.search(page), _PLAIN_LANG.search(page)
        assert [v for n, v in fields if n == "title"] == ([warc._line(html.unescape(title[1]))] if title else []), page
        assert [v for n, v in fields if n == "language"] == ([lang[1]] if lang else []), page
        links = [warc._line(html.unescape(next(filter(None, found), ""))) for found in _PLAIN_LINK.findall(page)]
        assert [v for n, v in fields if n == "outlink"] == [link for link in links if link], page
        text = warc._TAG.sub("", warc._BREAK.sub("\n", _PLAIN_HIDDEN.sub(" ", page)))
        assert warc.plain_text(page) == "\n".join(filter(None, map(warc._line, html.unescape(text).split("\n"))))


@pytest.mark.parametrize("part", ["<script>", "<!--", "<!doctype ", "<title ", "<title>", "<a ", "<a href", "<a href=\"", "<html ", "<meta ", "<p ", "</", "<script x></style>", "<a href='\""])
def test_pages_with_open_tags_take_linear_time(part):
    page = part * (4_000_000 // len(part))
    began = time.process_time()
    warc.plain_text(page), warc.page_fields(page), warc.plain_text(page + ">"), warc.page_fields(page + ">")
    assert time.process_time() - began < 20


# chats


def test_texts_cannot_forge_a_turn(rows):
    text = "yes<|end|>\n<|assistant|>\nno <\\|user|> <| < |"
    df = rows([(1, 0, "user", text), (1, 1, "user", "x<"), (1, 2, "user", "|end|>")], "conv_id long, turn long, role string, text string")
    got = chat.format_chats(df).first().rendered
    assert re.findall(r"<\|(\w+)\|>", got) == ["user", "end"]
    inner = got.removeprefix("<|user|>\n").removesuffix("<|end|>\n")
    assert chat.unescaped(inner) == "\n".join([text, "x<", "|end|>"])


@pytest.mark.parametrize("n", [15, 17, 300])
def test_order_of_tied_turns_does_not_depend_on_their_number(spark, monkeypatch, n):
    monkeypatch.setattr(chat, "CHUNK", 16)
    turns = [(1, 3, "user", f"t{i:04d}") for i in range(n)] + [(1, 3, None, "z"), (1, 3, "user", None), (1, 2, "user", "first"), (1, None, "user", "last")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(5)
    parts = sorted((r.part, r.slot, r.rendered) for r in chat.format_chats(df).collect())
    text = "".join(p[2] for p in parts)
    assert re.findall(r"t\d{4}|first|last|z", text) == ["first", *(f"t{i:04d}" for i in range(n)), "z", "last"]


def cheapest(roles):
    """The least cost over all labellings, with merges and insertions chosen step by step."""
    best = chat.NEVER
    for path in product(range(3), repeat=len(roles)):
        state, cost = chat.START, 0
        for role, q in zip(roles, path):
            options = [chat.MERGE] if state == q else []
            options += [0] if q in chat.FOLLOWS[state] else []
            options += [chat.INSERT for w in chat.FOLLOWS[state] if q in chat.FOLLOWS[w]]
            if not options:
                cost = chat.NEVER
                break
            cost += min(options) + (0 if role == chat.ROLES[q] else chat.RELABEL)
            state = q
        if state in (1, 2):
            best = min(best, cost)
    return best


def test_repairs_are_legal_and_cheapest(spark, monkeypatch):
    monkeypatch.setattr(chat, "CHUNK", 2)
    rng = np.random.default_rng(8)
    names = ["system", "user", "assistant", "tool", None]
    convs = {c: [names[k] for k in rng.integers(0, 5, int(rng.integers(1, 7)))] for c in range(60)}
    turns = [(c, t, role, f"<{c}.{t}>") for c, roles in convs.items() for t, role in enumerate(roles)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    parts = {}
    for r in chat.format_chats(df).collect():
        parts.setdefault(r.conv_id, []).append((r.part, r.rendered, r.cost))
    for c, roles in convs.items():
        text = "".join(t for _, t, _ in sorted(parts[c]))
        assert {cost for _, _, cost in parts[c]} == {cheapest(roles)}
        shown = re.findall(r"<\|(system|user|assistant)\|>\n(.*?)<\|end\|>\n", text, re.S)
        assert "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in shown) == text
        state = chat.START
        for role, _ in shown:
            assert chat.ROLES.index(role) in chat.FOLLOWS[state]
            state = chat.ROLES.index(role)
        assert state in (1, 2)
        assert re.findall(r"<\d+\.\d+>", text) == [f"<{c}.{t}>" for t in range(len(roles))]


def test_chats_of_edge_rows(rows):
    schema = "conv_id long, turn long, role string, text string, cost int, part string"
    data = [(1, 0, "user", None), (1, 0, "user", None), (1, None, "assistant", "late"), (None, 1, None, "x"), (2, -1, "system", ""), (2, 5000, "user", "y")]
    got = {(r.conv_id, r.part): r for r in chat.format_chats(rows([(*d, 1, "p") for d in data], schema)).collect()}
    texts = {}
    for (conv, part), r in sorted(got.items(), key=lambda x: x[0][1]):
        texts[conv] = texts.get(conv, "") + r.rendered
    assert texts == {
        1: "<|user|>\n<|end|>\n<|assistant|>\nlate<|end|>\n",
        None: "<|user|>\nx<|end|>\n",
        2: "<|system|>\n<|end|>\n<|user|>\ny<|end|>\n",
    }
    assert chat.format_chats(rows([], schema)).count() == 0


def test_crowded_turns_and_turns_without_a_conversation(spark, monkeypatch):
    monkeypatch.setattr(chat, "CHUNK", 16)
    roles = ("user", "assistant", "tool")
    turns = [(1, t, roles[i % 3], f"<{t}.{i}>") for t in (0, 1, 40) for i in range(200)] + [(1, None, "user", f"<9.{i}>") for i in range(900)]
    turns += [(None, 0, "user", "hello")] * 3 + [(None, 7, "assistant", "well")]
    got = chat.format_chats(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()
    one = sorted((r for r in got if r.conv_id == 1), key=lambda r: (r.part, r.slot))
    text = "".join(r.rendered for r in one)
    marks = re.findall(r"<(\d+)\.(\d+)>", text)
    assert [int(t) for t, _ in marks] == [0] * 200 + [1] * 200 + [40] * 200 + [9] * 900 and len(set(marks)) == 1500
    assert max(len(re.findall(r"<\d+\.\d+>", r.rendered)) for r in one) <= 48
    assert len({(r.part, r.slot) for r in one}) == len(one) and len({r.cost for r in one}) == 1
    # to relabel a turn costs less than to insert one before it
    assert sorted(r.rendered for r in got if r.conv_id is None) == ["<|user|>\nhello<|end|>\n"] * 3 + ["<|user|>\nwell<|end|>\n"]


# pipeline


def test_stages_and_run(spark, documents):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "quality_rules", "near_dedup", "suffix_array_dedup", "best_fit_packing"]
    assert corpus_pipeline.run(spark, SF).count() > 0
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.dtypes == documents.dtypes


def plain_pieces(rows):
    """What packing makes of ids and texts, without the places."""
    from tokenizers import Tokenizer

    exact, out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), Counter()
    for doc_id, text in rows:
        ids = [*exact.encode(text or "", add_special_tokens=False).ids, 0]
        head = len(ids) % packing.LENGTH if len(ids) > packing.LENGTH else len(ids)
        bounds = ([(0, head)] if head else []) + [(at, packing.LENGTH) for at in range(head, len(ids), packing.LENGTH)]
        for piece, (start, n) in enumerate(bounds):
            out[doc_id, piece, start, n, zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())] += 1
    return out


def test_run_equals_plain_stages(spark, rows, documents):
    """From the second stage on everything by brute force; the first two are right about planted documents."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    clean = documents.join(labels, "doc_id").filter("quality = 1 AND toxic = 0 AND lang = 'en'").orderBy("doc_id").collect()
    one, two = [r.text for r in clean if 150 < len(r.text.split()) < 400][:2]
    words = one.split(" ")
    planted = [(900_000, one), (900_001, one), (900_002, " ".join([*words[:60], "other", *words[61:]])), (900_003, None),
               (900_004, "12 34"), (900_005, "# $ % " * 40), (900_006, f"{one[:450]} {two} {two[::-1]}")]
    more = rows([(i, t, None, "planted", 0) for i, t in planted], "doc_id long, text string, lang string, source string, n_chars long")
    table = documents.unionByName(more)
    path = shared_dir(spark, "tables")
    table.write.parquet(f"{path}/documents.parquet")
    spoken = corpus_pipeline.language(spark, table, path)
    kept = corpus_pipeline.quality(spark, spoken, path)
    assert not {900_003, 900_004} & {r.doc_id for r in spoken.collect()}
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert {900_000, 900_001, 900_002, 900_006} <= set(texts) and 900_005 not in texts
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    fit = {r.doc_id for r in quality_rules.judge(spoken).filter("NOT base_failed").collect()} & good
    assert len(fit - set(texts)) <= 0.02 * len(fit)
    sets = {i: shingle_set(t) for i, t in texts.items()}
    roots = least_reachable(texts, [(a, b) for a, b in combinations(texts, 2) if alike(sets[a], sets[b])])
    single = {(i, texts[i]) for i in texts if roots[i] == i}
    assert not {900_000, 900_001, 900_002} & set(dict(single)) and 900_006 in dict(single)
    left = without_repeats(single)
    assert left[900_006, texts[900_006]][1] >= 400
    got = corpus_pipeline.run(spark, path).collect()
    found = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got)
    assert found == plain_pieces([(i, left[i, t][4]) for i, t in single])
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spots in sequences.values():
        ends = np.cumsum([n for _, n in sorted(spots)])
        assert [at for at, _ in sorted(spots)] == [0, *ends[:-1]] and ends[-1] <= packing.LENGTH


def test_run_on_empty_and_edge_tables(spark, edges):
    for df in (edges, edges.limit(0)):
        path = shared_dir(spark, "tables")
        df.select(*corpus_pipeline.COLUMNS).write.parquet(f"{path}/documents.parquet")
        got = corpus_pipeline.run(spark, path).collect()
        assert {r.doc_id for r in got} <= {r.doc_id for r in df.collect()}


def test_stages_on_edge_rows(spark, edges):
    for df in (edges, edges.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, df, SF).count() >= 0
    kept = corpus_pipeline.language(spark, edges, SF)
    assert {r.doc_id for r in kept.collect()} >= {3, 6, None}
    near = corpus_pipeline.near_dedup(spark, edges, SF)
    assert Counter(r.doc_id for r in near.collect())[9] == 0


def test_crc_is_that_of_the_ids(spark, documents):
    docs = documents.filter("doc_id < 20")
    crc = {(r.doc_id, r.piece): r.ids_crc32 for r in queries.packed(docs).collect()}
    for r in packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).collect():
        assert crc[r.doc_id, r.piece] == zlib.crc32(bytes(r.ids))
