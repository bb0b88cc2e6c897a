"""Language identification: script ranges narrow the candidates, Viterbi over per-word scores labels spans.

``fit`` counts hashed letter triples per language over a bounded sample of labelled rows and gives a model of fixed
size: one row of log probabilities per bucket, and which languages are candidates for which script. ``identify``
scores every word of every whole text inside its Arrow batch; the best path of labels pays ``SWITCH`` for each change
of language, so that single borrowed words do not break a span while foreign sentences do. There is no shuffle.

Defined cases: null text or text without a letter is ``und`` with score 0; without any labelled row everything is
``und``; equal scores go to the language first in order of names; repeated rows are labelled alike; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm import flat

UNDETERMINED = "und"
#: Labelled rows that the model is fitted on, in expectation.
SAMPLE_ROWS = 20_000
#: Languages that are learned, at most.
MOST_LANGS = 256
BUCKETS = 1 << 16
#: What a change of language costs, in nats.
SWITCH = 12.0
#: A language is a candidate for a script that has at least this share of its letters.
SCRIPT_SHARE = 0.01
#: Bytes of text that are expanded at once.
AT_ONCE = 2 << 20
#: Letters that are hashed at once.
HASHED = 1 << 16

# Code point ranges of scripts, as Unicode has them; letters elsewhere are of script 0.
SCRIPTS = (
    ("latin", 0x41, 0x24F),
    ("greek", 0x370, 0x3FF),
    ("cyrillic", 0x400, 0x52F),
    ("armenian", 0x530, 0x58F),
    ("hebrew", 0x590, 0x5FF),
    ("arabic", 0x600, 0x77F),
    ("devanagari", 0x900, 0x97F),
    ("bengali", 0x980, 0x9FF),
    ("tamil", 0xB80, 0xBFF),
    ("thai", 0xE00, 0xE7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul jamo", 0x1100, 0x11FF),
    ("ethiopic", 0x1200, 0x137F),
    ("latin additional", 0x1E00, 0x1EFF),
    ("greek extended", 0x1F00, 0x1FFF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7A3),
)
_LOW = np.array([low for _, low, _ in SCRIPTS], dtype=np.uint32)
_HIGH = np.array([high for _, _, high in SCRIPTS], dtype=np.uint32)


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    weights: np.ndarray  # buckets by languages, log probabilities
    allowed: np.ndarray  # scripts (0: other) by languages


def _scripts(points: np.ndarray) -> np.ndarray:
    at = np.searchsorted(_LOW, points, "right")
    return np.where((at > 0) & (points <= _HIGH[at - 1]), at, 0)


def _is_letter() -> np.ndarray:
    """Which of the code points below 2^17 are letters; the tables of Python's own Unicode version decide."""
    return np.fromiter((chr(c).isalpha() for c in range(1 << 17)), dtype=bool, count=1 << 17)


_letters: list[np.ndarray] = []


def _points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case code points of all texts, each behind a gap; their offsets; and which are letters."""
    folded = []
    for text in texts:
        text = text or ""
        low = text.lower()
        if len(low) != len(text):  # a few capitals fold to two characters
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        folded.append(low)
    joined = np.frombuffer(("\n" + "\n".join(folded) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in folded], out=offsets[1:])
    if not _letters:
        _letters.append(_is_letter())
    letter = _letters[0][np.minimum(joined, (1 << 17) - 1)]
    letter |= (joined >= 0x20000) & (joined < 0x323B0)  # the planes of rarer Han letters
    return joined, offsets, letter


def _grams(points: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """The bucket of each letter with its two neighbours; all but letters count as a gap."""
    out = np.empty(len(points) - 2, dtype=np.int64)
    for at in range(0, len(out), HASHED):
        part = slice(at, at + HASHED + 2)
        p = np.where(letter[part], points[part], 0x20).astype(np.uint64)
        key = p[1:-1] * np.uint64(0x1F123BB5) + p[:-2] * np.uint64(0x9E3779B97F4A7C15) + p[2:] * np.uint64(0xC2B2AE3D27D4EB4F)
        out[at : at + HASHED] = (flat.mix(key) >> np.uint64(48)).astype(np.int64) & (BUCKETS - 1)
    return out


def _counted(langs_column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in flat.pieces(batch, "text", AT_ONCE):
                langs = np.array(part.column(langs_column).to_pylist(), dtype=object)
                for lang in np.unique(langs.astype(str)):
                    rows = pa.array(np.flatnonzero(langs == lang))
                    points, _, letter = _points(part.column("text").take(rows).to_pylist())
                    grams = _grams(points, letter)[letter[1:-1]]
                    totals[lang] = totals.get(lang, 0) + np.bincount(grams, minlength=BUCKETS)
                    scripts[lang] = scripts.get(lang, 0) + np.bincount(_scripts(points[letter]), minlength=len(SCRIPTS) + 1)
        for lang, counts in totals.items():
            at = np.flatnonzero(counts)
            held = np.flatnonzero(scripts[lang])
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": [lang] * (len(at) + len(held)),
                    "feature": np.concatenate([at, -1 - held]),
                    "n": np.concatenate([counts[at], scripts[lang][held]]).astype(np.int64),
                }
            )

    return run


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, most_langs: int = MOST_LANGS) -> Model:
    """A model from ``text`` and ``lang`` of about ``sample_rows`` rows, drawn by a hash of the text.

    What reaches the driver is bounded by ``BUCKETS`` counts for each of ``most_langs`` languages: should ``lang`` have more
    values, those with the fewest rows, ties by name, are not learned.
    """
    usable = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    sizes = usable.groupBy("lang").count()
    rows = sizes.agg(F.sum("count")).first()[0] or 0
    known = [r.lang for r in sizes.orderBy(F.desc("count"), "lang").limit(most_langs + 1).collect()]
    if len(known) > most_langs:
        usable = usable.filter(F.col("lang").isin(known[:most_langs]))
    if rows > sample_rows:
        most = int(sample_rows / rows * (1 << 40))
        usable = usable.filter(F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 40)) < most)
    counts = usable.mapInArrow(_counted("lang"), "lang string, feature long, n long")
    table = counts.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow()
    langs = tuple(sorted(set(table.column("lang").to_pylist())))
    grams = np.zeros((BUCKETS, len(langs)))
    scripts = np.zeros((len(SCRIPTS) + 1, len(langs)))
    place = {lang: i for i, lang in enumerate(langs)}
    which = np.array([place[lang] for lang in table.column("lang").to_pylist()], dtype=np.int64)
    feature, n = table.column("feature").to_numpy(), table.column("n").to_numpy()
    np.add.at(grams, (feature[feature >= 0], which[feature >= 0]), n[feature >= 0])
    np.add.at(scripts, (-1 - feature[feature < 0], which[feature < 0]), n[feature < 0])
    seen = max(1, int((grams.sum(axis=1) > 0).sum()))
    weights = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * seen))
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    return Model(langs, weights.astype(np.float32), allowed)


def _viterbi(scores: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The best label of every word; ``first`` has the number of words before each text.

    All texts advance together, the longest first, so that a step is one operation over those not at their end.
    """
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = first[:-1][order], sizes[order]
    langs = scores.shape[1]
    back = np.zeros(scores.shape, dtype=np.int16)
    own = np.arange(langs)
    active = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), "right")
    best = np.zeros((len(sizes), langs), dtype=np.float32)
    for t, n in enumerate(active):
        at = starts[:n] + t
        if t == 0:
            best[:n] = scores[at]
            continue
        now = best[:n]
        top = now.argmax(axis=1)
        changed = now[np.arange(n), top][:, None] - SWITCH
        stay = now >= changed
        back[at] = np.where(stay, own, top[:, None])
        best[:n] = np.where(stay, now, changed) + scores[at]
    labels = np.zeros(len(scores), dtype=np.int16)
    state = best.argmax(axis=1).astype(np.int16)
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        labels[at] = state[:n]
        state[:n] = back[at, state[:n]] if t else state[:n]
    return labels


_RESULT = "lang_pred string, score double, spans array<struct<begin:long,stop:long,lang:string>>"


def _spans(labels, begins, stops, first, model) -> pa.Array:
    """Maximal runs of words of one language per text, as character ranges."""
    cut = np.ones(len(labels), dtype=bool)
    cut[1:] = labels[1:] != labels[:-1]
    cut[first[:-1][np.diff(first) > 0]] = True
    heads = np.flatnonzero(cut)
    tails = np.append(heads[1:], len(labels)) - 1
    names = pa.DictionaryArray.from_arrays(pa.array(labels[heads].astype(np.int32)), pa.array(model.langs, pa.string()))
    entries = pa.StructArray.from_arrays(
        [pa.array(begins[heads]), pa.array(stops[tails]), names.cast(pa.string())], ["begin", "stop", "lang"]
    )
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(heads, first).astype(np.int32)), entries)


def label_texts(texts: list[str | None], model: Model) -> tuple[pa.Array, pa.Array, pa.Array]:
    points, offsets, letter = _points(texts)
    inside = letter
    begins = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    stops = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    first = np.searchsorted(begins, offsets)
    if not len(begins) or not model.langs:
        n = len(texts)
        return pa.array([UNDETERMINED] * n), pa.array([0.0] * n), pa.array([[]] * n, pa.list_(
            pa.struct([("begin", pa.int64()), ("stop", pa.int64()), ("lang", pa.string())])))
    grams = np.zeros(len(points), dtype=np.int64)
    grams[1:-1] = _grams(points, letter)
    scores = np.empty((len(begins), len(model.langs)), dtype=np.float32)
    total = np.zeros(len(points) + 1, dtype=np.float32)
    for k in range(len(model.langs)):
        np.cumsum(np.where(inside, model.weights[:, k][grams], 0.0), out=total[1:])
        scores[:, k] = total[stops] - total[begins]
    del grams, total
    held = model.allowed[_scripts(points[begins])]  # the script of the first letter stands for the word
    scores = np.where(held | ~held.any(axis=1)[:, None], scores, -1e6)
    scores -= scores.max(axis=1)[:, None]
    labels = _viterbi(scores, first)

    sizes = stops - begins
    owner = flat.owners(first)
    mass = np.zeros((len(texts), len(model.langs)))
    np.add.at(mass, (owner, labels), sizes)
    winner, letters = mass.argmax(axis=1), mass.sum(axis=1)
    share = np.where(letters > 0, mass.max(axis=1) / np.maximum(letters, 1), 0.0)
    names = [model.langs[w] if n else UNDETERMINED for w, n in zip(winner.tolist(), letters.tolist())]
    offset = 1 + offsets[owner]  # a gap stands before each text
    return pa.array(names), pa.array(share), _spans(labels, begins - offset, stops - offset, first, model)


def identify(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, the language with most letters, its share of all letters, and the spans of each language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers per language
    wanted = docs.select(*keep, F.col("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in flat.pieces(batch, "_text", AT_ONCE):
                out = label_texts(part.column("_text").to_pylist(), shared.value)
                kept = [part.column(name) for name in keep]
                yield pa.RecordBatch.from_arrays([*kept, *out], [*keep, "lang_pred", "score", "spans"])

    schema = StructType([*docs.select(*keep).schema.fields, *StructType.fromDDL(_RESULT).fields])
    return wanted.mapInArrow(run, schema)
