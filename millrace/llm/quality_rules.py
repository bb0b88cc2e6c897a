"""Quality rules with thresholds learned per language and source from mergeable quantile sketches.

``text_metrics`` measures every whole text inside its Arrow batch, without a shuffle. ``thresholds`` folds the measures
into KLL sketches, combined map-side, so that a source with a third of all rows reaches the reducers as one sketch per
task. Sketches of small groups are merged into those of their language and of all rows. ``judge`` joins the fences.

Defined cases: a null or empty text has zero words and fails the base rules; null ``lang`` or ``source`` is a group of
its own; repeated rows are judged alike, each on its own; an empty table gives an empty result; columns besides
``doc_id``, ``text``, ``lang`` and ``source`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.llm import flat
from millrace.llm.tables import discard, written

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

#: Measures with a fence: the quantile that stands for the tail of common texts, how many times its distance from the
#: median lies between it and the fence, the least that this distance counts as, and whether low values are fenced too.
#: Symbols and odd words come in whole classes of texts, up to a tenth of a group, so their tail begins before those.
FENCED = {
    "symbol_rate": (0.9, 1.0, 0.05, False),
    "dup_line_rate": (0.99, 1.0, 0.02, False),
    "repeat_rate": (0.99, 1.0, 0.01, False),
    "word_length": (0.9, 2.5, 0.1, True),
}
#: Rows a group needs for fences of its own; smaller ones take those of their language, then of all rows.
LEAST_ROWS = 200
SKETCH_K = 400


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    hit = np.zeros(len(keys), dtype=bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    return hit


def _measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    n = len(offsets) - 1
    starts, ends, first = flat.words(data, offsets)
    counted = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(((data & 0xC0) != 0x80) & ~flat.SPACES[data], out=counted[1:])
    symbols = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(SYMBOLS[data], out=symbols[1:])

    salt = flat.mix(np.arange(1, n + 1, dtype=np.uint64))
    line_s, line_e, line_first = flat.lines(data, offsets)
    wordy = np.searchsorted(starts, line_e) > np.searchsorted(starts, line_s)
    line_owner = flat.owners(line_first)
    keys = flat.mix(flat.hashes(data, line_s, line_e) + salt[line_owner])[wordy]
    _, distinct = np.unique(keys, return_index=True)
    n_lines = np.bincount(line_owner[wordy], minlength=n)
    n_distinct = np.bincount(line_owner[wordy][distinct], minlength=n)

    windows, at = flat.runs(flat.hashes(data, starts, ends), first, WINDOW)
    twice = at[repeated(flat.mix(windows + salt[flat.owners(first)[at]]))]
    edges = np.zeros(len(starts) + 1, dtype=np.int64)
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + WINDOW, -1)
    covered = np.cumsum(edges[:-1]) > 0
    return {
        "n_words": np.diff(first),
        "word_chars": counted[offsets[1:]] - counted[offsets[:-1]],
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": n_lines - n_distinct,
        "n_repeat_words": flat.sums(covered, first),
        "n_lines": n_lines,
    }


def text_metrics(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """The columns ``keep`` and counts per text: words, code points in words, symbols, repeated lines, words in
    repeated windows, lines."""
    wanted = docs.select(*keep, F.col("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in flat.pieces(batch, "_text"):
                counts = _measure(*flat.texts(part.column("_text")))
                kept = [part.column(name) for name in keep]
                found = [pa.array(counts[name].astype(np.int64)) for name in COUNTS]
                yield pa.RecordBatch.from_arrays(kept + found, [*keep, *COUNTS])

    counted = StructType([StructField(name, LongType()) for name in COUNTS])
    return wanted.mapInArrow(run, StructType([*docs.select(*keep).schema.fields, *counted.fields]))


def rates(metrics: DataFrame) -> DataFrame:
    """The fenced measures; they do not depend on the length of a text."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return metrics.withColumns(
        {
            "symbol_rate": F.col("n_symbols") / words,
            "dup_line_rate": F.col("n_dup_lines") / lines,
            "repeat_rate": F.col("n_repeat_words") / words,
            "word_length": F.col("word_chars") / words,
            "base_failed": failed,
        }
    )


def thresholds(measured: DataFrame) -> DataFrame:
    """One row per language and source with a lower and an upper fence for each measure.

    Texts that fail the base rules are not counted: they are gone anyway and would widen the fences.
    """
    sketches = [F.kll_sketch_agg_double(name, F.lit(SKETCH_K)).alias(name) for name in FENCED]
    usable = measured.filter(~F.col("base_failed"))
    own = written(usable.groupBy("lang", "source").agg(F.count("*").alias("rows"), *sketches), "sketches")
    total = [F.sum("rows").alias("rows"), *(F.kll_merge_agg_double(name).alias(name) for name in FENCED)]
    by_lang = own.groupBy("lang").agg(*total).select(F.col("lang").alias("all_of"), F.struct("rows", *FENCED).alias("of_lang"))
    over_all = own.agg(*total).first()  # one row of sketches of a fixed size
    of_all = F.struct(
        F.lit(over_all["rows"]).cast("long").alias("rows"),
        *(F.lit(over_all[name] and bytes(over_all[name])).cast("binary").alias(name) for name in FENCED),
    )
    own = own.select(F.col("lang").alias("for_lang"), F.col("source").alias("for_source"), F.struct("rows", *FENCED).alias("own"))
    joined = own.join(by_lang, F.col("for_lang").eqNullSafe(F.col("all_of"))).withColumn("of_all", of_all)
    chosen = (
        F.when(F.col("own.rows") >= LEAST_ROWS, F.col("own"))
        .when(F.col("of_lang.rows") >= LEAST_ROWS, F.col("of_lang"))
        .otherwise(F.col("of_all"))
    )
    joined = joined.withColumn("sketch", chosen)
    fences = []
    for name, (tail, reach, least, both) in FENCED.items():
        low, middle, high = (
            F.kll_sketch_get_quantile_double(F.col("sketch")[name], F.lit(q)) for q in (round(1 - tail, 6), 0.5, tail)
        )
        below = low - reach * F.greatest(middle - low, F.lit(least))
        fences.append((high + reach * F.greatest(high - middle, F.lit(least))).alias(f"{name}_high"))
        fences.append((below if both else F.lit(float("-inf"))).alias(f"{name}_low"))
    return joined.select("for_lang", "for_source", *fences)


def _judged(measured: DataFrame, fences: DataFrame) -> DataFrame:
    inside = F.lit(True)
    for name in FENCED:
        inside &= F.col(name).between(F.col(f"{name}_low"), F.col(f"{name}_high"))
    same = F.col("lang").eqNullSafe(F.col("for_lang")) & F.col("source").eqNullSafe(F.col("for_source"))
    # A group without fences has no document that passes the base rules.
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    return measured.join(fences, same, "left").withColumn("kept", kept)


def judge(docs: DataFrame) -> DataFrame:
    """Metrics of every document, whether the base rules reject it, and whether it is kept."""
    measured = rates(written(text_metrics(docs), "metrics"))
    return _judged(measured, thresholds(measured)).select("doc_id", *COUNTS[:5], "base_failed", "kept", *FENCED)


def kept_documents(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The columns ``keep`` of the documents that are kept.

    Texts are measured a second time rather than shuffled, as only the fences are joined to them.
    """
    metrics = written(text_metrics(docs), "metrics")
    fences = written(thresholds(rates(metrics)), "fences")
    discard(metrics)
    return _judged(rates(text_metrics(docs, keep)), fences).filter("kept").select(*keep)
