"""The corpus pipeline: language ID, quality rules, near-deduplication, suffix-array deduplication, packing.

Each stage takes what its predecessor wrote. All but the last give the columns of ``documents``.

Defined cases: null and empty texts, and those without a letter, go with the first stage; a null ``lang`` is filled with
the prediction, a null ``source`` is a group of its own; rows without ``doc_id`` pass like others, but are neither
learned from nor linked, and neither lose bytes nor remove any; of near-duplicates the least ``doc_id`` stays, rows that
repeat one stay or go together, and texts of one ``doc_id`` remove nothing from each other; long texts are taken whole;
an empty table gives no rows at every stage; other columns than those of ``documents`` are dropped by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import exact_dedup, near_dup, queries, quality_rules
from millrace.llm.tables import written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Share of letters in the leading language below which a document counts as of no one language.
LEAST_SCORE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or without a leading language go; a missing ``lang`` is filled in."""
    found = queries.languages(docs, COLUMNS)
    good = found.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return good.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the fences of their language and source reject go."""
    return quality_rules.kept_documents(docs, COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least ``doc_id`` stays, and so do those without one.

    Rows that repeat a ``doc_id`` stay or go together.
    """
    kept = near_dup.near_duplicates(docs).filter("kept").select("doc_id").distinct()
    nameless = docs.filter(F.col("doc_id").isNull()).select(*COLUMNS)
    return docs.join(kept, "doc_id", "left_semi").select(*COLUMNS).union(nameless)


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes that a document with a lesser ``doc_id`` has too go; what is left of a text stays, were it empty."""
    rest = exact_dedup.remove_repeats(docs, ("doc_id", "lang", "source"), keep_text=True)
    return rest.select("doc_id", F.col("kept_text").alias("text"), "lang", "source",
                       F.length("kept_text").cast("long").alias("n_chars"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.packed(docs)


STAGES = [
    ("language_id", language),
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("suffix_array_dedup", repeat_removal),
    ("best_fit_packing", packing),
]

#: No stage after the tables themselves is expressible in SQL: models, sketches and suffix arrays decide.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
