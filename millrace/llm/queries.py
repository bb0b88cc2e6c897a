"""The registered queries of this subpackage: each operator over its whole table, with what a contract asks of it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    chat,
    exact_dedup,
    langid,
    near_dup,
    oracles,
    packing,
    pieces,
    quality_rules,
    resampling,
    token_counts,
    url_filters,
    variants,
    vector_dedup,
    warc,
)
from millrace.session import use_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


def held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1


def languages(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """A document without ``doc_id`` is not held out, and not learned from either."""
    model = langid.fit(docs.filter(~held_out()))
    return langid.identify(docs, model, keep)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = languages(table(spark, sf_dir, "documents"))
    return labelled.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "spans")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every text in chunks, each with the checksum of the text that its ids decode to."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = pieces.decode(pieces.encode(table(spark, sf_dir, "documents"), path), path)
    return coded.select("doc_id", "chunk", "ids", F.crc32("text").alias("text_crc32"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.remove_repeats(table(spark, sf_dir, "documents"))


#: Verdicts that are given; the longest that fits a url decides.
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables label documents only; a page counts as labelled like the document of its number."""
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad)
    return url_filters.filter_urls(table(spark, sf_dir, "pages"), labels, URL_RULES)


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages"), CAPTURED))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a new cache, so that all distinct texts are encoded."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


#: The pages carry no time of capture.
CAPTURED = "2024-01-15T00:00:00Z"

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_language_id": op2_language_id,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_url_filters": op5_url_filters,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_quality_rules": op9_quality_rules,
    "op10_warc_derivatives": op10_warc_derivatives,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_token_counts": op13_token_counts,
}

ORACLES = {
    "op11_spelling_variants": oracles.SPELLING_VARIANTS,
    "op12_importance_resampling": oracles.IMPORTANCE_RESAMPLING,
}
