"""Token counts of whole texts by way of a cache of digests.

A count depends on a tokenizer's version (its file, its library and that library's version) and on the text as the
tokenizer's own normaliser leaves it. ``token_counts`` digests every text, joins the distinct digests to the counts
stored for that version, encodes each text whose digest misses once, and appends those counts to the cache. Copies
within an Arrow batch melt before texts move, so that a common text travels once per batch; texts travel for misses
only. Counts come back to the documents by a join of two plain tables, which the engine splits where a third of all
documents have one text.

The cache is a folder of Parquet files, one subfolder per version. Appending needs no lock: two jobs that miss the same
digest at once store the same count twice, and reading takes one. A job that dies has appended all, part or nothing of
its counts; each of them is right, and what is lacking is a miss again.

Defined cases: a null text is empty and has no tokens; special strings within texts are handled as the library does by
default; repeated rows get a row each; rows without ``doc_id`` are counted too; an empty table gives no rows; columns
besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from importlib.metadata import version

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import flat
from millrace.llm.packing import Encoder
from millrace.llm.tables import written
from millrace.session import shared_dir

LIMIT = 512

CACHE_SCHEMA = "content binary, n_tokens long"


def library(path: str) -> str:
    return "sentencepiece" if path.endswith(".model") else "tokenizers"


def tokenizer_version(path: str) -> str:
    """A digest of the file with the library that reads it and its version."""
    name = library(path)
    digest = hashlib.sha256(f"{name} {version(name)}\n".encode())
    with open(path, "rb") as file:
        digest.update(file.read())
    return digest.hexdigest()


def _normaliser(path: str) -> Callable[[str], str] | None:
    """What the tokenizer does to a text before it looks for tokens; None if that is nothing.

    A text with a special string before or after is left as it is, since such strings are looked for in the raw text.
    """
    if library(path) == "sentencepiece":
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path).normalize
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    if tokenizer.normalizer is None:
        return None
    special = [token.content for token in tokenizer.get_added_tokens_decoder().values()]

    def normalised(text: str) -> str | None:
        after = tokenizer.normalizer.normalize_str(text)
        return None if any(s in text or s in after for s in special) else after

    return normalised


def _digest(normalise: Callable[[str], str] | None, raw: memoryview) -> bytes:
    """Of the normalised text, or with another first byte of the raw one."""
    if normalise is not None:
        after = normalise(str(raw, "utf-8"))
        if after is not None:
            return hashlib.sha256(b"n" + after.encode()).digest()
    digest = hashlib.sha256(b"r")
    digest.update(raw)
    return digest.digest()


def _digests(normalise, part: pa.RecordBatch) -> pa.Array:
    data, offsets = flat.texts(part.column("text"))
    view = memoryview(data)
    return pa.array([_digest(normalise, view[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], pa.binary())


def _digested(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normalise = _normaliser(path)
        for batch in batches:
            for part in flat.pieces(batch, "text"):
                _, offsets = flat.texts(part.column("text"))
                columns = [part.column("doc_id"), pa.array(offsets[1:] - offsets[:-1]), _digests(normalise, part)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "content"])

    return run


def _melted(path: str):
    """The first text of each digest in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normalise = _normaliser(path)
        for batch in batches:
            seen: set[bytes] = set()
            for part in flat.pieces(batch, "text"):
                content = _digests(normalise, part)
                new = []
                for i, digest in enumerate(content.to_pylist()):
                    if digest not in seen:
                        seen.add(digest)
                        new.append(i)
                at = pa.array(new, pa.int64())
                yield pa.RecordBatch.from_arrays([content.take(at), part.column("text").take(at)], ["content", "text"])

    return run


def _counter(path: str) -> Callable[[str], int]:
    if library(path) == "sentencepiece":
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(processor.encode(text, add_bos=False, add_eos=False, num_threads=1))
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    encoder = Encoder(path)
    encoder.exact.no_truncation()
    encoder.exact.no_padding()
    return lambda text: len(encoder(text))


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path)
        for batch in batches:
            counts = [count(text.as_py() or "") for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array(counts, pa.int64())], ["content", "n_tokens"])
            flat.release()

    return run


def stored_counts(spark: SparkSession, cache: str, path: str) -> DataFrame:
    """``content`` and ``n_tokens`` of the version, each digest once."""
    try:
        rows = spark.read.schema(CACHE_SCHEMA).parquet(f"{cache}/version={tokenizer_version(path)}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], CACHE_SCHEMA)
    return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def encode_misses(docs: DataFrame, misses: DataFrame, path: str) -> DataFrame:
    """The counts of the texts whose digests are in ``misses``; each is encoded once."""
    melted = docs.select("text").mapInArrow(_melted(path), "content binary, text string")
    wanted = melted.join(misses.select("content"), "content", "left_semi").dropDuplicates(["content"])
    return wanted.mapInArrow(_encoded(path), CACHE_SCHEMA)


def token_counts(docs: DataFrame, path: str, cache: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Per row ``doc_id``, its bytes, its tokens and whether they are more than ``limit``.

    ``cache`` is a folder that all executors share; without one a new cache is begun below ``spark.checkpoint.dir``.
    """
    spark = docs.sparkSession
    cache = cache or shared_dir(spark, "token_counts")
    wanted = docs.select(F.col("doc_id").cast("long"), "text")
    digested = written(wanted.mapInArrow(_digested(path), "doc_id long, n_bytes long, content binary"), "digests")
    looked = digested.select("content").distinct().join(stored_counts(spark, cache, path), "content", "left")
    looked = written(looked, "looked_up")
    hits, misses = looked.filter("n_tokens IS NOT NULL"), looked.filter("n_tokens IS NULL")
    counts = hits
    if not misses.isEmpty():
        new = written(encode_misses(wanted, misses, path), "encoded")
        new.write.mode("append").parquet(f"{cache}/version={tokenizer_version(path)}")
        counts = hits.unionAll(new)
    found = digested.join(counts, "content")
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
