"""Best-fit packing of tokenised documents into sequences of a fixed length.

``token_pieces`` encodes whole texts and cuts only documents longer than a sequence. ``pack`` fills sequences with a
bounded-space online best fit: at most ``OPEN_BINS`` sequences are open in a task, a bitset has one bit for each amount
of free space that some open sequence has, and the lowest set bit at or above a piece's length finds the tightest fit.
When a further sequence is needed and all are open, the fullest closes first. Pieces come to it in runs of
``LOOKAHEAD`` tokens, longest first in a run, which leaves the short ones to fill gaps. Each task packs its own pieces,
so that there is no shuffle; what a task leaves open at its end is its only loss.

Defined cases: a null text is empty and becomes the one end token; equal texts are packed each on its own; an empty
table gives no rows; columns besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import flat

LENGTH = 2048
OPEN_BINS = 1024
LOOKAHEAD = 1 << 20
END = 0

SCHEMA = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"
_NAMES = [part.split()[0] for part in SCHEMA.split(", ")]

#: Beyond these characters Unicode tables of the two encoders could differ in age.
_RARE = re.compile("[^\0-ɏ]")


class Encoder:
    """Token ids as the ``tokenizers`` library gives them for ``<stem>.json``.

    The same vocabulary as ranks, if it lies beside the file, encodes several times as fast. It is taken for texts of
    common letters only that do not contain a special token; the ids are the same.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as file:
            self.special = [token["content"] for token in json.load(file)["added_tokens"]]
        self.path, self.fast = path, None
        ranks = path.removesuffix(".json") + ".tiktoken"
        if os.path.exists(ranks):
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                pairs = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=pairs, special_tokens={})

    @cached_property
    def exact(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is None or _RARE.search(text) or any(token in text for token in self.special):
            ids = self.exact.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, dtype="<u4")


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut(n: int, length: int) -> list[tuple[int, int]]:
    """Starts and lengths of the pieces of a document of ``n`` ids; only the first may be shorter than ``length``."""
    if n <= length:
        return [(0, n)]
    head = n % length
    return [(0, head)] * bool(head) + [(at, length) for at in range(head, n, length)]


class Bins:
    """Open sequences by their free space."""

    def __init__(self, length: int, most: int, next_id: int):
        self.length, self.most, self.next_id = length, most, next_id
        self.levels: list[list[int]] = [[] for _ in range(length + 1)]
        self.bits = 0
        self.open = 0

    def _take(self, free: int) -> int:
        bin_ = self.levels[free].pop()
        if not self.levels[free]:
            self.bits &= ~(1 << free)
        self.open -= 1
        return bin_

    def place(self, n: int) -> tuple[int, int]:
        """The sequence that a piece of ``n`` ids goes to, and its offset there."""
        fitting = self.bits >> n
        if fitting:
            free = n + (fitting & -fitting).bit_length() - 1
            bin_ = self._take(free)
        else:
            free, bin_ = self.length, self.next_id
            self.next_id += 1
        left = free - n
        if left:
            if self.open == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            self.levels[left].append(bin_)
            self.bits |= 1 << left
            self.open += 1
        return bin_, self.length - free


def _packed(path: str, length: int, open_bins: int, lookahead: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path)
        context = TaskContext.get()
        bins = Bins(length, open_bins, (context.partitionId() if context else 0) << 40)
        waiting: list[tuple] = []
        tokens = 0

        def flush() -> pa.RecordBatch:
            order = sorted(range(len(waiting)), key=lambda i: -waiting[i][3])
            placed: list = [None] * len(waiting)
            for i in order:
                placed[i] = bins.place(waiting[i][3])
            columns = [list(c) for c in zip(*(row + spot for row, spot in zip(waiting, placed)))]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _NAMES)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.append(encode(text.as_py() or ""), np.array([END], dtype="<u4"))
                for piece, (start, n) in enumerate(cut(len(ids), length)):
                    waiting.append((doc_id, piece, start, n, ids[start : start + n].tobytes()))
                    tokens += n
                    if tokens >= lookahead:
                        yield flush()
                        waiting, tokens = [], 0
        if waiting:
            yield flush()

    return run


def pack(docs: DataFrame, path: str, length: int = LENGTH, open_bins: int = OPEN_BINS, lookahead: int = LOOKAHEAD) -> DataFrame:
    """One row per piece with its ids (little-endian unsigned 32-bit), the sequence it is in and its offset there."""
    wanted = docs.select(F.col("doc_id").cast("long"), "text")
    return wanted.mapInArrow(_packed(path, length, open_bins, lookahead), SCHEMA)


def sequences(pieces: DataFrame) -> DataFrame:
    """The ids of each sequence in one value; a sequence is bounded by its length."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    hexed = F.transform(parts, lambda p: F.hex(p["ids"]))
    return pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.unhex(F.array_join(hexed, "")).alias("ids")
    )
