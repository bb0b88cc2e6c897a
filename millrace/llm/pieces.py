"""SentencePiece encoding and decoding by a max-plus scan over pieces, in parallel within giant documents.

A byte-pair model cuts a text into the only sequence of pieces of which every two neighbours would be left as they are
if just those two were merged: a merge never crosses a border of the result, so that any part of it is the result for
that part; and if a merge did cross the border of two such neighbours, it would do so for the two alone. So the weight
of a step from piece to piece is 0 where merging their text gives back the two, and minus infinity elsewhere, and the
best path, of weight 0, has the ids of the library.

Words are separated by spaces that no piece crosses, so that distinct words are solved once: texts are cut into words and
words numbered over whole Arrow arrays, and ids gathered by those numbers. A giant document is split into chunks at fixed
places, also within a word. A border's state is the piece that reaches or crosses it. Each chunk gives the matrix from
the states of its left border to those of its right one. Matrices are multiplied in a tree, ``FAN`` neighbours at a
time, each product in a task of its own; back down the tree, the states at the ends of a product give those at the borders
within it, until every chunk is traced back on its own. Nothing holds more than ``FAN`` matrices of a document.

Defined cases: a null or empty text has no ids and one empty chunk; characters outside the vocabulary become byte
pieces; repeated rows are encoded alike, and so are rows without ``doc_id``; an empty table gives no rows; other
columns are not read. As in the library, U+2581 decodes to a space.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import flat
from millrace.llm.groups import changes, whole_groups
from millrace.llm.tables import written

SPACE = "▁"
#: Characters from which a document is giant, and the size of its chunks.
CHUNK = 1 << 15
#: Neighbouring matrices that are multiplied at once.
FAN = 64
#: Entries of a worker's memories of words and pairs.
REMEMBERED = 200_000

_WORDS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


class Pieces:
    """The vocabulary of a model file, and the exact segmentation of short strings."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        normal = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.ids = {model.id_to_piece(i): i for i in normal}
        self.scores = {model.id_to_piece(i): model.get_score(i) for i in normal}
        self.byte_ids = {int(model.id_to_piece(i)[3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.longest = max(map(len, self.ids))
        crossing = [p for p in self.ids if SPACE in p.lstrip(SPACE)]
        if crossing or len(self.byte_ids) != 256:
            raise ValueError("a model whose pieces do not cross spaces, with byte pieces, is needed")
        self.bytes = {i: p.encode() for p, i in self.ids.items()} | {i: bytes([b]) for b, i in self.byte_ids.items()}
        self._codes = {p: i.to_bytes(4, "little") for p, i in self.ids.items()}
        #: Lengths of the pieces that begin with two characters, longest first; one character always is a candidate.
        found: dict[str, set[int]] = {}
        for piece in self.ids:
            found.setdefault(piece[:2], {1}).add(len(piece))
        self.sizes = {start: tuple(sorted(sizes, reverse=True)) for start, sizes in found.items()}
        #: The characters of longer pieces by number, 0 for all others, and which stand next to each other in a piece.
        chars = sorted({c for piece in self.ids if len(piece) > 1 for c in piece})
        self.alphabet = np.zeros(0x110000, dtype=np.int32)
        self.alphabet[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.alphabet[0x20] = self.alphabet[ord(SPACE)]
        self.joins = np.zeros((len(chars) + 1) ** 2, dtype=bool)
        number = {c: k + 1 for k, c in enumerate(chars)}
        pairs = {(number[a], number[b]) for piece in self.ids for a, b in zip(piece, piece[1:])}
        self.joins[[a * (len(chars) + 1) + b for a, b in pairs]] = True
        self._words: dict[str, bytes] = {}
        self._pairs: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """Merging by rank: the best-scored neighbours first, the leftmost of equal ones."""
        parts, never, score = list(text), -np.inf, self.scores.get
        gains = [score(a + b, never) for a, b in zip(parts, parts[1:])]
        while gains and (best := max(gains)) > never:
            i = gains.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del gains[i]
            if i < len(gains):
                gains[i] = score(parts[i] + parts[i + 1], never)
            if i:
                gains[i - 1] = score(parts[i - 1] + parts[i], never)
        return parts

    def adjacent(self, a: str | None, b: str) -> bool:
        """Whether the step from piece ``a`` (None: a border) to ``b`` has weight 0."""
        key = (a or "", b)
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= REMEMBERED:
                self._pairs.clear()
            known = self._pairs[key] = self.merged((a or "") + b) == ([a, b] if a else [b])
        return known

    def lattice(self, text: str, before: str | None) -> list[str | None]:
        """For each place in ``text`` the last piece of the best path to it, or None; ``before`` is the piece before."""
        last: list[str | None] = [None] * (len(text) + 1)
        for end in range(1, len(text) + 1):
            for start in range(end - 1, max(-1, end - 1 - self.longest), -1):
                piece = text[start:end]
                if end - start > 1 and piece not in self.ids:
                    continue
                if start and last[start] is None:
                    continue
                if self.adjacent(last[start] if start else before, piece):
                    last[end] = piece
                    break
        return last

    def best(self, text: str) -> list[str]:
        """The best path to the end of ``text``, depth first and longest piece first.

        One path at most leads to a place, so that a place that leads nowhere is never looked at again.
        """
        n, known, sizes = len(text), self._pairs, self.sizes
        path: list[str] = []
        before, at, most, dead = "", 0, self.longest, set()
        while at < n:
            for size in sizes.get(text[at : at + 2], (1,)):
                end = at + size
                if size > most or end > n or end in dead:
                    continue
                piece = text[at:end]
                if piece not in self.ids and size > 1:
                    continue
                fits = known.get((before, piece))
                if fits or (fits is None and self.adjacent(before, piece)):
                    path.append(piece)
                    before, at, most = piece, end, self.longest
                    break
            else:
                dead.add(at)
                most = len(before) - 1
                at -= len(path.pop())
                before = path[-1] if path else ""
        return path

    @staticmethod
    def path(last: list[str | None], end: int) -> list[str]:
        out = []
        while end:
            out.append(last[end])
            end -= len(out[-1])
        return out[::-1]

    def encoded(self, pieces: list[str]) -> bytes:
        """Ids as little-endian 32-bit numbers; a piece outside the vocabulary is a character, given by its bytes."""
        known = self._codes.get
        return b"".join([known(p) or b"".join([self.byte_ids[b].to_bytes(4, "little") for b in p.encode()]) for p in pieces])

    def word(self, text: str) -> bytes:
        known = self._words.get(text)
        if known is None:
            if len(self._words) >= REMEMBERED:
                self._words.clear()
            known = self.encoded(self.best(text))
            if len(text) <= 64:
                self._words[text] = known
        return known

    def whole(self, text: str) -> bytes:
        """Ids of a normalised text."""
        known = self._words.get
        return b"".join([known(word) or self.word(word) for word in _WORDS.findall(text)])


_loaded: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def normalised(text: str | None) -> str:
    """The text that pieces are cut from: a space in front, spaces as ``SPACE``."""
    return SPACE + text.replace(" ", SPACE) if text else ""


# A border state is the piece that starts before the border and ends at or behind it: characters before, and length.


def _states(model: Pieces, text: str, border: int) -> list[tuple[int, int]]:
    """States of a border within ``text``, which holds the characters around it."""
    found = [(1, 1)] if text[border - 1] not in model.ids else []
    for start in range(max(0, border - model.longest), border):
        for end in range(border, min(len(text), start + model.longest) + 1):
            if text[start:end] in model.ids:
                found.append((border - start, end - start))
    return found


def _walk(model: Pieces, text: str, begin: int, before: str | None, border: int, last: bool) -> dict[tuple[int, int], list]:
    """From ``begin``, behind the piece ``before``: every reachable state of ``border`` with the way to it.

    A way is a list of strings that are solved on their own, and the pieces of the first and last stretch.
    """
    gaps = [m.start() for m in re.finditer(f"(?<!{SPACE}){SPACE}", text[begin:border])]
    gaps = [begin + g for g in gaps if begin + g > begin or (before and not before.endswith(SPACE))]
    head: list = []
    if gaps:
        first = gaps[0]
        if first > begin:
            lattice = model.lattice(text[begin:first], before)
            if lattice[-1] is None:
                return {}
            head = [model.path(lattice, first - begin)]
        head += _WORDS.findall(text[first : gaps[-1]])
        begin, before = gaps[-1], None
    stop = border if last else min(len(text), border + model.longest - 1)
    lattice = model.lattice(text[begin:stop], before)
    ways = {}
    for end in range(border, stop + 1):
        piece = lattice[end - begin] if end > begin else None
        if piece is None:
            continue
        start = end - len(piece)
        if start < border and start >= begin:
            ways[(border - start, len(piece))] = [*head, model.path(lattice, end - begin)]
    if border < begin or (border == begin and before is not None and not gaps):
        ways[(border - begin + len(before), len(before))] = head  # the piece before reaches over this border, too
    return ways


#: What tells a giant document: its ``doc_id``, its characters and a hash of its text.
_OWNER = ("owner", "size", "row")
_OWNED = "owner long, size long, row long"

SPLIT = f"doc_id long, {_OWNED}, chunk int, last boolean, border int, length int, context string"


def _split(longest: int, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, *owner, text in zip(*(c.to_pylist() for c in batch.columns)):
                text = normalised(text)
                starts = range(0, len(text), chunk)
                rows = []
                for k, at in enumerate(starts):
                    low, size = max(0, at - longest), min(chunk, len(text) - at)
                    context = text[low : at + size + longest]
                    rows.append((doc_id, *owner, k, k == len(starts) - 1, at - low, size, context))
                kinds = [*[pa.int64()] * 4, pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.string()]
                names = ["doc_id", *_OWNER, "chunk", "last", "border", "length", "context"]
                for at in range(0, len(rows), 64):
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[at : at + 64]), kinds)], names)

    return run


def _ways(model: Pieces, row: dict, only: tuple[int, int] | None = None) -> Iterator[tuple[tuple[int, int], dict]]:
    """Entry states of a chunk with the states they lead to; (0, 0) is the border before the first chunk."""
    text, border = row["context"], row["border"]
    entries = [only] if only else (_states(model, text, border) if row["chunk"] else [(0, 0)])
    for back, size in entries:
        begin = border - back + size
        before = text[border - back : begin] or None
        yield (back, size), _walk(model, text, begin, before, border + row["length"], row["last"])


#: A product of neighbouring matrices: the states on its left that lead to states on its right.
PRODUCT = f"{_OWNED}, chunk int, steps array<array<int>>"
_STEPS = pa.list_(pa.list_(pa.int32()))


def _products(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [*[pa.int64()] * 3, pa.int32(), _STEPS]
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*_OWNER, "chunk", "steps"])


def _matrices(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                steps = [[*enter, *leave] for enter, ways in _ways(model, row) for leave in ways]
                out.append((*(row[k] for k in _OWNER), row["chunk"], steps))
            yield _products(out)

    return run


def product(one: list[list[int]], other: list[list[int]]) -> list[list[int]]:
    """The max-plus product of two matrices with weights 0 and minus infinity, each given by its steps of weight 0."""
    onward: dict[tuple, list] = {}
    for a, b, c, d in other:
        onward.setdefault((a, b), []).append((c, d))
    found = {(a, b, *leave) for a, b, c, d in one for leave in onward.get((c, d), ())}
    return [list(step) for step in sorted(found)]


def _multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The product of the matrices of each group."""
    for table in whole_groups(batches, [*_OWNER, "upper"]):
        heads, rows = changes(table, [*_OWNER, "upper"]), table.to_pylist()
        out = []
        for lo, hi in zip(heads, [*heads[1:], len(rows)]):
            steps = reduce(product, (row["steps"] for row in rows[lo:hi]))
            out.append((*(rows[lo][k] for k in _OWNER), rows[lo]["upper"], steps))
        yield _products(out)


#: The states at the ends of a product on the way of weight 0; none are known of a whole document but its ends.
STATES = f"{_OWNED}, chunk int, enter array<int>, leave array<int>"


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states at the ends of the matrices of each group, from those at the ends of their product: forward from the one, back from
    the other."""
    for table in whole_groups(batches, [*_OWNER, "upper"]):
        heads, rows = changes(table, [*_OWNER, "upper"]), table.to_pylist()
        out = []
        for lo, hi in zip(heads, [*heads[1:], len(rows)]):
            group = rows[lo:hi]
            reached, backs = {tuple(group[0]["from"] or (0, 0))}, []
            for row in group:
                backs.append({(c, d): (a, b) for a, b, c, d in row["steps"] if (a, b) in reached})
                reached = set(backs[-1])
            # the last piece of a document ends with the text
            state = tuple(group[0]["to"]) if group[0]["to"] else next(s for s in reached if s[0] == s[1])
            for row, back in zip(reversed(group), reversed(backs)):
                out.append((*(row[k] for k in _OWNER), row["chunk"], list(back[state]), list(state)))
                state = back[state]
        kinds = [*[pa.int64()] * 3, pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], [*_OWNER, "chunk", "enter", "leave"])


def _border_states(matrices: DataFrame, fan: int) -> DataFrame:
    """The states at the ends of every chunk: up the tree by products of ``fan`` neighbours, down again by their ends."""
    upper = F.floor(F.col("chunk") / fan).cast("int").alias("upper")
    group, order = [*_OWNER, "upper"], [*_OWNER, "upper", "chunk"]
    levels = [written(matrices, "matrices")]
    while (levels[-1].agg(F.max("chunk")).first()[0] or 0) >= fan:
        dealt = levels[-1].select(*_OWNER, upper, "chunk", "steps").repartition(*group).sortWithinPartitions(*order)
        levels.append(written(dealt.mapInArrow(_multiplied, PRODUCT), "products"))
    none = F.lit(None).cast("array<int>")
    states = None
    for level in reversed(levels):
        rows = level.select(*_OWNER, upper, "chunk", "steps")
        if states is None:
            rows = rows.withColumns({"from": none, "to": none})
        else:
            ends = states.select(*_OWNER, F.col("chunk").alias("upper"), F.col("enter").alias("from"), F.col("leave").alias("to"))
            rows = rows.join(ends, group)
        dealt = rows.repartition(*group).sortWithinPartitions(*order)
        states = written(dealt.mapInArrow(_walked, STATES), "states")
    return states


def _traced(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                (_, ways), = _ways(model, row, tuple(row["enter"]))
                way = ways[tuple(row["leave"])]
                ids = b"".join(model.word(part) if isinstance(part, str) else model.encoded(part) for part in way)
                out.append((row["doc_id"], row["chunk"], np.frombuffer(ids, "<i4")))
            yield _id_batch(*zip(*out)) if out else _id_batch([], [], [])

    return run


ENCODED = "doc_id long, chunk int, ids array<int>"


def _id_batch(doc_id, chunk, ids) -> pa.RecordBatch:
    sizes = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    values = np.concatenate(ids) if len(ids) else np.zeros(0, np.int32)
    lists = pa.ListArray.from_arrays(pa.array(sizes), pa.array(values.astype(np.int32)))
    return pa.RecordBatch.from_arrays([pa.array(doc_id, pa.int64()), pa.array(chunk, pa.int32()), lists], ["doc_id", "chunk", "ids"])


def _cut_words(model: Pieces, column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, with the space in front that every text gets, and for each text the words before it (one more).

    A text is cut between any two characters that stand next to each other in no piece: no piece crosses such a place, so that the
    words are cut into pieces each on its own. That is so before spaces, and mostly around marks and digits.
    """
    data, offsets = flat.texts(column)
    size = np.diff(offsets)
    some = size > 0
    data = np.insert(data, offsets[:-1][some], 0x20)
    bounds = np.concatenate([[0], np.cumsum(size + some)])
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    number = model.alphabet[points]
    width = int(len(model.joins) ** 0.5)
    begins = np.ones(len(points), dtype=bool)
    begins[1:] = ~model.joins[number[:-1] * width + number[1:]]
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    begins[np.searchsorted(heads, bounds[:-1][some])] = True
    starts = heads[begins]
    places = np.append(starts, len(data)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data)))
    return words, np.searchsorted(starts, bounds)


def _gathered(model: Pieces, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, and for each text the ids before it (one more); each distinct word is looked up once."""
    words, first = _cut_words(model, column)
    coded = words.dictionary_encode()
    solved = [model.word(word.replace(" ", SPACE)) for word in coded.dictionary.to_pylist()]
    held = np.frombuffer(b"".join(solved), "<i4")
    begin = np.concatenate([[0], np.cumsum([len(ids) // 4 for ids in solved])]).astype(np.int64)
    which = coded.indices.to_numpy()
    count = np.diff(begin)[which]
    ends = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(ends[-1]) + np.repeat(begin[:-1][which] - ends[:-1], count)
    return held[at], ends[first]


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            for part in flat.pieces(batch, "text"):
                column = part.column("text")
                if pc.any(pc.match_substring(column, SPACE)).as_py():  # that character is a space to the library
                    column = pc.replace_substring(column, SPACE, " ")
                ids, ends = _gathered(model, column)
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
                chunks = pa.array(np.zeros(part.num_rows, np.int32))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), chunks, lists], ["doc_id", "chunk", "ids"])

    return run


def encode(docs: DataFrame, path: str, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """``doc_id``, ``chunk`` and the ids of each chunk; documents of up to ``chunk`` characters have one."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    giant = F.coalesce(F.char_length("text"), F.lit(0)) > chunk
    plain = rows.filter(~giant).mapInArrow(_encoded(path), ENCODED)
    longest = pieces(path).longest
    owner = [F.coalesce("doc_id", F.lit(-(1 << 63))).alias("owner"), F.char_length("text").cast("long").alias("size"), F.xxhash64("doc_id", "text").alias("row")]
    named = rows.filter(giant).select("doc_id", *owner, "text")
    split = written(named.mapInArrow(_split(longest, chunk), SPLIT).repartition(*_OWNER, "chunk"), "chunks")
    matrices = split.mapInArrow(_matrices(path), PRODUCT).dropDuplicates([*_OWNER, "chunk"])  # equal rows have equal ones
    states = _border_states(matrices, fan)
    traced = split.join(states, [*_OWNER, "chunk"]).mapInArrow(_traced(path), ENCODED)
    return plain.union(traced)


def _id_ends(ids: pa.Array) -> np.ndarray:
    """For each list the ids before it (one more)."""
    return np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy())]).astype(np.int64)


def _id_slices(batch: pa.RecordBatch, most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``most`` ids each, or a single row."""
    ends, at = _id_ends(batch.column("ids")), 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
        yield batch.slice(at, stop - at)
        at = stop
    flat.release()


def _decoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        table = pa.array([model.bytes.get(i) for i in range(max(model.bytes) + 1)], pa.binary())
        for batch in batches:
            for part in _id_slices(batch):
                ids = part.column("ids")
                data, offsets = flat.texts(table.take(ids.flatten()))
                ends = offsets[_id_ends(ids)]
                texts = []
                for chunk, lo, hi in zip(part.column("chunk").to_pylist(), ends[:-1], ends[1:]):
                    text = data[lo:hi].tobytes().decode("utf-8", "replace").replace(SPACE, " ")
                    texts.append(text[1:] if chunk == 0 and text.startswith(" ") else text)
                columns = [part.column("doc_id"), part.column("chunk"), ids, pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "chunk", "ids", "text"])

    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with the text of each chunk; the chunks of a document in order give its text."""
    return encoded.select("doc_id", "chunk", "ids").mapInArrow(_decoded(path), ENCODED + ", text string")
