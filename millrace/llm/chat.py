"""Chat formatting with minimum-cost role repair.

Legal conversations are the words of an automaton: an optional ``system`` turn, then ``user`` and ``assistant`` in
turn, ending with either. Each given turn keeps its role or is relabelled; it opens a turn, or merges into the last one
if that has its role; and an empty turn may be inserted before it. Dynamic programming over the states of the automaton
chooses what costs least. The cost of a chunk of turns between any two states is a small matrix, so that a long
conversation is split into chunks: matrices first, then one pass over them fixes the states at the borders, then every
chunk is traced back and rendered on its own. The rendered parts of a conversation follow each other without a gap.

A text cannot forge a turn: where it has ``<|``, or that with backslashes between, one backslash more is put in, which
``unescaped`` takes out.

Defined cases: turns are ordered by ``turn``, role and text, those without ``turn``, role or text last, at any number of
rows; a null or unknown role can be relabelled to any; a null text is empty; rows that repeat a turn word for word are one turn; every row without
``conv_id`` is a conversation of its own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.groups import changes, whole_groups
from millrace.llm.tables import written

ROLES = ("system", "user", "assistant")
START = len(ROLES)
#: Which role may open behind which state; the last row is the start.
FOLLOWS = {0: (1,), 1: (2,), 2: (1,), START: (0, 1)}
STATES = len(ROLES) + 1

MERGE, RELABEL, INSERT = 1, 3, 4
#: Values of ``turn`` that share a chunk, and rows of a chunk from which its turns are chunks of their own.
CHUNK = 1024

NEVER = 1 << 40


def _steps() -> tuple[np.ndarray, np.ndarray]:
    """Cost of opening or merging into a turn of role q from state s, and the role inserted before it (-1: none, -2: merged)."""
    cost = np.full((STATES, STATES), NEVER, dtype=np.int64)
    how = np.full((STATES, STATES), -1, dtype=np.int64)
    for s in range(STATES):
        for q in range(len(ROLES)):
            options = [(MERGE, -2)] if s == q else []
            options += [(0, -1)] if q in FOLLOWS[s] else []
            options += [(INSERT, w) for w in FOLLOWS[s] if q in FOLLOWS[w]]
            if options:
                cost[s, q], how[s, q] = min(options)
    return cost, how


_COST, _HOW = _steps()


def turn_costs(role: str | None) -> np.ndarray:
    """States by states: the least cost of taking a turn of ``role`` from one to the other."""
    relabel = np.array([0 if role == name else RELABEL for name in ROLES] + [NEVER], dtype=np.int64)
    return np.minimum(_COST + relabel, NEVER)


_OF_ROLE = {name: turn_costs(name) for name in (*ROLES, None)}


def _matrix(role: str | None) -> np.ndarray:
    return _OF_ROLE.get(role, _OF_ROLE[None])


def chunk_costs(roles: list[str | None]) -> np.ndarray:
    """The min-plus product of the matrices of a chunk."""
    total = np.where(np.eye(STATES, dtype=bool), 0, NEVER)
    for role in roles:
        total = np.minimum((total[:, :, None] + _matrix(role)[None]).min(axis=1), NEVER)
    return total


def trace(roles: list[str | None], enter: int, leave: int) -> list[int]:
    """The states after each turn on the least costly way from ``enter`` to ``leave``; of equal ones the first."""
    cost = np.full(STATES, NEVER, dtype=np.int64)
    cost[enter] = 0
    backs = []
    for role in roles:
        ways = cost[:, None] + _matrix(role)
        backs.append(ways.argmin(axis=0))
        cost = ways.min(axis=0)
    states = [leave]
    for back in reversed(backs):
        states.append(int(back[states[-1]]))
    return states[::-1][1:]


def _keyed(turns: DataFrame) -> DataFrame:
    """Turns with the chunk they are in; those without ``turn`` are spread over chunks of their own by a hash."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    named, nameless = rows.filter("conv_id IS NOT NULL").distinct(), rows.filter("conv_id IS NULL")
    named = named.select(F.lit(0).alias("nameless"), F.col("conv_id").alias("conv"), "turn", "role", "text")
    nameless = nameless.select(F.lit(1).alias("nameless"), F.monotonically_increasing_id().alias("conv"), "turn", "role", "text")
    behind = F.lit(1 << 54) + F.pmod(F.xxhash64("role", "text"), F.lit(CHUNK))
    chunk = F.coalesce(F.floor(F.col("turn") / CHUNK), behind).alias("chunk")
    return named.union(nameless).select("nameless", "conv", chunk, "turn", "role", "text")


def _ordered() -> list[Column]:
    return [F.col(c) for c in ("nameless", "conv", "chunk")] + [F.col(c).asc_nulls_last() for c in ("turn", "role", "text")]


def _numbered(chunk: int):
    """A slot for every ``chunk`` rows of a range partition; slots of later ranges are larger."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, n = (context.partitionId() if context else 0), 0
        for batch in batches:
            slot = 1 + (part << 40) + np.arange(n, n + batch.num_rows) // chunk
            n += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(slot, pa.int64())], [*batch.schema.names, "slot"])

    return run


def _slotted(rows: DataFrame) -> DataFrame:
    """``rows`` with a ``slot``: 0, or in a chunk of more than ``CHUNK`` rows one for each ``CHUNK`` rows or fewer, in their
    order, so that whatever is read of it at once is bounded."""
    keys = ["nameless", "conv", "chunk"]
    crowded = rows.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > CHUNK).drop("n")
    crowd = written(crowded, "crowd")
    if crowd.isEmpty():
        return rows.withColumn("slot", F.lit(0).cast("long"))
    dealt = rows.join(crowd, keys, "left_semi").select(*rows.columns).repartitionByRange(*_ordered()).sortWithinPartitions(*_ordered())
    fields = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    slots = written(dealt.mapInArrow(_numbered(CHUNK), f"{fields}, slot long"), "slots")
    rest = rows.join(crowd, keys, "left_anti").select(*rows.columns, F.lit(0).cast("long").alias("slot"))
    return rest.unionByName(slots)


_KEYS = ["nameless", "conv", "chunk", "slot"]


def _costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches, _KEYS):
        heads = changes(table, _KEYS)
        roles = table.column("role").to_pylist()
        costs = [chunk_costs(roles[lo:hi]).ravel().tolist() for lo, hi in zip(heads, [*heads[1:], table.num_rows])]
        keys = [table.column(k).take(pa.array(heads)).combine_chunks() for k in _KEYS]
        yield pa.RecordBatch.from_arrays([*keys, pa.array(costs, pa.list_(pa.int64()))], [*_KEYS, "costs"])


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Enter and leave state of every chunk of a conversation, from the costs of its chunks."""
    for table in whole_groups(batches, _KEYS[:2]):
        heads = changes(table, _KEYS[:2])
        costs = table.column("costs").combine_chunks().flatten().to_numpy().reshape(-1, STATES, STATES)
        enter, leave = np.zeros(table.num_rows, np.int32), np.zeros(table.num_rows, np.int32)
        total, last = np.zeros(table.num_rows, np.int64), np.zeros(table.num_rows, bool)
        for lo, hi in zip(heads, [*heads[1:], table.num_rows]):
            cost = np.full(STATES, NEVER, dtype=np.int64)
            cost[START] = 0
            backs = []
            for k in range(lo, hi):
                ways = cost[:, None] + costs[k]
                backs.append(ways.argmin(axis=0))
                cost = ways.min(axis=0)
            final = 1 + int(cost[1:START].argmin()) if hi > lo else START  # user or assistant
            total[lo:hi], last[hi - 1], state = cost[final], True, final
            for k in range(hi - 1, lo - 1, -1):
                leave[k], enter[k] = state, backs[k - lo][state]
                state = enter[k]
        keys = [table.column(k).combine_chunks() for k in _KEYS]
        yield pa.RecordBatch.from_arrays(
            [*keys, pa.array(enter), pa.array(leave), pa.array(total), pa.array(last)], [*_KEYS, "enter", "leave", "cost", "last"]
        )


_MARK = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<(\\*)\\\|")


def escaped(text: str) -> str:
    """The text without ``<|``: a backslash more wherever one could have been put in."""
    return _MARK.sub(r"<\1\\|", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def render(roles: list[str | None], texts: list[str | None], enter: int, states: list[int], last: bool) -> tuple[str, dict[str, int]]:
    """The part of the rendered conversation that a chunk gives, and how often each repair was made."""
    out, counts, state = [], {"turns": 0, "merged": 0, "relabelled": 0, "inserted": 0}, enter
    for role, text, q in zip(roles, texts, states):
        how = int(_HOW[state, q])
        if how == -2:
            out.append("\n")
            counts["merged"] += 1
        else:
            for name in ([ROLES[how]] if how >= 0 else []) + [ROLES[q]]:
                out.append(("" if state == START and not out else "<|end|>\n") + f"<|{name}|>\n")
                counts["turns"] += 1
            counts["inserted"] += how >= 0
        out.append(escaped(text or ""))
        counts["relabelled"] += role != ROLES[q]
        state = q
    return "".join(out) + ("<|end|>\n" if last else ""), counts


RENDERED = "nameless int, conv long, part long, slot long, cost long, turns int, merged int, relabelled int, inserted int, rendered string"


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches, _KEYS):
        heads = changes(table, _KEYS)
        roles, texts = table.column("role").to_pylist(), table.column("text").to_pylist()
        fixed = [table.column(c).to_numpy() for c in ("nameless", "conv", "chunk", "slot", "cost", "enter", "leave", "last")]
        rows = []
        for lo, hi in zip(heads, [*heads[1:], table.num_rows]):
            nameless, conv, chunk, slot, cost, enter, leave, last = (c[lo] for c in fixed)
            states = trace(roles[lo:hi], int(enter), int(leave))
            text, counts = render(roles[lo:hi], texts[lo:hi], int(enter), states, bool(last))
            rows.append((nameless, conv, chunk, slot, cost, *counts.values(), text))
        kinds = [pa.int32(), *[pa.int64()] * 4, *[pa.int32()] * 4, pa.string()]
        names = [part.split()[0] for part in RENDERED.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``part``, ``slot``, the cost of the conversation's repair, repairs of the part and its rendered text.

    A conversation whose turns span no more than ``CHUNK`` and which has no more rows is one part. Parts follow each other by
    ``part`` and ``slot``, which is 0 unless a part has too many rows.
    """
    rows = _slotted(written(_keyed(turns), "turns"))
    order = [*_KEYS, F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_last(), F.col("text").asc_nulls_last()]
    narrow = rows.repartition(*_KEYS).sortWithinPartitions(*order).select(*_KEYS, "role")
    costs = narrow.mapInArrow(_costs, "nameless int, conv long, chunk long, slot long, costs array<long>")
    by_conv = costs.repartition("nameless", "conv").sortWithinPartitions(*_KEYS)
    borders = by_conv.mapInArrow(_borders, "nameless int, conv long, chunk long, slot long, enter int, leave int, cost long, last boolean")
    dealt = rows.join(borders, _KEYS).repartition(*_KEYS).sortWithinPartitions(*order)
    parts = dealt.mapInArrow(_rendered, RENDERED)
    conv_id = F.when(F.col("nameless") == 0, F.col("conv")).alias("conv_id")
    return parts.select(conv_id, "part", "slot", "cost", "turns", "merged", "relabelled", "inserted", "rendered")
