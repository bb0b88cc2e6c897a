"""Compare a registered query with its SQL: same columns, types, row count and values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _type(kind: str) -> str:
    kind = str(kind)
    return {"BIGINT": "int64", "INTEGER": "int32", "VARCHAR": "string", "DOUBLE": "double",
            "BOOLEAN": "bool", "TIMESTAMP": "timestamp[us]"}.get(kind, kind)


def _key(row: tuple) -> tuple:
    return tuple((value is None, "nan" if isinstance(value, float) and math.isnan(value) else value) for value in row)


def differences(df, con, sql: str) -> list[str]:
    got = df.toArrow()
    names = sorted(got.column_names)
    rel = con.sql(sql)
    problems = []
    if sorted(rel.columns) != names:
        return [f"columns {names} vs {sorted(rel.columns)}"]
    kinds = dict(zip(rel.columns, rel.types))
    for name in names:
        if str(got.schema.field(name).type) != _type(kinds[name]):
            problems.append(f"type of {name}: {got.schema.field(name).type} vs {kinds[name]}")
    quoted = ", ".join(f'"{n}"' for n in names)
    want = [tuple(r) for r in con.execute(f"SELECT {quoted} FROM ({sql})").fetchall()]
    have = list(zip(*[got.column(n).to_pylist() for n in names])) if names else []
    if len(want) != len(have):
        problems.append(f"rows {len(have)} vs {len(want)}")
    want, have = sorted(want, key=_key), sorted(have, key=_key)
    wrong = [(h, w) for h, w in zip(have, want) if _key(h) != _key(w)]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return problems
