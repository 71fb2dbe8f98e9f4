"""Run a query in Spark and its SQL in DuckDB and compare columns, types and every value."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _sorted_rows(table) -> list[tuple]:
    names = sorted(table.column_names)
    rows = zip(*[table.column(n).to_pylist() for n in names]) if names else []
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def _kind(arrow_type) -> str:
    name = str(arrow_type).replace("large_", "")
    return "timestamp" if name.startswith("timestamp") else name


def differences(spark_df, con, sql: str, exact: bool = True) -> list[str]:
    """What differs, worst first; empty when the two agree."""
    ours = spark_df.toArrow()
    theirs = con.execute(sql).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return [f"columns {sorted(ours.column_names)} / {sorted(theirs.column_names)}"]
    out = []
    for n in ours.column_names:
        a, b = _kind(ours.schema.field(n).type), _kind(theirs.schema.field(n).type)
        if a != b:
            out.append(f"type of {n}: {a} / {b}")
    left, right = _sorted_rows(ours), _sorted_rows(theirs)
    if len(left) != len(right):
        return [*out, f"{len(left)} / {len(right)} rows"]
    for a, b in zip(left, right):
        for x, y in zip(a, b):
            close = isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-12)
            if x != y and not (close and not exact):
                out.append(f"{a} / {b}")
                break
    return out
