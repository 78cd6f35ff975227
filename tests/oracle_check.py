"""Compare a Spark result with the result of its SQL text in DuckDB, whatever the row order."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    if isinstance(v, bool) or v is None:
        return v
    return str(v)


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both agree in columns, types and rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    kinds = dict(r[:2] for r in con.execute(f"DESCRIBE {sql}").fetchall())
    result = con.execute(sql)
    other = {f.name for f in spark_df.schema if KINDS.get(f.dataType.simpleString()) != kinds[f.name]}
    if other:
        return f"types of {sorted(other)}"
    want, got = _bag(names, result.fetchall()), _bag(spark_df.columns, spark_df.collect())
    if want != got:
        extra, missing = got - want, want - got
        return (
            f"{sum(got.values())} rows against {sum(want.values())}; {sum(extra.values())} only in Spark, "
            f"e.g. {list(extra)[:2]}; {sum(missing.values())} only in SQL, e.g. {list(missing)[:2]}"
        )
    return ""
