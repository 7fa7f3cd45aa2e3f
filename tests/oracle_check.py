"""Compare a registered query with its DuckDB oracle: names, Arrow types, row count, values."""

from __future__ import annotations

import math
import os

import duckdb
import pyarrow as pa

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm_type(t: pa.DataType) -> str:
    if pa.types.is_timestamp(t):
        return "timestamp"
    if pa.types.is_large_string(t) or pa.types.is_string(t):
        return "string"
    if pa.types.is_date(t):
        return "date"
    if pa.types.is_list(t) or pa.types.is_large_list(t):
        return f"list<{_norm_type(t.value_type)}>"
    return str(t)


def _norm_value(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, list):
        return tuple(_norm_value(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm_value(x)) for k, x in v.items()))
    return v


def _rows(tbl: pa.Table) -> list[tuple]:
    names = sorted(tbl.column_names)
    cols = [tbl.column(n).to_pylist() for n in names]
    rows = [tuple(_norm_value(c[i]) for c in cols) for i in range(tbl.num_rows)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_df, sql: str, con) -> list[str]:
    """Return a list of problems (empty when equal)."""
    problems = []
    st = spark_df.toArrow()
    dt = con.sql(sql).to_arrow_table()
    if sorted(st.column_names) != sorted(dt.column_names):
        return [f"columns differ: spark={st.column_names} sql={dt.column_names}"]
    for n in st.column_names:
        a, b = _norm_type(st.schema.field(n).type), _norm_type(dt.schema.field(n).type)
        if a != b:
            problems.append(f"type {n}: spark={a} sql={b}")
    if st.num_rows != dt.num_rows:
        problems.append(f"rows: spark={st.num_rows} sql={dt.num_rows}")
        return problems
    rs, rd = _rows(st), _rows(dt)
    if rs != rd:
        diff = [(a, b) for a, b in zip(rs, rd) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems
