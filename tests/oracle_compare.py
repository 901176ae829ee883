"""Runs a query in Spark and its counterpart in DuckDB and compares all values."""

from __future__ import annotations

import decimal
import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v


def _kind(v):
    if isinstance(v, bool):
        return "bool"
    if isinstance(v, int):
        return "int"
    return type(v).__name__


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=lambda r: [(v is not None, repr(v)) for v in r])


def compare(spark_df, con, sql):
    """None when equal, otherwise a short description of the first difference."""
    left = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    right = _rows([d[0] for d in cur.description], cur.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} / {len(right[1])}"
    for a, b in zip(left[1], right[1]):
        if a != b or [_kind(v) for v in a] != [_kind(v) for v in b]:
            return f"values {a} / {b}"
    return None


def row_work_outside_the_jvm_or_pairwise(spark_df):
    """Plan nodes that run Python per row or build pairs of rows."""
    text = spark_df._jdf.queryExecution().executedPlan().toString()
    return [node for node in (
        "PythonEvalUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
        "BroadcastNestedLoopJoin") if node in text]
