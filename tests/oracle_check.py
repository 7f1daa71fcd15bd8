"""Run each registered query in Spark and its oracle SQL in DuckDB, compare.

Usable as a script: ``python tests/oracle_check.py /root/testdata/sf0.01``.
Comparison is order-insensitive over rows, with columns matched by name;
doubles must be equal bit for bit.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in DRIVER_TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(value):
    if value is None:
        return None
    if isinstance(value, float):
        # exact: Spark and DuckDB must produce the same double, bit for bit
        return "nan" if math.isnan(value) else value.hex()
    if hasattr(value, "item"):
        return _norm(value.item())
    return value


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda row: tuple((v is None, str(type(v)), v) for v in row))


def compare(spark, sf_dir: str, names: list[str] | None = None) -> dict[str, dict]:
    import __spark_entry__ as entry

    queries = entry.queries()
    oracle = entry.oracle_sql()
    con = duck_connection(sf_dir)
    report: dict[str, dict] = {}
    for name in names or list(queries):
        started = time.time()
        df = queries[name](spark, sf_dir)
        spark_cols = df.columns
        spark_rows = _rows(spark_cols, [tuple(r) for r in df.collect()])
        spark_sec = time.time() - started
        entry_report = {"rows": len(spark_rows), "spark_sec": round(spark_sec, 3)}
        if name in oracle:
            rel = con.sql(oracle[name])
            duck_cols = list(rel.columns)
            duck_rows = _rows(duck_cols, rel.fetchall())
            entry_report["oracle_rows"] = len(duck_rows)
            entry_report["columns_match"] = sorted(spark_cols) == sorted(duck_cols)
            entry_report["values_match"] = spark_rows == duck_rows
            if not entry_report["columns_match"]:
                entry_report["spark_columns"] = spark_cols
                entry_report["oracle_columns"] = duck_cols
        report[name] = entry_report
    return report


if __name__ == "__main__":
    from clickscope.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:] or None
    spark = build_session()
    result = compare(spark, sf, only)
    bad = 0
    for key, val in result.items():
        ok = val.get("values_match", True) and val.get("columns_match", True)
        bad += not ok
        print(("OK  " if ok else "BAD ") + key, val)
    print("mismatches:", bad)
