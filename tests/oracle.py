"""Compare registered queries with their SQL on DuckDB.

``python tests/oracle.py [--sf DIR] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.10g}") + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_value(x) for x in v)
    return v


def _kind(v):
    if isinstance(v, bool):
        return "bool"
    if isinstance(v, int):
        return "int"
    if isinstance(v, (float, decimal.Decimal)):
        return "float"
    return type(v).__name__


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    kinds: dict[str, set] = {}
    out = []
    for row in rows:
        for i in order:
            if row[i] is not None:
                kinds.setdefault(names[i], set()).add(_kind(row[i]))
        out.append(tuple(_value(row[i]) for i in order))
    return [names[i] for i in order], sorted(out, key=repr), kinds


def differences(df: DataFrame, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    a_names, a_rows, a_kinds = _rows(df.columns, df.collect())
    cursor = con.execute(sql)
    b_names, b_rows, b_kinds = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if a_names != b_names:
        return f"columns {a_names} != {b_names}"
    if len(a_rows) != len(b_rows):
        return f"rows {len(a_rows)} != {len(b_rows)}"
    if a_kinds != b_kinds:
        return f"types {a_kinds} != {b_kinds}"
    for a, b in zip(a_rows, b_rows):
        if a != b:
            wrong = sum(x != y for x, y in zip(a_rows, b_rows))
            return f"{wrong} of {len(a_rows)} rows differ, first {str(a)[:300]} != {str(b)[:300]}"
    return None


def main(argv: list[str]) -> int:
    sys.path.insert(0, ROOT)
    import __spark_entry__ as entry

    folder = SF
    if argv[:1] == ["--sf"]:
        folder, argv = argv[1], argv[2:]
    spark, con = session(), duck(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in argv or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracle:
                wrong = differences(df, con, oracle[name])
                state = wrong or "ok"
            else:
                state, wrong = f"rows {df.count()}", None
        except Exception as exc:  # report and go on
            wrong = state = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += wrong is not None
        print(f"{'FAIL' if wrong else 'pass'} {name} {time.time() - start:.1f}s {state}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
