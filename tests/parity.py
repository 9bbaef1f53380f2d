"""Compare registered queries with their SQL on DuckDB: ``python -m tests.parity [sf] [key ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

DATA = os.environ.get("TABLEHAUL_TESTDATA", "/root/testdata")


def session(cores: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]").appName("tablehaul")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return type(a) is type(b) and a == b


def difference(query, spark, con, sf_dir) -> str | None:
    """None when both engines agree on columns, types of values, and rows."""
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    got = _sorted([tuple(r[n] for n in names) for r in df.collect()])
    result = con.execute(query.sql)
    columns = [d[0] for d in result.description]
    rows = result.fetchall()
    if sorted(columns) != names:
        return f"columns {names} / {sorted(columns)}"
    order = [columns.index(n) for n in names]
    want = _sorted([tuple(r[i] for i in order) for r in rows])
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    for g, w in zip(got, want):
        if not all(_same(a, b) for a, b in zip(g, w)):
            return f"{names}: {g} / {w}"
    return None


def main() -> int:
    from tablehaul.registry import all_queries

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("sf") else "sf0.01"
    sf_dir = f"{DATA}/{sf}"
    spark, con = session(), connect(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for key, q in all_queries().items():
        if args and not any(key.startswith(a) for a in args):
            continue
        start = time.time()
        try:
            if q.sql:
                problem = difference(q, spark, con, sf_dir)
                note = "ok" if problem is None else f"DIFF {problem}"
            else:
                problem, note = None, f"rows {q(spark, sf_dir).count()}"
        except Exception as e:  # noqa: BLE001
            problem, note = e, f"ERROR {type(e).__name__} {str(e)[:700]}"
        bad += problem is not None
        print(f"{key:32s} {time.time() - start:6.2f}s {note}", flush=True)
    print("problems:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
