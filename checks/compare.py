"""Run registered queries against their SQL: python -m checks.compare [sf_dir] [name ...]"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

from checks.bindings import TABLES
from checks.registry import ORACLES, QUERIES
from paperlake.runtime import build_session


def _norm(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return str([_norm(v) for v in value])
    return repr(value)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(_norm(r[n]) for n in names) for r in df.collect())


def sql_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    names = sorted(columns)
    at = [columns.index(n) for n in names]
    return names, sorted(tuple(_norm(r[i]) for i in at) for r in cursor.fetchall())


def connect(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def main(argv: list[str]) -> int:
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    chosen = argv[1:] or list(QUERIES)
    spark = build_session("local[8]", 8, **{"spark.driver.memory": "12g", "spark.ui.enabled": "false",
                                               "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf), 0
    for name in chosen:
        start = time.time()
        try:
            names, rows = spark_rows(QUERIES[name](spark, sf))
            took = time.time() - start
            if name not in ORACLES:
                print(f"rows   {name}: {len(rows)} rows {took:.1f}s", flush=True)
                continue
            want_names, want = sql_rows(con, ORACLES[name])
            if names == want_names and rows == want:
                print(f"ok     {name}: {len(rows)} rows {took:.1f}s", flush=True)
                continue
            bad += 1
            print(f"DIFFER {name}: {len(rows)} against {len(want)} rows; {names} {want_names}")
            left, right = set(rows) - set(want), set(want) - set(rows)
            print("   spark only:", [tuple(v[:80] for v in r) for r in sorted(left)[:3]])
            print("   sql only:  ", [tuple(v[:80] for v in r) for r in sorted(right)[:3]], flush=True)
        except Exception as error:  # report and go on with the next query
            bad += 1
            print(f"ERROR  {name}: {type(error).__name__}: {str(error)[:600]}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} fine")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
