"""Run queries against their DuckDB twins: ``python tests/oracle.py sf0.01 [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = "/root/testdata"


def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}") + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    flat = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(flat, key=lambda r: tuple((v is not None, str(v)) for v in r))


def compare(spark_df, con, sql):
    """Empty text when both agree, else what differs."""
    cursor = con.execute(sql)
    want = normal([d[0] for d in cursor.description], cursor.fetchall())
    got = normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    for g, w in zip(got[1], want[1]):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            n = sum(a != b for a, b in zip(got[1], want[1]))
            return f"{n} of {len(got[1])} rows differ, first: {g} != {w}"
    return ""


def main(scale, names):
    import __spark_entry__ as entry
    from gaugeline.session import build_session

    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                   "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, oracles, bad = f"{TESTDATA}/{scale}", entry.oracle_sql(), 0
    con = duck(sf_dir)
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracles:
                problem = compare(df, con, oracles[name])
            else:
                problem = "" if len(df.collect()) else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        print(f"{name:32s} {time.time() - start:6.2f}s {'rows only' if name not in oracles else ''} {problem or 'ok'}",
              flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "sf0.001", set(sys.argv[2:]))
