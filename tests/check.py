"""Compare every registered query with its SQL twin: ``python tests/check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value.hex()  # tells -0.0 from 0.0
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(frame, con, sql: str) -> str:
    """'' when the two results agree, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    wanted = bag(names, cursor.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    got = bag(frame.columns, (tuple(r) for r in frame.collect()))
    if got == wanted:
        return ""
    return f"{sum(got.values())} vs {sum(wanted.values())} rows; extra {list((got - wanted).items())[:2]}; missing {list((wanted - got).items())[:2]}"


def main() -> int:
    import __spark_entry__ as e

    from shapeloom.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    picked = sys.argv[2:]
    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, bad = connect(sf_dir), e.oracle_sql(), 0
    for name, fn in e.queries().items():
        if picked and name not in picked:
            continue
        start = time.time()
        try:
            frame = fn(spark, sf_dir)
            problem = compare(frame, con, oracle[name]) if name in oracle else f"rows only: {frame.count()}"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'ok  ' if not problem else 'DIFF'} {name} {time.time() - start:.2f}s {problem}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
