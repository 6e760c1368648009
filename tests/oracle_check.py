"""Compare every registered query with its SQL on the given tables.

    python tests/oracle_check.py [--sf 0.01] [key ...]
"""

from __future__ import annotations

import argparse
import datetime
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() and abs(v) < 1e15 else round(v, 9)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)
    return v


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(con, sql, frame):
    """None if equal, else a short description."""
    cur = con.execute(sql)
    want = normal([d[0] for d in cur.description], cur.fetchall())
    got = normal(frame.columns, [tuple(r) for r in frame.collect()])
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"first difference: spark {a} / sql {b}"
    return None


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("--dir", help="data folder, instead of --sf")
    ap.add_argument("--broadcast", default="10MB", help="broadcast threshold; -1 for none")
    ap.add_argument("keys", nargs="*")
    args = ap.parse_args()
    import __spark_entry__ as entry

    from footfall.session import build_session

    sf_dir = args.dir or f"/root/testdata/sf{args.sf}"
    spark = build_session("oracle-check", "local[8]", 8, {
        "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false",
        "spark.sql.autoBroadcastJoinThreshold": args.broadcast,
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for key in args.keys or queries:
        start = time.time()
        try:
            frame = queries[key](spark, sf_dir)
            if key in oracles:
                problem = compare(con, oracles[key], frame)
            else:
                problem = f"rows only: {frame.count()}"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
            if args.keys:
                traceback.print_exc()
        spent = time.time() - start
        if problem:
            bad += 1
            print(f"FAIL {key} ({spent:.1f}s) {problem}", flush=True)
        elif args.keys or spent > 4:
            print(f"ok   {key} ({spent:.1f}s)", flush=True)
    print(f"{len(args.keys or queries)} queries, {bad} problems")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
