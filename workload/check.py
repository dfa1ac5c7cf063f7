"""Run queries on Spark and their SQL on DuckDB over the same tables and compare the results.

    python -m workload.check [--sf DIR] [name or prefix ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
import traceback

import duckdb

from panelforge.session import get_session
from workload import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def canonical(value):
    if value is None:
        return None
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return repr(round(value, 9) + 0.0)
    if isinstance(value, (list, tuple)):
        return tuple(canonical(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, canonical(v)) for k, v in value.items()))
    return f"{type(value).__name__ if isinstance(value, bool) else ''}{value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(canonical(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str) -> tuple[str, str]:
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if name not in ORACLES:
        return ("rows", f"{len(got)} rows {took:.1f}s")
    start = time.time()
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    want = result.fetchall()
    slow = time.time() - start
    note = f"{len(got)} rows {took:.1f}s sql {slow:.1f}s"
    if sorted(names) != sorted(df.columns):
        return ("COLUMNS", f"spark {sorted(df.columns)} sql {sorted(names)}")
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a == b:
        return ("ok" if a else "EMPTY", note)
    kinds = "row counts differ"
    for left, right in zip(a, b):
        if left != right:
            cols = sorted(names)
            diff = [(c, x, y) for c, x, y in zip(cols, left, right) if x != y]
            kinds = f"first difference {diff[:4]} key {left[:3]}"
            break
    return ("DIFF", f"{note} vs {len(want)}: {kinds}"[:900])


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = get_session("check", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{args.sf}/{t}.parquet'")
    bad = 0
    for name in QUERIES:
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        try:
            status, note = compare(spark, con, args.sf, name)
        except Exception as error:  # noqa: BLE001 - the report names every failure
            status, note = "ERROR", (str(error).split("\n== SQL")[0][:1500] or traceback.format_exc()[-1500:])
        bad += status not in ("ok", "rows")
        print(f"{status:8} {name:32} {note}", flush=True)
    print(f"{bad} problems")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
