"""Run registered queries on Spark and their SQL on DuckDB and compare whole results.

    python -m checks.compare [folder] [name-part ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks.queries import REGISTRY
from offerwise.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(x):
    if x is None:
        return ""
    if isinstance(x, float) and math.isnan(x):
        return "nan"
    return repr(float(x)) if isinstance(x, float) else str(x)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, folder: str, name: str) -> tuple[bool | None, str]:
    build, text = REGISTRY[name]
    started = time.time()
    df = build(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - started
    if text is None:
        return None, f"{len(got)} rows, {took:.1f}s, no SQL"
    started = time.time()
    cur = con.execute(text)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    sql_took = time.time() - started
    if sorted(df.columns) != sorted(names):
        return False, f"columns differ: {sorted(set(df.columns) ^ set(names))}"
    note = f"{len(got)} rows, {took:.1f}s / {sql_took:.1f}s"
    if got == want:
        return bool(got), note
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if len(got) != len(want) or not bad:
        return False, f"{len(got)} rows against {len(want)}"
    a, b = bad[0]
    cols = sorted(names)
    where = [(c, x, y) for c, x, y in zip(cols, a, b) if x != y]
    return False, f"{note}; {len(bad)} rows differ, first {dict(zip(cols[:3], a[:3]))}: {where[:4]}"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session("checks", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    failed = 0
    for name in REGISTRY:
        if wanted and not any(p in name for p in wanted):
            continue
        try:
            good, note = compare(spark, con, folder, name)
        except Exception as e:  # report and go on with the next query
            good, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        failed += good is False
        print(f"{'FAIL' if good is False else 'rows' if good is None else 'ok  '} {name}: {note}", flush=True)
    print(f"{failed} failed", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
