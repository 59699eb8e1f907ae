"""Run registered queries against their check SQL in DuckDB: python tools/compare.py [folder] [name ...]"""

from __future__ import annotations

import datetime
import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from orewright.plans.catalog import QUERIES
from orewright.session import local_session


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def database(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, folder: str, name: str) -> tuple[bool, str]:
    started = time.time()
    df = QUERIES[name].run(spark, folder)
    got = rows_of(df.columns, df.collect())
    took = time.time() - started
    sql = QUERIES[name].sql
    if sql is None:
        return True, f"{len(got)} rows, no check SQL, {took:.1f}s"
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = rows_of(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(columns)}"
    if got != want:
        bad = next(((a, b) for a, b in zip(got, want) if a != b), "")
        return False, f"{len(got)} vs {len(want)} rows; {sorted(columns)} first difference {bad}"
    types = {type(x) for r in got for x in r} - {int, float, str, bool, type(None)}
    return not types, f"{len(got)} rows, {took:.1f}s {types or ''}"


def main(argv: list[str]) -> int:
    folder = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark, con = local_session(), database(folder)
    failed = []
    for name in names:
        try:
            ok, note = compare(spark, con, folder, name)
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__} {str(e)[:700]}"
        print("ok  " if ok else "FAIL", name, note, flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(names) - len(failed)} of {len(names)} match; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
