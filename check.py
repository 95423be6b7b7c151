"""Compare every registered query with its SQL twin on one data folder.

    python check.py [folder] [name-part ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from palmares.queries import load
from palmares.queries.base import TABLES
from palmares.session import build_session


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        if isinstance(v, float):
            return "NaN" if math.isnan(v) else f"{v:.6g}"
        if isinstance(v, bool):
            return str(int(v))
        return repr(v) if not isinstance(v, (list, tuple)) else repr(list(v))

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name, q):
    """None when equal, else a short description of the difference."""
    df = q.run(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if q.sql is None:
        return None if got else "no rows"
    res = con.execute(q.sql)
    names = [d[0] for d in res.description]
    want = rows_of(names, res.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if not want:
        return "twin gives no rows"
    if got != want:
        only, other = set(got) - set(want), set(want) - set(got)
        cols, one, two = sorted(names), min(only, default=None), min(other, default=None)
        text = f"{len(got)} vs {len(want)} rows, {len(only)} only here, {len(other)} only in the twin"
        if one and two:
            text += "; " + str([(c, a, b) for c, a, b in zip(cols, one, two) if a != b][:12])
        return text
    return None


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, q in load().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            diff = compare(spark, con, folder, name, q)
        except Exception as e:  # report and go on with the next query
            diff = f"{type(e).__name__}: {str(e)[:600]}"
        bad += diff is not None
        print(f"{'FAIL' if diff else 'ok  '} {time.time() - start:6.2f}s {name} {diff or ''}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
