"""Run catalogue queries beside their SQL and compare whole results.

    python tests/check.py [sf] [query …]
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from feedloom import catalogue
from feedloom.catalogue.marts import TABLES
from feedloom.session import get_spark

DATA = "/root/testdata"


def plain(value):
    """A comparable, sortable form of one value."""
    if value is None:
        return "<null>"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if hasattr(value, "asDict"):
        return plain(list(value))
    if isinstance(value, dict):
        return plain(list(value.values()))
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def compare(spark, con, folder, name):
    """(ok or None without SQL, note)."""
    df = catalogue.queries()[name](spark, folder)
    got = rows_of(df.columns, df.collect())
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        return None, f"{len(got[1])} rows"
    cur = con.execute(sql)
    want = rows_of([c[0] for c in cur.description], cur.fetchall())
    if got == want:
        return True, f"{len(got[1])} rows"
    note = f"columns {got[0]} / {want[0]}, rows {len(got[1])} / {len(want[1])}"
    differ = [(g, w) for g, w in zip(got[1], want[1]) if g != w][:1]
    return False, note + (f"\n   got  {str(differ[0][0])[:600]}\n   want {str(differ[0][1])[:600]}" if differ else "")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"{DATA}/sf{sf}"
    names = sys.argv[2:] or list(catalogue.queries())
    spark = get_spark("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            ok, note = compare(spark, con, folder, name)
        except Exception as error:
            ok, note = False, "".join(traceback.format_exception_only(error))[:1500]
        bad += ok is False
        print(f"{ {True: 'same', False: 'DIFF', None: 'rows'}[ok]} {name} {time.time() - start:.1f}s {note}", flush=True)
    print("failures", bad)


if __name__ == "__main__":
    main()
