"""Run a registered Spark query and its DuckDB SQL, compare as multisets.

Usable from pytest (``compare``) and from the shell:
``python tests/oracle_compare.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import math
import os
import sys
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    return v


def rows_spark(df):
    return [tuple(_norm(x) for x in r) for r in df.collect()], list(df.columns)


def rows_duck(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return [tuple(_norm(x) for x in r) for r in cur.fetchall()], cols


def compare(spark, sf_dir: str, name: str, con=None) -> tuple[bool, str]:
    import __spark_entry__ as E
    con = con or duck(sf_dir)
    df = E.queries()[name](spark, sf_dir)
    srows, scols = rows_spark(df)
    sql = E.oracle_sql().get(name)
    if sql is None:
        return False, f"{name}: {len(srows)} rows (no oracle)"
    drows, dcols = rows_duck(con, sql)
    if sorted(scols) != sorted(dcols):
        return False, f"{name}: columns differ spark={scols} duck={dcols}"
    order = [dcols.index(c) for c in scols]
    drows = [tuple(r[i] for i in order) for r in drows]
    cs, cd = Counter(srows), Counter(drows)
    if cs == cd:
        return True, f"{name}: {len(srows)} rows equal"
    only_s = list((cs - cd).elements())[:5]
    only_d = list((cd - cs).elements())[:5]
    return False, (f"{name}: spark {len(srows)} rows, duck {len(drows)} rows\n"
                   f"  cols {scols}\n  only spark: {only_s}\n  only duck: {only_d}")


if __name__ == "__main__":
    from cellwatch.config import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as E
    names = sys.argv[2:] or list(E.queries())
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            ok, msg = compare(spark, sf, n, con)
        except Exception as ex:  # report and go on
            ok, msg = False, f"{n}: ERROR {type(ex).__name__}: {str(ex)[:800]}"
        bad += not ok
        print(("OK   " if ok else "FAIL ") + msg, flush=True)
    print(f"{len(names) - bad}/{len(names)} passed")
