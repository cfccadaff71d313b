"""Compare registered Spark queries with their DuckDB oracle SQL.

Mirrors the driver's gate: same column names, same row count, equal
order-insensitive values (floats compared after rounding to 6 places).
"""

from __future__ import annotations

import math
import sys

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


STRICT = False


def _norm(v):
    if STRICT:
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return ("~null",)
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, bool):
            return ("b", v)
        if isinstance(v, (int, float)):
            return ("n", float(v))
        return ("s", str(v))
    if v is None or (not isinstance(v, (list, tuple, str)) and not hasattr(v, "__len__") and v != v):
        return ("~null",)          # pandas shows a null in a column of numbers as NaN
    if isinstance(v, float):
        return ("f", round(v, 5))
    if hasattr(v, "isoformat"):
        t = str(v)[:19]
        return ("t", t[:10] if t.endswith(" 00:00:00") else t)
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_norm(x) for x in v))
    if hasattr(v, "tolist"):
        return ("l", tuple(_norm(x) for x in v.tolist()))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("f", float(v))
    return ("s", str(v))


def rows_of(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records"))


def compare(spark, name, qfn, sql, sf_dir, con=None):
    con = con or duck(sf_dir)
    sp = qfn(spark, sf_dir).toPandas()
    dk = con.execute(sql).df()
    sc, sr = rows_of(sp)
    dc, dr = rows_of(dk)
    if sc != dc:
        return False, f"{name}: columns differ spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return False, f"{name}: rows spark={len(sr)} duck={len(dr)}"
    for a, b in zip(sr, dr):
        if a != b:
            return False, f"{name}: first diff spark={a} duck={b}"
    return True, f"{name}: OK ({len(sr)} rows)"


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from tierwise.session import build
    args = [a for a in sys.argv[1:] if a != "--strict"]
    STRICT = "--strict" in sys.argv
    sf = args[0] if args else "/root/testdata/sf0.01"
    only = args[1:] or None
    import os
    tz = os.environ.get("HARNESS_TZ")
    if os.environ.get("HARNESS_PLAIN"):
        # a session exactly as a caller would create it: none of our settings
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]")
                 .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    else:
        spark = build(extra={"spark.sql.session.timeZone": tz} if tz else None)
    con = duck(sf)
    q, o = E.queries(), E.oracle_sql()
    bad = 0
    for name in q:
        if only and name not in only:
            continue
        if name not in o:
            n = q[name](spark, sf).count()
            print(f"{name}: no oracle, {n} rows")
            continue
        try:
            ok, msg = compare(spark, name, q[name], o[name], sf, con)
        except Exception as e:  # report and continue
            ok, msg = False, f"{name}: ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(msg, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
