"""Run registered queries on Spark and their oracle SQL on DuckDB; compare
row count, column names and an order-insensitive hash of the values.

usage: python tools/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _canon(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(float(v))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_canon(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return _canon(v.tolist())
    return str(v)


def canon_rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = sorted("|".join(_canon(r[i]) for i in order) for r in rows)
    return [cols[i] for i in order], out


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


# Spark type name -> DuckDB type name, for the schema comparison.
TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "date": "DATE"}


def type_mismatches(sdf, con, sql):
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {c: (t, duck_types.get(c)) for c, t in sdf.dtypes
            if TYPE_MAP.get(t, t) != duck_types.get(c)}


def compare(spark, con, name, fn, sql, sf_dir, verbose=True):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        return {"name": name, "rows": len(srows), "oracle": None, "sec": t1 - t0}
    cur = con.execute(sql)
    dcols = [c[0] for c in cur.description]
    drows = cur.fetchall()
    sc, sv = canon_rows(scols, srows)
    dc, dv = canon_rows(dcols, drows)
    ok_cols = sc == dc
    ok_rows = len(sv) == len(dv)
    ok_vals = sv == dv
    res = {"name": name, "rows": len(srows), "oracle_rows": len(drows), "cols": ok_cols,
           "values": ok_vals, "types": type_mismatches(sdf, con, sql), "sec": round(t1 - t0, 2)}
    if verbose and not (ok_cols and ok_rows and ok_vals):
        print("  spark cols", sc, "\n  duck  cols", dc)
        diff_s = [x for x in sv if x not in set(dv)][:3]
        diff_d = [x for x in dv if x not in set(sv)][:3]
        print("  spark-only", diff_s, "\n  duck-only ", diff_d)
    return res


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    from martlake.session import build_session
    from martlake.plans.registry import QUERIES, ORACLE, load_all
    load_all()
    spark = build_session(shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for name in (names or list(QUERIES)):
        try:
            r = compare(spark, con, name, QUERIES[name], ORACLE.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "error": f"{type(e).__name__}: {str(e)[:300]}"}
        if "error" in r:
            good = False
        elif "oracle" in r:
            good = True
        else:
            good = bool(r["cols"] and r["values"] and r["rows"] == r["oracle_rows"]
                        and not r["types"])
        bad += 0 if good else 1
        print(("OK  " if good else "BAD ") + str(r), flush=True)
    print(f"{len(names or QUERIES) - bad} ok, {bad} bad")


if __name__ == "__main__":
    main()
