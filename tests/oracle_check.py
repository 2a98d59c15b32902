"""Run every named query in Spark and its SQL oracle in DuckDB and compare them.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query and a final JSON summary.
"""

from __future__ import annotations

import hashlib
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return repr(v)


def value_hash(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_types = [f.dataType.simpleString() for f in df.schema.fields]
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_types = [str(d[1]) for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    out = {"name": name, "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2),
           "rows": (len(s_rows), len(d_rows)),
           "cols_ok": sorted(s_cols) == sorted(d_cols),
           "types": (dict(zip(s_cols, s_types)), dict(zip(d_cols, d_types)))}
    out["hash_ok"] = out["cols_ok"] and value_hash(s_cols, s_rows) == value_hash(d_cols, d_rows)
    out["ok"] = out["cols_ok"] and len(s_rows) == len(d_rows) and out["hash_ok"]
    if not out["ok"] and out["cols_ok"]:
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        a = sorted(tuple(r[i] for i in order_s) for r in s_rows)
        b = sorted(tuple(r[i] for i in order_d) for r in d_rows)
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["diff"] = repr(diff)[:600]
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    from cairn.session import get_spark
    import __spark_entry__ as E
    spark = get_spark(os.environ.get("CHECK_MASTER", "local[8]"),
                      int(os.environ.get("CHECK_SHUFFLE_PARTITIONS", "8")))
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    results = []
    for name in (names or list(qs)):
        if name not in sqls:
            print(f"{name}: no oracle")
            continue
        try:
            r = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # report and go on
            r = {"name": name, "ok": False, "error": repr(e)[:800]}
        results.append(r)
        print(json.dumps(r, default=str), flush=True)
    bad = [r["name"] for r in results if not r.get("ok")]
    print(json.dumps({"n": len(results), "failed": bad}))


if __name__ == "__main__":
    main()
