"""Run registered queries in Spark and their oracle SQL in DuckDB and compare.

Usage: python tests/oracle_check.py [sf_dir] [name-substring ...]
Prints one line per query; exit code 1 on any mismatch.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.9g}"  # relative, so that small values count too
    if v is None:
        return "None"
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return repr([norm(x) for x in v])
    return repr(v)


def canon_rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, q, sf_dir):
    t0 = time.time()
    df = q.run(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    t1 = time.time()
    sql = q.oracle()
    if sql is None:
        return True, f"{name}: rows={len(srows)} (no oracle) spark={t1-t0:.2f}s"
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    ok = sorted(scols) == sorted(dcols) and len(srows) == len(drows)
    msg = ""
    if sorted(scols) != sorted(dcols):
        msg = f" cols spark-only={set(scols)-set(dcols)} duck-only={set(dcols)-set(scols)}"
    elif len(srows) != len(drows):
        msg = f" rows spark={len(srows)} duck={len(drows)}"
    else:
        a, b = canon_rows(scols, srows), canon_rows(dcols, drows)
        if a != b:
            ok = False
            diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
            msg = f" VALUES differ e.g. {diff}"
    return ok, (f"{name}: {'OK' if ok else 'MISMATCH'} rows={len(srows)} spark={t1-t0:.2f}s "
                f"duck={t2-t1:.2f}s{msg}")


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in args if not a.startswith("/")]
    from vendorlens.session import get_spark
    from vendorlens.plans.registry import all_queries
    spark = get_spark("local[8]", 8)
    con = duck(sf_dir)
    bad = 0
    for name, q in all_queries().items():
        if pats and not any(p in name for p in pats):
            continue
        try:
            ok, line = compare(spark, con, name, q, sf_dir)
        except Exception as e:  # report and continue
            ok, line = False, f"{name}: ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(line, flush=True)
    print(f"mismatches: {bad}")
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
