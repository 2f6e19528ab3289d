"""Run registered queries against their DuckDB oracle SQL.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Mirrors the driver's gate: same column names, same row count, and the same
multiset of rows after sorting columns by name.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(df_pd):
    cols = sorted(df_pd.columns)
    out = [tuple(_norm(r[c]) for c in cols) for r in df_pd.to_dict("records")]
    return cols, sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_pd = sdf.toPandas()
    t1 = time.time()
    if sql is None:
        return f"{name}: rows-only {len(s_pd)} rows ({t1 - t0:.1f}s)", True
    o_pd = con.sql(sql).df()
    t2 = time.time()
    sc, sr = rows_of(s_pd)
    oc, orr = rows_of(o_pd)
    if sc != oc:
        return f"{name}: COLUMNS differ spark={sc} oracle={oc}", False
    if len(sr) != len(orr):
        return f"{name}: ROWCOUNT spark={len(sr)} oracle={len(orr)}", False
    bad = [(a, b) for a, b in zip(sr, orr) if a != b]
    if bad:
        return f"{name}: VALUES differ in {len(bad)} rows, e.g. spark={bad[0][0]} oracle={bad[0][1]}", False
    return f"{name}: ok {len(sr)} rows (spark {t1 - t0:.1f}s, duckdb {t2 - t1:.1f}s)", True


def main():
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    from valence.session import get_spark
    import __spark_entry__ as E
    spark = get_spark("local[8]", shuffle_partitions=8)
    qs, oracle = E.queries(), E.oracle_sql()
    names = args or list(qs)
    con = duck(sf_dir)
    ok_all = True
    for n in names:
        try:
            msg, ok = compare(spark, n, qs[n], oracle.get(n), sf_dir, con)
        except Exception as e:  # report and continue
            msg, ok = f"{n}: ERROR {type(e).__name__}: {str(e)[:400]}", False
        ok_all &= ok
        print(msg, flush=True)
    print("ALL OK" if ok_all else "FAILURES")


if __name__ == "__main__":
    main()
