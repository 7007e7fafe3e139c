"""Run registered queries in Spark and their oracle SQL in DuckDB, and compare.

``python -m strideframe.plans.oracle_check [sf_dir] [name ...]`` prints one line
per query: row counts, column names and an order-insensitive comparison of the
values.
"""

from __future__ import annotations

import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if v == 0:
            v = 0.0
        return repr(float(v))
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, int):
        return repr(float(v))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def check(spark, sf_dir, names=None, verbose=True):
    from strideframe.plans.catalog import all_queries

    qs = all_queries()
    con = duck(sf_dir)
    results = {}
    for name, q in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = q.run(spark, sf_dir)
            s_names = sdf.columns
            s_rows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK-ERROR", str(e).splitlines()[0][:300])
            if verbose:
                print(f"{name:40s} SPARK-ERROR {results[name][1]}", flush=True)
            continue
        ts = time.time() - t0
        sql = q.oracle()
        if sql is None:
            results[name] = ("ROWS-ONLY", len(s_rows))
            if verbose:
                print(f"{name:40s} rows-only n={len(s_rows)} spark={ts:.1f}s", flush=True)
            continue
        try:
            cur = con.execute(sql)
            d_names = [c[0] for c in cur.description]
            d_rows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("SQL-ERROR", str(e).splitlines()[0][:300])
            if verbose:
                print(f"{name:40s} SQL-ERROR {results[name][1]}", flush=True)
            continue
        ok_names = sorted(s_names) == sorted(d_names)
        ok_n = len(s_rows) == len(d_rows)
        ok_v = ok_names and ok_n and rows_of(s_names, s_rows) == rows_of(d_names, d_rows)
        status = "OK" if ok_v else "MISMATCH"
        results[name] = (status, len(s_rows))
        if verbose:
            extra = ""
            if not ok_names:
                extra = f" spark_cols={sorted(s_names)} sql_cols={sorted(d_names)}"
            elif not ok_v:
                a, b = rows_of(s_names, s_rows), rows_of(d_names, d_rows)
                diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
                extra = f" n={len(s_rows)}/{len(d_rows)} first_diff={diff}"
            print(f"{name:40s} {status} n={len(s_rows)} spark={ts:.1f}s{extra}", flush=True)
    return results


def main(argv):
    from strideframe.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session()
    res = check(spark, sf_dir, set(argv[1:]) or None)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "ROWS-ONLY")]
    print(f"{len(res) - len(bad)}/{len(res)} ok; bad: {bad}")


if __name__ == "__main__":
    main(sys.argv[1:])
