"""Run Spark queries and their DuckDB oracle side by side and compare the results.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Comparison is order-insensitive over rows, with columns sorted by name; values
are compared exactly (dates as ISO strings, floats by value).
"""

from __future__ import annotations

import collections
import datetime as _dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(v) + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, _dt.datetime):
        return v.date().isoformat() if v.time() == _dt.time(0) else v.isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return bool(v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows], [columns[i] for i in order]


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
                 "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}


def compare(spark, con, name: str, sf_dir: str) -> dict:
    from __spark_entry__ import oracle_sql, queries
    t0 = time.time()
    sdf = queries()[name](spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = list(sdf.columns)
    t1 = time.time()
    sql = oracle_sql().get(name)
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "no-sql"
        return out
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out["duck_rows"] = len(d_rows)
    srows, scols = rows_of(s_cols, s_rows)
    drows, dcols = rows_of(d_cols, d_rows)
    if scols != dcols:
        out["status"] = f"columns differ: spark={scols} duck={dcols}"
        return out
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in sdf.schema.fields}
    d_types = {c[0]: str(c[1]).upper() for c in res.description}
    bad_types = {c: (s_types[c], d_types[c]) for c in s_types if s_types[c] != d_types.get(c)}
    if bad_types:
        out["status"] = f"types differ: {bad_types}"
        return out
    cs, cd = collections.Counter(srows), collections.Counter(drows)
    if cs == cd:
        out["status"] = "match"
    else:
        only_s = list((cs - cd).elements())[:5]
        only_d = list((cd - cs).elements())[:5]
        out["status"] = f"values differ ({sum((cs - cd).values())} / {sum((cd - cs).values())}): " \
                        f"spark-only {only_s} duck-only {only_d}"
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from adspend.session import local_session
    from __spark_entry__ import queries
    spark = local_session(8)
    con = duck_connection(sf_dir)
    names = names or sorted(queries())
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, sf_dir)
        except Exception as exc:  # report and go on
            r = {"name": n, "status": f"error: {type(exc).__name__}: {str(exc)[:300]}"}
        if r["status"] != "match":
            bad += 1
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} match", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
