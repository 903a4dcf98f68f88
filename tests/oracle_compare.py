"""Run registered queries and their SQL side by side on DuckDB (as the driver does).

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (int, float)):
        f = float(v)
        if math.isnan(f):
            return "NaN"
        return float(f"{f:.12g}")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return str(v)


def rows_key(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict:
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or qs:
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
        cols = df.columns
        t1 = time.time()
        res = {"rows": len(rows), "spark_s": round(t1 - t0, 2)}
        if name in sqls:
            rel = con.execute(sqls[name])
            ocols = [d[0] for d in rel.description]
            orows = rel.fetchall()
            res.update(oracle_rows=len(orows), schema_match=sorted(cols) == sorted(ocols))
            res["match"] = res["schema_match"] and rows_key(cols, rows) == rows_key(ocols, orows)
            if not res["match"] and verbose:
                a, b = rows_key(cols, rows), rows_key(ocols, orows)
                print(name, "cols", sorted(cols), sorted(ocols))
                print(" spark-only", list((a - b).items())[:3])
                print(" oracle-only", list((b - a).items())[:3])
        out[name] = res
        if verbose:
            print(name, res, flush=True)
    return out


if __name__ == "__main__":
    from gridspark.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    r = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in r.items() if v.get("match") is False]
    print("MISMATCH" if bad else "ALL MATCH", bad)
