"""Run a registered query on Spark and its oracle SQL on DuckDB; compare the results.

Comparison: same column names (order-free), same row count, same multiset of rows with
values compared exactly (doubles bit for bit, timestamps as UTC wall-clock).
"""

from __future__ import annotations

import math
import os
import sys
from collections import Counter

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_con(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    import datetime as dt

    import numpy as np
    import pandas as pd
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if v is pd.NaT or v is pd.NA:
        return None
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (np.floating,)):
        f = float(v)
        return None if math.isnan(f) else f
    if isinstance(v, (np.bool_,)):
        return bool(v)
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return ("ts", v.isoformat())
    if isinstance(v, bytes):
        return v.hex()
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return cols, out


# Spark type -> the DuckDB type it should meet.
TYPE_PAIRS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def type_problems(sdf, rel) -> list[str]:
    duck = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for c, t in sdf.dtypes:
        want = TYPE_PAIRS.get(t, t.upper())
        if c in duck and duck[c] != want:
            out.append(f"{c}: spark {t} vs duck {duck[c]}")
    return out


def compare(spark, name: str, query, sql: str, sf_dir: str, con=None, verbose=True):
    con = con or duckdb_con(sf_dir)
    sdf = query(spark, sf_dir)
    spdf = sdf.toPandas()
    rel = con.sql(sql)
    types = type_problems(sdf, rel)
    dpdf = rel.df()
    scols, srows = rows_of(spdf)
    dcols, drows = rows_of(dpdf)
    problems = []
    if scols != dcols:
        problems.append(f"columns differ: spark={scols} duck={dcols}")
    if len(srows) != len(drows):
        problems.append(f"rows differ: spark={len(srows)} duck={len(drows)}")
    if types:
        problems.append("types differ: " + "; ".join(types))
    if not problems:
        cs, cd = Counter(srows), Counter(drows)
        if cs != cd:
            only_s = list((cs - cd).elements())[:3]
            only_d = list((cd - cs).elements())[:3]
            problems.append(f"values differ ({sum((cs - cd).values())} rows): "
                            f"spark-only {only_s} duck-only {only_d}")
    if verbose:
        status = "OK " if not problems else "BAD"
        print(f"{status} {name}: {len(srows)} rows; spark types {sdf.dtypes}", flush=True)
        for p in problems:
            print("     ", p[:2000], flush=True)
    return problems


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from flotilla.session import build_session
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(os.environ.get("ORACLE_MASTER", "local[8]"), shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    names = argv or list(qs)
    con = duckdb_con(sf_dir)
    bad = 0
    for n in names:
        if n not in sqls:
            df = qs[n](spark, sf_dir)
            print(f"--- {n}: no oracle; {df.count()} rows", flush=True)
            continue
        try:
            bad += bool(compare(spark, n, qs[n], sqls[n], sf_dir, con))
        except Exception as e:  # report and go on
            bad += 1
            print(f"ERR {n}: {type(e).__name__}: {str(e)[:1500]}", flush=True)
    print(f"{bad} failing of {len(names)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
