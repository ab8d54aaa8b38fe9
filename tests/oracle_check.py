"""Compare each registered Spark query with its DuckDB oracle.

Row count, column names and the order-insensitive multiset of rows must be
equal. Usable from pytest and as a script:

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v)
    if isinstance(v, Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_canon(x) for x in v)
    if hasattr(v, "tolist"):
        return _canon(v.tolist())
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return str(v)


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_canon(r[i]) for i in order) for r in records)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    con = con or duck_connection(sf_dir)
    t0 = time.time()
    sdf = entry.queries()[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    sql = entry.oracle_sql().get(name)
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["oracle"] = None
        return out
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    out["duck_rows"] = len(d_rows)
    out["columns_match"] = sorted(s_cols) == sorted(d_cols)
    if not out["columns_match"]:
        out["spark_cols"], out["duck_cols"] = sorted(s_cols), sorted(d_cols)
        out["match"] = False
        return out
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    out["match"] = a == b
    if not out["match"]:
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        out["only_spark"], out["only_duck"] = only_s, only_d
        out["cols"] = sorted(s_cols)
    return out


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from raceline.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    conf = {}
    if os.environ.get("RACELINE_NO_BROADCAST"):
        # Plan every join as a shuffle join, as at cluster scale.
        conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    spark = build_session("local[8]", shuffle_partitions=8, conf=conf)
    spark.sparkContext.setLogLevel("ERROR")
    import __spark_entry__ as entry

    names = sys.argv[2:] or list(entry.queries())
    con = duck_connection(sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        ok = r.get("match", r.get("oracle", "x") is None and "error" not in r)
        bad += not ok
        print(("OK  " if ok else "FAIL"), r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
