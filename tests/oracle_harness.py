"""Compare each catalogue query with its DuckDB twin on the same parquet files."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    return sorted(
        (tuple(_norm(r[i]) for i in order) for r in records), key=lambda t: tuple((x is None, str(x)) for x in t)
    )


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out = {"key": key, "spark_rows": len(s_rows), "duck_rows": len(d_rows), "sec": round(t1 - t0, 2)}
    if sorted(c.lower() for c in s_cols) != sorted(c.lower() for c in d_cols):
        out["error"] = f"columns differ: {sorted(s_cols)} vs {sorted(d_cols)}"
        return out
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a != b:
        diffs = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["error"] = f"values differ, e.g. {diffs}"
    return out


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from lodestar.plans.catalogue import CATALOGUE
    from lodestar.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = local_session()
    import os

    if os.environ.get("ORACLE_SESSION_TZ"):
        spark.conf.set("spark.sql.session.timeZone", os.environ["ORACLE_SESSION_TZ"])
    if os.environ.get("ORACLE_SHUFFLE_PARTITIONS"):
        spark.conf.set("spark.sql.shuffle.partitions", os.environ["ORACLE_SHUFFLE_PARTITIONS"])
    con = duck(sf)
    bad = 0
    for key, (fn, sql) in CATALOGUE.items():
        if only and key not in only:
            continue
        if sql is None:
            df = fn(spark, sf)
            print(key, "rows-only", df.count(), flush=True)
            continue
        try:
            r = compare(spark, con, key, fn, sql, sf)
        except Exception as ex:  # noqa: BLE001
            r = {"key": key, "error": f"{type(ex).__name__}: {str(ex)[:400]}"}
        bad += "error" in r
        print(r, flush=True)
    print("FAILED", bad)
