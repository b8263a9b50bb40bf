"""Shared Spark-vs-DuckDB comparison used by the tests and tools/oracle_check.py."""

from __future__ import annotations

import datetime as dt
import hashlib
import math

import duckdb

from marketlens.sources.tables import DRIVER_TABLES


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keyed = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(keyed).encode()).hexdigest()[:16], keyed


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark_df, con, sql):
    srows = [tuple(r) for r in spark_df.collect()]
    scols = spark_df.columns
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    hs, ks = digest(scols, srows)
    ho, ko = digest(ocols, orows)
    info = {"spark_rows": len(srows), "oracle_rows": len(orows),
            "spark_only": [x for x in ks if x not in set(ko)][:3],
            "oracle_only": [x for x in ko if x not in set(ks)][:3],
            "cols": (sorted(set(scols) - set(ocols)), sorted(set(ocols) - set(scols)))}
    return len(srows) == len(orows) and sorted(scols) == sorted(ocols) and hs == ho, info
