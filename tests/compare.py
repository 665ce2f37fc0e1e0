"""Compare registered queries with their SQL twins: `python -m tests.compare [name ...]`."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return int(value) if value == int(value) else float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, dict(df.dtypes), [tuple(plain(r[n]) for n in names) for r in df.collect()]


def sql_rows(con, sql):
    rel = con.sql(sql)
    names = sorted(rel.columns)
    at = [rel.columns.index(n) for n in names]
    types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return names, types, [tuple(plain(r[i]) for i in at) for r in rel.fetchall()]


SAME = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE", "int": "INTEGER",
        "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


def difference(df, con, sql) -> str | None:
    names, types, rows = spark_rows(df)
    want_names, want_types, want = sql_rows(con, sql)
    if names != want_names:
        return f"columns {names} != {want_names}"
    odd = {n: (types[n], want_types[n]) for n in names if SAME.get(types[n]) != want_types[n]}
    if odd:
        return f"types {odd}"
    order = lambda r: tuple((v is None, str(type(v)), str(v)) for v in r)
    rows, want = sorted(rows, key=order), sorted(want, key=order)
    if rows != want:
        extra, missing = [r for r in rows if r not in want][:2], [r for r in want if r not in rows][:2]
        return f"rows {len(rows)} vs {len(want)}; only here {str(extra)[:600]}; only there {str(missing)[:600]}"
    return None if rows else "no rows"


if __name__ == "__main__":
    from millrace.session import local_session

    import __spark_entry__ as entry

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session(cores="8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    oracles, failed = entry.oracle_sql(), []
    for name, build in entry.queries().items():
        if len(sys.argv) > 1 and not any(name == a or (a.endswith("*") and name.startswith(a[:-1])) for a in sys.argv[1:]):
            continue
        start = time.time()
        try:
            df = build(spark, sf)
            verdict = difference(df, con, oracles[name]) if name in oracles else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            verdict = f"ERROR {str(error)[:700]}"
        if verdict and not verdict.startswith("rows only"):
            failed.append(name)
        print(f"RES {name:22s} {time.time() - start:6.2f}s {verdict or 'ok'}", flush=True)
    print("RES failed:", failed)
