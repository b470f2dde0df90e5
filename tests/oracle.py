"""Compares a query with its SQL, run by DuckDB over the same files."""

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        p = Path(folder) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    return repr(round(v, 9)) if isinstance(v, float) else str(v)


def table(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return list(frame.columns), sorted(tuple(map(_value, r)) for r in frame.values.tolist())


def assert_equal(spark, folder, query, sql):
    assert table(query(spark, str(folder)).toPandas()) == table(connect(folder).execute(sql).fetchdf())
