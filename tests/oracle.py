"""Compare a Spark result with DuckDB on the same Parquet tables."""

import datetime as dt
import decimal
import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_by_name(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), Counter(tuple(plain(row[i]) for i in order) for row in rows)


TYPE_NAMES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "FLOAT": "float",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
    "TIMESTAMP_S": "timestamp_ntz",
    "DATE": "date",
    "BOOLEAN": "boolean",
}


def compare(df, con, sql):
    """Return (spark side, oracle side), each as names, types and row counts."""
    result = con.sql(sql)
    left = rows_by_name(df.columns, [tuple(r) for r in df.collect()])
    right = rows_by_name(result.columns, result.fetchall())
    types = dict(df.dtypes)
    oracle_types = {n: TYPE_NAMES.get(str(t), str(t)) for n, t in zip(result.columns, result.types)}
    return (*left, types), (*right, oracle_types)
