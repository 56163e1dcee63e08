"""Row-for-row comparison of a Spark result with a DuckDB one."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _family(type_name):
    """Type families both sides must share; widths of integers included."""
    t = str(type_name).lower()
    aliases = {
        "tinyint": "int8",
        "smallint": "int16",
        "int": "int32",
        "integer": "int32",
        "bigint": "int64",
        "varchar": "string",
    }
    return aliases.get(t, t)


def _value(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


def _sortable(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=_sortable)


def spark_result(df):
    names = df.columns
    return canonical([tuple(r) for r in df.collect()], names), dict(df.dtypes)


def duck_result(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    types = dict(zip(names, map(str, rel.types)))
    return canonical(rel.fetchall(), names), types


def same_types(spark_types, duck_types):
    return {k: _family(v) for k, v in spark_types.items()} == {
        k: _family(v) for k, v in duck_types.items()
    }
