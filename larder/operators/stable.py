"""Generated keys that survive the next load (W1, W2): what has an id keeps it, the rest follows on.

Ids given out live in a table of their own, to which loads only ever add. A load that is repeated
after a failure finds the keys it has added and gives out nothing twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from larder.operators.ids import dense_ids, row_ids


def open_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet table at ``path``; no rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def last_id(table: DataFrame, id_column: str) -> int:
    """The greatest id given out, 0 if there is none: one narrow column, mostly from its statistics."""
    return table.agg(F.max(id_column)).first()[0] or 0


def new_keys(keys: DataFrame, known: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct ``columns`` of ``keys`` without a row in ``known``."""
    return keys.select(*columns).distinct().join(known.select(*columns), list(columns), "left_anti")


def extend_ids(keys: DataFrame, path: str, key: str, id_field: T.StructField) -> DataFrame:
    """The key-to-id table at ``path``, with the keys it lacks added in their order.

    Old ids stay; new ones follow on from the last. Only the new keys are sorted and written, so a
    load costs what it brings, besides one anti-join of narrow rows.
    """
    spark = keys.sparkSession
    schema = T.StructType([id_field, T.StructField(key, keys.schema[key].dataType)])
    known = open_or_empty(spark, path, schema)
    before = last_id(known, id_field.name)
    fresh = dense_ids(new_keys(keys, known, [key]), [key], id_field.name)
    # A cast that fails rather than wraps: ids past the declared type are an error.
    number = (F.col(id_field.name) + before).cast(id_field.dataType)
    fresh.select(number.alias(id_field.name), key).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def number_on(rows: DataFrame, id_column: str, before: int) -> DataFrame:
    """``rows`` with ids that follow on from ``before``, in no particular order and without a shuffle."""
    return row_ids(rows, id_column).withColumn(id_column, F.col(id_column) + F.lit(before))
