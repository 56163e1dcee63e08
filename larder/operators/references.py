"""Keeping and finding rows by whether their key exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from larder.workspace import stage


def keep_referenced(
    df: DataFrame, parent: DataFrame, key: str, unique_parent: bool = False
) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``parent``, columns in ``df``'s order.

    A hot key of ``df`` is left to AQE, which splits its partition as long as both sides are read
    straight from their shuffles. So unless ``parent`` is known to hold each key once, its
    distinct keys are written first: copies collapse, and the join reads a plain table.
    A join on a shared column moves that column to the front, hence the select.
    """
    known = parent.select(key)
    if not unique_parent:
        known = stage(known.distinct(), "parent-keys")
    return df.join(known, key, "left_semi").select(*df.columns)


def orphans(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str | None = None
) -> DataFrame:
    """Key values of ``child`` that ``parent`` lacks, with how many rows hold each.

    Both sides are brought to one row per key before the join, so very common keys weigh nothing
    in it, and the join uses the partitioning that took. NULL keys refer to nothing and are not
    orphans.
    """
    keys = (
        child.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    known = parent.select(F.col(parent_column or column).alias(column)).distinct()
    return keys.join(known, column, "left_anti").select(column, "n_rows")
