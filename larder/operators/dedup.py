"""De-duplication with a winner that does not depend on row order (A2, A3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def dedup_by_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ()
) -> DataFrame:
    """One row per key: the first by ``order``, then by all other columns.

    ``row_number() = 1`` lets Spark keep one row per key within each task before the shuffle, so a
    key with very many copies stays small.
    """
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    ranking = Window.partitionBy(*keys).orderBy(*(list(order) + rest or [F.lit(1)]))
    return df.withColumn("_rank", F.row_number().over(ranking)).filter("_rank = 1").drop("_rank")
