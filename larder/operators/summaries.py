"""Kept-up rating sums: what a top list needs, without reading old ratings again."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.plans.ranking import rating_stats
from larder.sources.versioned import Versioned

SUMS = ("rating_sum", "n_rated", "n_ratings")


@dataclass(frozen=True)
class RatingSums:
    """(rating_sum, n_rated, n_ratings) per recipe under ``root``, merged batch by batch.

    The names of the batches taken in are rows of the same table, so sums and names are replaced
    together: however a load fails and is repeated, a batch counts once.
    """

    spark: SparkSession
    root: str
    # Type of the sums: that of summing the rating column, whole numbers and so exact in any order.
    sum_type: str = "long"

    @property
    def table(self) -> Versioned:
        sums = f"rating_sum {self.sum_type}, n_rated long, n_ratings long"
        return Versioned(self.spark, self.root, f"batch string, recipe_id long, {sums}")

    def batches(self) -> DataFrame:
        """``batch`` of all that the sums hold."""
        return self.table.read().filter("batch IS NOT NULL").select("batch")

    def read(self) -> DataFrame:
        return self.table.read().filter("batch IS NULL").drop("batch")

    def merge(self, batch: str, ratings: DataFrame) -> None:
        """Take in the ``ratings`` (recipe_id, rating) of one batch, unless that has been done."""
        self.sync(
            self.batches().union(self.spark.createDataFrame([(batch,)], "batch string")).distinct(),
            lambda batches: ratings.withColumn("batch", F.lit(batch)).join(batches, "batch", "left_semi"),
        )

    def sync(self, batches: DataFrame, ratings_of) -> None:  # type: ignore[no-untyped-def]
        """Bring the sums to exactly ``batches`` (``batch``).

        ``ratings_of(batches)`` gives (recipe_id, rating) of some: it is asked for those to be added
        and those to be taken out, and for no others. Sums of either combine in their tasks; then a
        row per recipe and source of sums is shuffled.
        """
        before = self.batches()
        added = batches.join(before, "batch", "left_anti")
        removed = before.join(batches, "batch", "left_anti")
        parts = [self.read()]
        if not added.isEmpty():
            parts.append(rating_stats(ratings_of(added)))
        if not removed.isEmpty():
            less = rating_stats(ratings_of(removed))
            parts.append(less.select("recipe_id", *[(-F.col(c)).alias(c) for c in SUMS]))
        if len(parts) == 1:
            return
        # Where no rating is known the sum is NULL, and adds nothing.
        total = [F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in SUMS]
        merged = reduce(DataFrame.unionByName, parts).groupBy("recipe_id").agg(*total)
        names = batches.select("batch", *[F.lit(None).alias(c) for c in ("recipe_id", *SUMS)])
        rows = merged.filter("n_ratings > 0").select(F.lit(None).alias("batch"), "recipe_id", *SUMS)
        self.table.write(_typed(rows, self.sum_type).unionByName(_typed(names, self.sum_type)))


def _typed(rows: DataFrame, sum_type: str) -> DataFrame:
    types = {"batch": "string", "recipe_id": "long", "rating_sum": sum_type, "n_rated": "long", "n_ratings": "long"}
    return rows.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()])
