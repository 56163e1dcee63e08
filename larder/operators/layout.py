"""Table layouts that let Spark read less or shuffle less (L1-L4)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def range_sorted(
    df: DataFrame, path: str, order: Sequence[str], files: int | None = None
) -> DataFrame:
    """``df``, a written table, as Parquet in ranges of ``order``: a filter on its head skips files.

    Ranges never split equal keys, so rows get a spread-out tiebreak, and a common value or many
    copies of one row span files. It depends on row order, which a scan repeats on a retry.
    """
    spread = df.withColumn("_spread", F.xxhash64(F.monotonically_increasing_id()))
    ranges = [*order, "_spread"]
    ranged = (
        spread.repartitionByRange(files, *ranges)
        if files
        else spread.repartitionByRange(*ranges)
    )
    in_order = ranged.sortWithinPartitions(*order).drop("_spread")
    in_order.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def interleaved(first: Column, second: Column, bits: int = 32) -> Column:
    """The low ``bits`` of two whole numbers, taken in turn: near in it is near in both.

    ``first`` and ``second`` should fill their bits evenly, as ranks do; ``bits`` is at most 31.
    """
    def spread(number: Column) -> Column:
        # Half of the number's bits move up at each step, until there is a gap after every one.
        value = number.cast("long").bitwiseAND((1 << bits) - 1)
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                            (2, 0x3333333333333333), (1, 0x5555555555555555)):
            value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(mask)
        return value

    return F.shiftleft(spread(first), 1).bitwiseOR(spread(second))


def _rank_of(df: DataFrame, column: str, steps: int) -> Column:
    """Which of ``steps`` ranges of about equal row counts a value lies in; NULL is before all.

    The bounds come from Spark's mergeable percentile sketch, one pass; ``steps`` numbers reach the
    driver. Where they lie exactly decides how well rows are dealt, not where a reader finds them.
    """
    shares = [i / steps for i in range(1, steps)]
    bounds = df.agg(F.percentile_approx(column, shares, 50 * steps)).first()[0] or []
    limits = F.array(*[F.lit(b) for b in sorted(set(bounds))])
    above = F.size(F.filter(limits, lambda b: b < F.col(column)))
    return F.when(F.col(column).isNull() | F.lit(not bounds), 0).otherwise(above)


def recipes_zordered(
    recipes: DataFrame,
    path: str,
    first: str = "recipe_id",
    second: str = "minutes",
    files: int | None = None,
    steps: int = 64,
) -> DataFrame:
    """One copy that serves filters on either of two columns (L1, L3): rows by interleaved ranks.

    A file covers a short range of both, so a filter on one reads about the square root of the files.
    Ranks and not values are interleaved, so neither column's spread hides the other.
    """
    curve = interleaved(_rank_of(recipes, first, steps), _rank_of(recipes, second, steps), 31)
    ranked = recipes.withColumn("_curve", curve)
    spread = ranked.withColumn("_spread", F.xxhash64(F.monotonically_increasing_id()))
    ranges = ["_curve", "_spread"]
    dealt = spread.repartitionByRange(files, *ranges) if files else spread.repartitionByRange(*ranges)
    ordered = dealt.sortWithinPartitions("_curve", first, second).drop(*ranges)
    ordered.write.mode("overwrite").parquet(path)
    return recipes.sparkSession.read.schema(recipes.schema).parquet(path)


def with_bloom_filters(
    df: DataFrame, path: str, column: str, per_row_group: int, files: int | None = None
) -> DataFrame:
    """``df``, a written table, with a Bloom filter of ``column`` in every Parquet row group (L1, Q1).

    For equality on a column that the layout is not sorted by: a reader skips the row groups whose
    filter lacks the value, where their ranges all hold it. ``per_row_group`` is how many distinct
    values a row group is expected to have; it sizes the filter, never cuts it.
    """
    place = F.xxhash64(F.monotonically_increasing_id())
    dealt = df.withColumn("_place", place)
    dealt = dealt.repartition(files, "_place") if files else dealt
    (
        dealt.drop("_place")
        .write.mode("overwrite")
        .option(f"parquet.bloom.filter.enabled#{column}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{column}", str(per_row_group))
        # Values in a dictionary are looked up there and get no filter.
        .option(f"parquet.enable.dictionary#{column}", "false")
        .parquet(path)
    )
    return df.sparkSession.read.schema(df.schema).parquet(path)


def junction_by_ingredient(
    recipe_ingredients: DataFrame, path: str, files: int | None = None
) -> DataFrame:
    """Serves ingredient search: rows of one ingredient lie together, by recipe (L1)."""
    return range_sorted(recipe_ingredients, path, ["ingredient_id", "recipe_id"], files)


def recipes_by_id(recipes: DataFrame, path: str, files: int | None = None) -> DataFrame:
    """Serves title lookups: key order, as a primary key gives."""
    return range_sorted(recipes, path, ["recipe_id"], files)


def recipes_by_minutes(recipes: DataFrame, path: str, files: int | None = None) -> DataFrame:
    """Serves quick recipes: rows of like cooking time lie together (L3)."""
    return range_sorted(recipes, path, ["minutes", "recipe_id"], files)


def plain(df: DataFrame, path: str, files: int | None = None) -> DataFrame:
    """Back to no particular layout (L4): rows in no order, every file spanning all values.

    ``df`` is a written table. Rows are dealt by a hash of their place in it, so the same again on
    a retry, and repeating it changes nothing for a reader.
    """
    place = F.xxhash64(F.monotonically_increasing_id())
    dealt = df.withColumn("_place", place)
    dealt = dealt.repartition(files, "_place") if files else dealt.repartition("_place")
    # Within a file rows would still come in runs of the files they were in.
    dealt.sortWithinPartitions("_place").drop("_place").write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class RatingsLayout:
    """Interactions bucketed by recipe, but for the few recipes too big for a bucket (L2)."""

    bucketed: DataFrame
    hot: DataFrame
    recipes: DataFrame


def hot_values(df: DataFrame, column: str, parts: int) -> list[int]:
    """Values held by more than 1/``parts`` of the rows. There are fewer than ``parts`` of them."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).collect()[0][0]
    rows = counts.filter((F.col("n") * parts > total) & F.col(column).isNotNull()).collect()
    return sorted(r[column] for r in rows)


def _bucketed(df: DataFrame, name: str, path: str, column: str, buckets: int) -> DataFrame:
    # Repartitioning by the bucket column first gives one file per bucket, not one per task too.
    (
        df.repartition(buckets, column)
        .write.mode("overwrite")
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets, column)
        .sortBy(column)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def ratings_by_recipe(
    interactions: DataFrame, recipes: DataFrame, name: str, path: str, buckets: int
) -> RatingsLayout:
    """Serves top rated: both tables bucketed by recipe, so neither is shuffled by it (L2).

    A bucket is read by one task. Recipes that would fill one on their own are kept beside the
    buckets in plain files that any number of tasks can share.
    """
    spark = interactions.sparkSession
    hot_ids = hot_values(interactions, "recipe_id", buckets)
    # Rows without a recipe would all hash to one bucket.
    is_hot = F.col("recipe_id").isNull() | F.col("recipe_id").isin(hot_ids)
    hot_path = f"{path}/interactions_hot"
    interactions.filter(is_hot).write.mode("overwrite").parquet(hot_path)
    cold = interactions.filter(~is_hot)
    return RatingsLayout(
        bucketed=_bucketed(
            cold, f"{name}_interactions", f"{path}/interactions", "recipe_id", buckets
        ),
        hot=spark.read.schema(interactions.schema).parquet(hot_path),
        recipes=_bucketed(recipes, f"{name}_recipes", f"{path}/recipes", "recipe_id", buckets),
    )


def open_ratings(
    spark: SparkSession, name: str, path: str, interactions: T.StructType, recipes: T.StructType,
    buckets: int,
) -> RatingsLayout:
    """The layout that ``ratings_by_recipe`` has written, entered in the catalog if it is not."""
    for table, schema in (("interactions", interactions), ("recipes", recipes)):
        if not spark.catalog.tableExists(f"{name}_{table}"):
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
            spark.sql(
                f"CREATE TABLE {name}_{table} ({columns}) USING parquet "
                f"CLUSTERED BY (recipe_id) SORTED BY (recipe_id) INTO {int(buckets)} BUCKETS "
                f"LOCATION '{path}/{table}'"
            )
    return RatingsLayout(
        bucketed=spark.table(f"{name}_interactions"),
        hot=spark.read.schema(interactions).parquet(f"{path}/interactions_hot"),
        recipes=spark.table(f"{name}_recipes"),
    )
