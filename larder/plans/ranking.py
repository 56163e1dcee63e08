"""Ranking queries: top rated (Q2) and quick recipes (Q3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from larder.operators.layout import RatingsLayout
from larder.operators.topk import lowest_k, top_k_existing

# Rows shown, and the fewest ratings a recipe needs to be ranked.
DISPLAY_LIMIT = 20
MIN_RATINGS = 20
QUICK_MINUTES = 30


def rating_stats(interactions: DataFrame) -> DataFrame:
    """Per recipe: sum of ratings, how many are not NULL, how many rows.

    Sums and counts combine on the map side, so a recipe with a third of all ratings costs one
    row per task in the shuffle.
    """
    return interactions.groupBy("recipe_id").agg(
        F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("n_rated"),
        F.count(F.lit(1)).alias("n_ratings"),
    )


def _mean(total: Column, n: Column) -> Column:
    return F.when(n > 0, total.cast("double") / n)


def _best_first() -> list[Column]:
    return [F.col("avg_rating").desc_nulls_last(), F.col("recipe_id").asc()]


def top_rated(
    recipes: DataFrame,
    interactions: DataFrame,
    min_ratings: int = MIN_RATINGS,
    limit: int = DISPLAY_LIMIT,
) -> DataFrame:
    """Best average rating among recipes with at least ``min_ratings`` ratings (Q2).

    Makes no assumption about ``recipes``: the group is (recipe_id, title), as in the SQL, and a
    row that repeats counts its ratings again. Both sides are summed up before the join, so
    neither a much-rated recipe nor many copies of one weigh on it.
    """
    titles = recipes.groupBy("recipe_id", "title").agg(F.count(F.lit(1)).alias("copies"))
    return (
        rating_stats(interactions)
        .join(titles, "recipe_id")
        .withColumn("n_ratings", F.col("n_ratings") * F.col("copies"))
        .filter(F.col("n_ratings") >= min_ratings)
        .withColumn("avg_rating", _mean(F.col("rating_sum"), F.col("n_rated")))
        .orderBy(*_best_first(), F.col("title").asc_nulls_first())
        .limit(limit)
        .select("title", "avg_rating", "n_ratings")
    )


def _best_of(
    stats: DataFrame, recipes: DataFrame, min_ratings: int, limit: int
) -> DataFrame:
    ranked = stats.filter(F.col("n_ratings") >= min_ratings).select(
        "recipe_id",
        _mean(F.col("rating_sum"), F.col("n_rated")).alias("avg_rating"),
        "n_ratings",
    )
    return top_k_existing(
        ranked, recipes.select("recipe_id", "title"), "recipe_id", _best_first(), limit
    ).select("title", "avg_rating", "n_ratings")


def top_rated_agg_first(
    recipes: DataFrame,
    interactions: DataFrame,
    min_ratings: int = MIN_RATINGS,
    limit: int = DISPLAY_LIMIT,
) -> DataFrame:
    """Q2 where ``recipe_id`` is unique in ``recipes``: aggregate, threshold, rank, then titles.

    Titles are read for the leading candidates only, so ``recipes`` is not shuffled either.
    """
    return _best_of(rating_stats(interactions), recipes, min_ratings, limit)


def top_rated_of_sums(
    recipes: DataFrame,
    sums: DataFrame,
    min_ratings: int = MIN_RATINGS,
    limit: int = DISPLAY_LIMIT,
) -> DataFrame:
    """``top_rated_agg_first`` from sums that are kept up as ratings come in."""
    return _best_of(sums, recipes, min_ratings, limit)


def top_rated_laid_out(
    laid_out: RatingsLayout,
    recipes: DataFrame,
    min_ratings: int = MIN_RATINGS,
    limit: int = DISPLAY_LIMIT,
) -> DataFrame:
    """``top_rated_agg_first`` on the layout made for it; ``recipes`` best in key order.

    Buckets hold whole recipes and are aggregated where they are read. The few recipes kept
    outside the buckets are disjoint from them, so the two sets of sums need no merging.
    """
    stats = rating_stats(laid_out.bucketed).unionByName(rating_stats(laid_out.hot))
    return _best_of(stats, recipes, min_ratings, limit)


def quick_recipes(
    recipes: DataFrame, under_minutes: int = QUICK_MINUTES, limit: int = DISPLAY_LIMIT
) -> DataFrame:
    """Quickest recipes under a time limit; unknown times are never quick (Q3)."""
    quick = recipes.select("recipe_id", "title", "minutes").filter(
        F.col("minutes") < under_minutes
    )
    return lowest_k(quick, "minutes", "recipe_id", limit)
