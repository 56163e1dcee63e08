"""The item dimension and the recipe-to-item junction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from larder.functions.text import normalize, normalized_names
from larder.operators.ids import dense_ids
from larder.workspace import stage

# Largest name-to-id map that is broadcast, and what a row costs besides its name.
BROADCAST_BYTES = 256 * 1024 * 1024
ROW_OVERHEAD_BYTES = 64


def normalized_items(raw_items: DataFrame) -> DataFrame:
    """Distinct (recipe_id, ingredient_name_norm) of (recipe_id, ingredient_name_raw).

    De-duplicating here and not after the id join gives the same junction, since names and ids
    are one to one, and leaves less to shuffle. Rows spread over both columns, so a name used by
    a third of all recipes is no hot partition.
    """
    return (
        raw_items.select(
            "recipe_id", normalize("ingredient_name_raw").alias("ingredient_name_norm")
        )
        .filter(F.length("ingredient_name_norm") > 0)
        .distinct()
    )


def normalized_lists(lists: DataFrame, text: str) -> DataFrame:
    """``normalized_items`` of the list literals in ``text`` (with ``recipe_id``).

    A list's names are made distinct where the list is, before they become rows. So the rows of a
    recipe with one list, as nearly all have, are not shuffled; those of the others meet by recipe
    and name as ever.
    """
    ids = lists.groupBy("recipe_id").agg(F.count(F.lit(1)).alias("lists"))
    several = stage(ids.filter("lists > 1").select(F.col("recipe_id").alias("_several")), "several-lists")
    if several.isEmpty():
        return _names_of(lists, text)
    is_several = F.col("recipe_id").eqNullSafe(F.col("_several"))
    once = lists.join(several, is_several, "left_anti")
    again = lists.join(several, is_several, "left_semi")
    return _names_of(once, text).union(_names_of(again, text).distinct())


def _names_of(lists: DataFrame, text: str) -> DataFrame:
    return lists.select(
        "recipe_id", F.explode(normalized_names(text)).alias("ingredient_name_norm")
    ).filter(F.length("ingredient_name_norm") > 0)


def stage_items(items: DataFrame) -> DataFrame:
    """Items, written for the passes that share them.

    Without dictionaries: looking every name up in one costs the writer more than it saves, and the
    passes read every name as text.
    """
    return stage(items, "items", **{"parquet.enable.dictionary": "false"})


def ingredient_dimension(items: DataFrame) -> DataFrame:
    """One row per distinct name, with dense ids in name order.

    Numbering leaves the rows sorted, so the table as written lets a search for a name skip files.
    """
    names = items.select("ingredient_name_norm").distinct()
    return dense_ids(names, ["ingredient_name_norm"], "ingredient_id", T.IntegerType()).select(
        "ingredient_id",
        F.col("ingredient_name_norm").alias("ingredient_name_raw"),
        "ingredient_name_norm",
    )


def measured(ingredients: DataFrame, *names: str) -> DataFrame:
    """``ingredients`` to be joined with: to be broadcast if its ``names``, as measured on the table, are
    few enough to copy everywhere.

    A session that has turned broadcasts off gets none.
    """
    if ingredients.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-"):
        return ingredients
    row = F.lit(ROW_OVERHEAD_BYTES).cast("long")
    for name in names:
        row = row + F.coalesce(F.octet_length(name), F.lit(0))
    size = ingredients.agg(F.sum(row)).collect()[0][0] or 0
    return F.broadcast(ingredients) if size <= BROADCAST_BYTES else ingredients


def recipe_ingredients(items: DataFrame, ingredients: DataFrame) -> DataFrame:
    """(recipe_id, ingredient_id) pairs of de-duplicated items.

    Both are written tables. A dimension of some million names is copied to the executors, which
    saves shuffling every item by its name. Beyond the measured limit it is a sort-merge join on
    the name with nothing downstream that needs its partitioning, which leaves AQE free to split
    the partitions of hot names.
    """
    ids = measured(ingredients.select("ingredient_name_norm", "ingredient_id"), "ingredient_name_norm")
    return items.join(ids, "ingredient_name_norm").select("recipe_id", "ingredient_id")
