"""Raw source columns to the curated shapes.

A source is described by which raw column feeds which field; types come from the schema.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from larder.functions.casting import lenient, typed_null
from larder.functions.text import explode_list
from larder.operators.dedup import dedup_by_key
from larder.schema import (
    INTERACTIONS,
    RECIPENLG_ID_OFFSET,
    RECIPES,
    SOURCE_FOODCOM,
    SOURCE_RECIPENLG,
)
from larder.sources.raw_csv import ROW_INDEX

# Field to raw column, per source.
FOODCOM_RECIPE = {
    "recipe_id": "id",
    "title": "name",
    "minutes": "minutes",
    "n_steps": "n_steps",
    "n_ingredients": "n_ingredients",
    "submitted": "submitted",
}
FOODCOM_LIST = {"recipe_id": "id", "items": "ingredients"}
RECIPENLG_RECIPE = {"recipe_id": ROW_INDEX, "title": "title"}
RECIPENLG_LIST = {"recipe_id": ROW_INDEX, "items": "NER"}
RATING = {
    "user_id": "user_id",
    "recipe_id": "recipe_id",
    "rating": "rating",
    "interaction_date": "date",
}

ITEM_LIST = T.StructType(
    [T.StructField("recipe_id", T.LongType()), T.StructField("items", T.StringType())]
)
# The id is generated once unknown recipes are gone.
RAW_INTERACTIONS = T.StructType([f for f in INTERACTIONS if f.name != "interaction_id"])


def conform_field(
    f: T.StructField, columns: Mapping[str, str], id_offset: int, constants: Mapping[str, str]
) -> Column:
    """One field of a conformed row: a constant, a raw column under its type, or NULL."""
    if f.name in constants:
        return F.lit(constants[f.name])
    if f.name not in columns:
        return typed_null(f.dataType)
    value = lenient(columns[f.name], f.dataType)
    if f.name == "recipe_id" and id_offset:
        return F.try_add(value, F.lit(id_offset))  # an id too big to move is malformed too
    return value


def conform(
    raw: DataFrame,
    schema: T.StructType,
    columns: Mapping[str, str],
    id_offset: int = 0,
    **constants: str,
) -> DataFrame:
    """``raw`` under ``schema``; fields with neither column nor constant are NULL.

    ``id_offset`` moves a source's recipe ids clear of the other's. Rows whose ids do not parse
    are dropped.
    """
    shaped = raw.select(
        *[conform_field(f, columns, id_offset, constants).alias(f.name) for f in schema]
    )
    ids = [f.name for f in schema if f.name.endswith("_id")]
    return shaped.dropna(subset=ids)


def conform_recipes(foodcom: DataFrame, recipenlg: DataFrame) -> DataFrame:
    """Both sources under one schema, one row per id.

    The second source has row numbers for ids and only titles besides; rows without one are
    dropped. In the first a missing title is kept and left to the audit. De-duplicated once, after
    the union: the key set is the same as with one pass per source.
    """
    first = conform(foodcom, RECIPES, FOODCOM_RECIPE, source=SOURCE_FOODCOM)
    second = conform(
        recipenlg, RECIPES, RECIPENLG_RECIPE, RECIPENLG_ID_OFFSET, source=SOURCE_RECIPENLG
    ).filter(F.col("title").isNotNull())
    # The first title in order wins over a missing one.
    return dedup_by_key(
        first.unionByName(second), ["recipe_id"], [F.col("title").asc_nulls_last()]
    )


def conform_lists(foodcom: DataFrame, recipenlg: DataFrame) -> DataFrame:
    """(recipe_id, items) of both sources: list literals as they are."""
    return conform(foodcom, ITEM_LIST, FOODCOM_LIST).unionByName(
        conform(recipenlg, ITEM_LIST, RECIPENLG_LIST, RECIPENLG_ID_OFFSET)
    )


def conform_items(foodcom: DataFrame, recipenlg: DataFrame) -> DataFrame:
    """(recipe_id, ingredient_name_raw) of both sources, duplicates kept."""
    return explode_list(conform_lists(foodcom, recipenlg), "items", "ingredient_name_raw")


def conform_interactions(raw: DataFrame) -> DataFrame:
    """Ratings with both ids present; a bad rating or date becomes NULL."""
    return conform(raw, RAW_INTERACTIONS, RATING)
