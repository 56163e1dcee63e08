"""Ingredient search: one ingredient (Q1, Q1u) and all of several (Q4)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from larder.functions.text import normalized_terms
from larder.operators.postings import recipes_with_all, recipes_with_all_named
from larder.operators.topk import join_existing, top_k_existing
from larder.steps import step

DISPLAY_LIMIT = 20

# Ids a search may turn into literals. Names are unique in the dimension, so a search resolves to
# one id per term; the bound only matters for dimensions that break that rule.
MAX_LITERAL_IDS = 1_000


def resolve_ids(ingredients: DataFrame, names: list[Column]) -> list[list[int]] | None:
    """Ids of each (normalised) name, or None if there are too many to be literals."""
    is_name = [(F.col("ingredient_name_norm") == name).alias(f"n{i}") for i, name in enumerate(names)]
    named = (
        ingredients.filter(F.col("ingredient_name_norm").isin(*names))
        .filter(F.col("ingredient_id").isNotNull())
        .select("ingredient_id", *is_name)
        .orderBy("ingredient_id")  # one pass; a bare limit would try a few partitions at a time
        .limit(MAX_LITERAL_IDS + 1)
    )
    rows = step(named, "ids of names").collect()
    if len(rows) > MAX_LITERAL_IDS:
        return None
    return [[row[0] for row in rows if row[i + 1]] for i in range(len(names))]


def _has_id(ids: list[int]) -> Column:
    # As SQL text: hundreds of literals are one call instead of hundreds.
    return F.expr(f"ingredient_id IN ({', '.join(map(str, ids))})") if ids else F.lit(False)


def _with_ingredient(
    ingredients: DataFrame, recipe_ingredients: DataFrame, names: list[Column]
) -> list[DataFrame]:
    """Per name, the recipe ids (one row per junction row) whose ingredient has that name.

    Literal ids reach the junction scan as a pushed filter, so on the layout sorted by
    ingredient whole row groups are skipped and the junction is never shuffled by ingredient.
    """
    ids = resolve_ids(ingredients, names)
    hits = []
    for i, name in enumerate(names):
        if ids is None:
            named = ingredients.filter(F.col("ingredient_name_norm") == name)
            hit = recipe_ingredients.join(named.select("ingredient_id"), "ingredient_id")
        else:
            hit = recipe_ingredients.filter(_has_id(ids[i]))
        hits.append(hit.select("recipe_id"))
    return hits


def _titled(recipes: DataFrame, hits: DataFrame, limit: int | None) -> DataFrame:
    titles = recipes.select("recipe_id", "title")
    if limit is None:
        return join_existing(hits, titles, "recipe_id")
    return top_k_existing(hits, titles, "recipe_id", [F.col("recipe_id").asc()], limit)


def ingredient_search(
    recipes: DataFrame,
    ingredients: DataFrame,
    recipe_ingredients: DataFrame,
    term: str,
    limit: int | None = DISPLAY_LIMIT,
) -> DataFrame:
    """Recipes containing one ingredient, lowest ids first; ``limit=None`` gives all (Q1, Q1u)."""
    (name,) = names = normalized_terms([term])
    (hits,) = _with_ingredient(ingredients, recipe_ingredients, names)
    return _titled(recipes, hits, limit).select(
        "recipe_id", "title", name.alias("matched_ingredient")
    )


def _echo(names: list[Column]) -> Column:
    return F.concat_ws(", ", *names).alias("matched_ingredients")


def multi_ingredient(
    recipes: DataFrame,
    ingredients: DataFrame,
    recipe_ingredients: DataFrame,
    terms: list[str],
    limit: int | None = DISPLAY_LIMIT,
) -> DataFrame:
    """Recipes containing every term, as semi-joins of narrow id lists (Q4).

    Each list is made distinct first; that shuffles by recipe once, after combining on the map
    side, and the semi-joins use the same partitioning.
    """
    names = normalized_terms(terms)
    asked = normalized_terms(list(dict.fromkeys(terms)))
    hits = [hit.distinct() for hit in _with_ingredient(ingredients, recipe_ingredients, asked)]
    every = reduce(lambda left, right: left.join(right, "recipe_id", "left_semi"), hits)
    return _titled(recipes, every, limit).select("recipe_id", "title", _echo(names))


def multi_ingredient_k(
    recipes: DataFrame,
    ingredients: DataFrame,
    recipe_ingredients: DataFrame,
    terms: list[str],
    limit: int | None = None,
) -> DataFrame:
    """Q4 for many terms: one pass over the junction, one flag per term, one shuffle."""
    names = normalized_terms(terms)
    wanted = normalized_terms(list(dict.fromkeys(terms)))
    ids = resolve_ids(ingredients, wanted)
    if ids is None:
        named = ingredients.filter(F.col("ingredient_name_norm").isin(*wanted))
        hits = recipe_ingredients.join(named, "ingredient_id")
        flags = [F.col("ingredient_name_norm") == name for name in wanted]
    else:
        every_id = sorted({i for some in ids for i in some})
        hits = recipe_ingredients.filter(_has_id(every_id))
        flags = [_has_id(some) for some in ids]
    has_all = reduce(lambda a, b: a & b, [F.bool_or(flag) for flag in flags])
    complete = (
        hits.groupBy("recipe_id")
        .agg(has_all.alias("has_all"))
        .filter("has_all")
        .select("recipe_id")
    )
    return _titled(recipes, complete, limit).select("recipe_id", "title", _echo(names))


def multi_ingredient_bitmap(
    recipes: DataFrame,
    ingredients: DataFrame,
    postings: DataFrame,
    terms: list[str],
    limit: int | None = DISPLAY_LIMIT,
) -> DataFrame:
    """Q4 over ``postings``, the junction as bitmaps: blocks are intersected, not lists of ids."""
    names = normalized_terms(terms)
    asked = normalized_terms(list(dict.fromkeys(terms)))
    ids = resolve_ids(ingredients, asked)
    if ids is None:
        every = recipes_with_all_named(postings, ingredients, asked)
    else:
        every = recipes_with_all(postings, ids)
    return _titled(recipes, every, limit).select("recipe_id", "title", _echo(names))
