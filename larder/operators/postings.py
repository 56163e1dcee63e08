"""Postings as bitmaps: which recipes have an ingredient, 32,768 ids to a block.

A block lists its words of 64 ids that are not empty, so its size follows the ids it holds: an
ingredient that is in one recipe of a block takes one word, one in all of them 512.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from larder.operators.layout import range_sorted
from larder.workspace import stage

# Ids of one block, and of one word of its bitmap.
BLOCK_BITS = 15
WORD_BITS = 6


def postings(recipe_ingredients: DataFrame) -> DataFrame:
    """(ingredient_id, block, recipes): a bit for each recipe of the block that has the ingredient.

    Pairs are dealt by ingredient and block before they are aggregated, so it is ids that are
    shuffled. A very common ingredient spreads over its blocks, each of which holds a bounded
    number of ids however often pairs repeat.
    """
    pairs = recipe_ingredients.filter("recipe_id IS NOT NULL AND ingredient_id IS NOT NULL")
    placed = pairs.select(
        "ingredient_id",
        F.shiftright("recipe_id", BLOCK_BITS).alias("block"),
        F.expr(f"cast(shiftright(recipe_id, {WORD_BITS}) & {(1 << BLOCK_BITS - WORD_BITS) - 1} AS smallint)").alias("word"),
        F.expr(f"shiftleft(1L, cast(recipe_id & {(1 << WORD_BITS) - 1} AS int))").alias("bit"),
    )
    words = (
        placed.repartition("ingredient_id", "block")
        .groupBy("ingredient_id", "block", "word")
        .agg(F.bit_or("bit").alias("bits"))
    )
    return words.groupBy("ingredient_id", "block").agg(
        F.collect_list(F.struct("word", "bits")).alias("recipes")
    )


def write_postings(recipe_ingredients: DataFrame, path: str, files: int | None = None) -> DataFrame:
    """``postings`` as Parquet by ingredient, so that the scan of a few ingredients skips the others."""
    return range_sorted(
        stage(postings(recipe_ingredients), "postings"), path, ["ingredient_id", "block"], files
    )


def recipes_with_all(table: DataFrame, terms: list[list[int]]) -> DataFrame:
    """Ids of recipes that have, for each of ``terms``, one of its ingredients at least."""
    wanted = sorted({i for ids in terms for i in ids})
    if not all(terms):
        return table.filter(F.lit(False)).select(F.col("block").alias("recipe_id"))
    has = [F.expr(f"ingredient_id IN ({', '.join(map(str, ids))})") for ids in terms]
    return _in_all(table.filter(F.expr(f"ingredient_id IN ({', '.join(map(str, wanted))})")), has)


def recipes_with_all_named(table: DataFrame, ingredients: DataFrame, names: list[Column]) -> DataFrame:
    """The same for names of ``ingredients``, of which any number may share a name: ids are joined."""
    named = (
        ingredients.filter(F.col("ingredient_name_norm").isin(*names))
        .select("ingredient_id", "ingredient_name_norm")
        .distinct()
    )
    return _in_all(
        table.join(named, "ingredient_id"), [F.col("ingredient_name_norm") == name for name in names]
    )


def _in_all(chosen: DataFrame, has: list[Column]) -> DataFrame:
    """Ids of recipes in ``chosen`` postings that meet each of ``has``.

    Words of a term are united and those of all terms intersected; only words are shuffled, one per
    place and task. Words that miss a term, or end up empty, are dropped before any id is spelled out.
    """
    flags = [f"has{i}" for i in range(len(has))]
    words = chosen.select(
        "block", F.explode("recipes").alias("of"), *[h.alias(flag) for h, flag in zip(has, flags, strict=True)]
    )
    united = words.groupBy("block", F.col("of.word").alias("word")).agg(
        *[F.bit_or(F.when(F.col(flag), F.col("of.bits"))).alias(flag) for flag in flags]
    )
    # A term without a word here is null, and so is what it is intersected with.
    bits = reduce(lambda a, b: a.bitwiseAND(b), [F.col(flag) for flag in flags])
    met = united.select("block", "word", bits.alias("bits")).filter("bits <> 0")
    return met.select(
        (F.shiftleft("block", BLOCK_BITS) + F.shiftleft("word", WORD_BITS)).alias("first"),
        F.explode(set_bits("bits")).alias("bit"),
    ).select((F.col("first") + F.col("bit")).alias("recipe_id"))


def set_bits(word: str) -> Column:
    """Numbers of the bits that are set in a word, in order."""
    places = F.sequence(F.lit(0), F.lit((1 << WORD_BITS) - 1))
    return F.filter(places, lambda b: F.getbit(word, b) == 1)
