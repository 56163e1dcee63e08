"""The whole curation job: raw CSV to four keyed tables (S6, S8 and the chain)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from larder.operators.audits import audit, row_counts
from larder.operators.conform import conform_interactions, conform_lists, conform_recipes
from larder.operators.dimension import (
    ingredient_dimension,
    normalized_lists,
    recipe_ingredients,
    stage_items,
)
from larder.operators.ids import row_ids
from larder.operators.references import keep_referenced
from larder.schema import (
    INGREDIENTS,
    INTERACTIONS,
    RECIPE_INGREDIENTS,
    RECIPES,
    RULES,
    SOURCE_FOODCOM,
    SOURCE_RECIPENLG,
)
from larder.sizing import sized_for
from larder.sources.raw_csv import land_csv
from larder.sources.tables import replace_table, write_csv
from larder.workspace import scratch_scope


@dataclass(frozen=True)
class RawPaths:
    """Where the three raw files (or folders of them) are."""

    foodcom_recipes: str
    foodcom_interactions: str
    recipenlg: str


@dataclass(frozen=True)
class CuratedTables:
    recipes: DataFrame
    ingredients: DataFrame
    recipe_ingredients: DataFrame
    interactions: DataFrame

    def by_name(self) -> dict[str, DataFrame]:
        return dict(vars(self))

    def row_counts(self) -> DataFrame:
        """Counted from the written tables, which costs file footers and no recomputation."""
        return row_counts(self.by_name())

    def audit(self) -> DataFrame:
        return audit(self.by_name())


def land_raw(spark: SparkSession, raw: RawPaths, out: str) -> tuple[DataFrame, ...]:
    """The three raw files as Parquet under ``out/raw/<source>/``."""
    return (
        land_csv(spark, raw.foodcom_recipes, f"{out}/raw/{SOURCE_FOODCOM}/recipes"),
        land_csv(spark, raw.foodcom_interactions, f"{out}/raw/{SOURCE_FOODCOM}/interactions"),
        land_csv(spark, raw.recipenlg, f"{out}/raw/{SOURCE_RECIPENLG}/recipes"),
    )


def curate(spark: SparkSession, raw: RawPaths, out: str) -> CuratedTables:
    """Land, conform, key and write the four tables under ``out/curated/``.

    Every table that is used twice is written before its second use. Widths follow the input's size.
    """
    curated = f"{out}/curated"
    inputs = (raw.foodcom_recipes, raw.foodcom_interactions, raw.recipenlg)
    with scratch_scope(spark), sized_for(spark, *inputs):
        foodcom, ratings, recipenlg = land_raw(spark, raw, out)
        recipes = replace_table(
            conform_recipes(foodcom, recipenlg), f"{curated}/recipes", RECIPES
        )
        items = stage_items(normalized_lists(conform_lists(foodcom, recipenlg), "items"))
        ingredients = replace_table(
            ingredient_dimension(items), f"{curated}/ingredients", INGREDIENTS
        )
        junction = replace_table(
            recipe_ingredients(items, ingredients),
            f"{curated}/recipe_ingredients",
            RECIPE_INGREDIENTS,
        )
        known = keep_referenced(
            conform_interactions(ratings), recipes, "recipe_id", unique_parent=True
        )
        numbered = row_ids(known, "interaction_id")
        interactions = replace_table(numbered, f"{curated}/interactions", INTERACTIONS)
    return CuratedTables(recipes, ingredients, junction, interactions)


def open_curated(spark: SparkSession, out: str) -> CuratedTables:
    """The four tables that ``curate`` has written under ``out``, in this session or another."""
    return CuratedTables(
        **{
            name: spark.read.schema(rules.schema).parquet(f"{out}/curated/{name}")
            for name, rules in RULES.items()
        }
    )


def export_csv(tables: CuratedTables, out: str, single_file: bool = False) -> None:
    """The four tables as CSV under ``out/<table>``."""
    for name, df in tables.by_name().items():
        write_csv(df, f"{out}/{name}", single_file)
