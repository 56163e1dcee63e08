"""All layouts at once, and the four queries over them (L1-L3)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from larder.operators import layout
from larder.plans import ranking, search
from larder.plans.curate import CuratedTables, open_curated
from larder.schema import INTERACTIONS, RECIPE_INGREDIENTS, RECIPES


@dataclass(frozen=True)
class LaidOutTables:
    """Copies of the curated tables, each in the order its query wants."""

    ingredients: DataFrame
    junction: DataFrame
    recipes_by_id: DataFrame
    recipes_by_minutes: DataFrame
    ratings: layout.RatingsLayout

    def ingredient_search(self, term: str, limit: int | None = search.DISPLAY_LIMIT) -> DataFrame:
        return search.ingredient_search(
            self.recipes_by_id, self.ingredients, self.junction, term, limit
        )

    def multi_ingredient(
        self, terms: list[str], limit: int | None = search.DISPLAY_LIMIT
    ) -> DataFrame:
        return search.multi_ingredient(
            self.recipes_by_id, self.ingredients, self.junction, terms, limit
        )

    def top_rated(
        self, min_ratings: int = ranking.MIN_RATINGS, limit: int = ranking.DISPLAY_LIMIT
    ) -> DataFrame:
        return ranking.top_rated_laid_out(
            self.ratings, self.recipes_by_id, min_ratings, limit
        )

    def quick_recipes(
        self, under_minutes: int = ranking.QUICK_MINUTES, limit: int = ranking.DISPLAY_LIMIT
    ) -> DataFrame:
        return ranking.quick_recipes(self.recipes_by_minutes, under_minutes, limit)


RATING_COLUMNS = ("recipe_id", "rating")
TITLE_COLUMNS = ("recipe_id", "title")


def _part(schema: T.StructType, columns: tuple[str, ...]) -> T.StructType:
    return T.StructType([schema[name] for name in columns])


def open_layouts(spark: SparkSession, out: str, name: str, buckets: int) -> LaidOutTables:
    """The layouts that ``lay_out`` has written under ``out``, in this session or another."""
    root = f"{out}/layouts"

    def table(path: str, schema: T.StructType) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{root}/{path}")

    return LaidOutTables(
        ingredients=open_curated(spark, out).ingredients,
        junction=table("junction", RECIPE_INGREDIENTS),
        recipes_by_id=table("recipes_by_id", RECIPES),
        recipes_by_minutes=table("recipes_by_minutes", RECIPES),
        ratings=layout.open_ratings(
            spark,
            name,
            f"{root}/ratings",
            _part(INTERACTIONS, RATING_COLUMNS),
            _part(RECIPES, TITLE_COLUMNS),
            buckets,
        ),
    )


def lay_out(tables: CuratedTables, out: str, name: str, buckets: int) -> LaidOutTables:
    """Write the layouts under ``out/layouts/``; ``name`` prefixes the bucketed tables.

    The curated tables stay as they are, so going back means using them.
    """
    root = f"{out}/layouts"
    ratings = tables.interactions.select(*RATING_COLUMNS)
    titles = tables.recipes.select(*TITLE_COLUMNS)
    return LaidOutTables(
        ingredients=tables.ingredients,
        junction=layout.junction_by_ingredient(tables.recipe_ingredients, f"{root}/junction"),
        recipes_by_id=layout.recipes_by_id(tables.recipes, f"{root}/recipes_by_id"),
        recipes_by_minutes=layout.recipes_by_minutes(
            tables.recipes, f"{root}/recipes_by_minutes"
        ),
        ratings=layout.ratings_by_recipe(ratings, titles, name, f"{root}/ratings", buckets),
    )
