"""Loading again (S5, S7, S8, W1, W2): only what changed is landed, and keys stay as they were.

``refresh`` keeps, under ``out``: the raw rows by file, the ids given out so far, the numbered ratings by
file, and the rating sums. Each compares what it holds with what is landed, so a load that failed at any
point is made whole by the next. The curated tables are made from those.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from larder.operators.conform import RATING, RAW_INTERACTIONS, conform, conform_lists, conform_recipes
from larder.operators.dimension import normalized_lists, recipe_ingredients, stage_items
from larder.operators.references import keep_referenced
from larder.operators.stable import extend_ids, last_id, number_on, open_or_empty
from larder.operators.summaries import RatingSums
from larder.plans import ranking
from larder.plans.curate import CuratedTables, RawPaths
from larder.schema import (
    INGREDIENTS,
    INTERACTIONS,
    RECIPE_INGREDIENTS,
    RECIPES,
    SOURCE_FOODCOM,
    SOURCE_RECIPENLG,
)
from larder.sizing import sized_for
from larder.sources.incremental import Landing
from larder.sources.tables import replace_table
from larder.sources.versioned import Versioned
from larder.workspace import scratch_scope, stage

FILE_KEY = T.StructField("file_key", T.StringType())
NUMBERED = T.StructType([*INTERACTIONS.fields, FILE_KEY])
RAW_BY_FILE = T.StructType([*RAW_INTERACTIONS.fields, FILE_KEY])


@dataclass(frozen=True)
class Refreshed:
    """The curated tables, and the rating sums kept up with them."""

    tables: CuratedTables
    sums: RatingSums

    def top_rated(
        self, min_ratings: int = ranking.MIN_RATINGS, limit: int = ranking.DISPLAY_LIMIT
    ) -> DataFrame:
        """Q2 without reading a rating."""
        return ranking.top_rated_of_sums(self.tables.recipes, self.sums.read(), min_ratings, limit)


def named_ids(items: DataFrame, path: str) -> DataFrame:
    """The dimension of the names in ``items``, with ids from the table at ``path``, kept up."""
    names = stage(items.select("ingredient_name_norm").distinct(), "names")
    known = extend_ids(names, path, "ingredient_name_norm", INGREDIENTS["ingredient_id"])
    return known.join(names, "ingredient_name_norm", "left_semi").select(
        "ingredient_id",
        F.col("ingredient_name_norm").alias("ingredient_name_raw"),
        "ingredient_name_norm",
    )


@dataclass(frozen=True)
class NumberedRatings:
    """Ratings with ids under ``root``, in the partitions they are landed in."""

    landing: Landing
    root: str

    def _rows(self) -> DataFrame:
        return open_or_empty(self.landing.spark, f"{self.root}/rows", NUMBERED)

    def number(self) -> None:
        """Give ids to the ratings of files that have none yet; all others are left as they are.

        Every rating gets one, also if its recipe is not known yet: it keeps it when that comes.
        Ids of files that are gone are not given out again.
        """
        spark = self.landing.spark
        done = Versioned(spark, f"{self.root}/done", "file_key string")
        pending = stage(self.landing.keys().join(done.read(), "file_key", "left_anti"), "pending")
        if pending.isEmpty():
            return
        raw = conform(self.landing.read(pending), RAW_BY_FILE, RATING | {"file_key": "file_key"})
        before = last_id(self._rows(), "interaction_id")
        (
            number_on(raw, "interaction_id", before)
            .select(*NUMBERED.names)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("file_key")
            .parquet(f"{self.root}/rows")
        )
        done.write(done.read().union(pending))

    def of(self, keys: DataFrame) -> DataFrame:
        """Numbered ratings of some files, current or not."""
        return self._rows().join(keys, "file_key", "left_semi")

    def read(self) -> DataFrame:
        return self.of(self.landing.keys()).select(*INTERACTIONS.names)

    def add_up(self, sums: RatingSums) -> None:
        """Bring ``sums`` to the current files, reading only those that came or went."""

        def ratings_of(batches: DataFrame) -> DataFrame:
            return self.of(batches.select(F.col("batch").alias("file_key"))).select("recipe_id", "rating")

        sums.sync(self.landing.keys().select(F.col("file_key").alias("batch")), ratings_of)


def refresh(spark: SparkSession, raw: RawPaths, out: str) -> Refreshed:
    """``curate`` for raw folders that grow and change, run as often as they do.

    Unchanged files are not opened, ingredients and ratings keep their ids, and rating sums are
    brought up to date from the changed files' ratings alone.
    """
    curated = f"{out}/curated"
    foodcom = Landing(spark, f"{out}/raw/{SOURCE_FOODCOM}/recipes")
    landed = Landing(spark, f"{out}/raw/{SOURCE_FOODCOM}/interactions")
    recipenlg = Landing(spark, f"{out}/raw/{SOURCE_RECIPENLG}/recipes")
    ratings = NumberedRatings(landed, f"{out}/keys/interactions")
    sums = RatingSums(spark, f"{out}/sums")
    inputs = (raw.foodcom_recipes, raw.foodcom_interactions, raw.recipenlg)
    with scratch_scope(spark), sized_for(spark, *inputs):
        for landing, path in zip((foodcom, landed, recipenlg), inputs, strict=True):
            landing.land(path)
        ratings.number()
        ratings.add_up(sums)
        sources = foodcom.read(), recipenlg.read()
        recipes = replace_table(conform_recipes(*sources), f"{curated}/recipes", RECIPES)
        items = stage_items(normalized_lists(conform_lists(*sources), "items"))
        ingredients = replace_table(
            named_ids(items, f"{out}/keys/ingredients"), f"{curated}/ingredients", INGREDIENTS
        )
        junction = replace_table(
            recipe_ingredients(items, ingredients),
            f"{curated}/recipe_ingredients",
            RECIPE_INGREDIENTS,
        )
        known = keep_referenced(ratings.read(), recipes, "recipe_id", unique_parent=True)
        interactions = replace_table(known, f"{curated}/interactions", INTERACTIONS)
    return Refreshed(CuratedTables(recipes, ingredients, junction, interactions), sums)
