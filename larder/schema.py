"""Declared table schemas and the integrity rules that go with them.

Spark enforces none of the rules on write, so they are data for the audits in
``larder.operators.audits``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Source tags, the id offset that keeps the two sources apart, VARCHAR bounds.
SOURCE_FOODCOM = "foodcom"
SOURCE_RECIPENLG = "recipenlg"
RECIPENLG_ID_OFFSET = 10_000_000
TITLE_MAX = 512
SOURCE_MAX = 32
INGREDIENT_NAME_MAX = 255

RECIPES = T.StructType(
    [
        T.StructField("recipe_id", T.LongType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("minutes", T.IntegerType()),
        T.StructField("n_steps", T.IntegerType()),
        T.StructField("n_ingredients", T.IntegerType()),
        T.StructField("submitted", T.DateType()),
        T.StructField("source", T.StringType(), False),
    ]
)
INGREDIENTS = T.StructType(
    [
        T.StructField("ingredient_id", T.IntegerType(), False),
        T.StructField("ingredient_name_raw", T.StringType(), False),
        T.StructField("ingredient_name_norm", T.StringType(), False),
    ]
)
RECIPE_INGREDIENTS = T.StructType(
    [
        T.StructField("recipe_id", T.LongType(), False),
        T.StructField("ingredient_id", T.IntegerType(), False),
    ]
)
INTERACTIONS = T.StructType(
    [
        T.StructField("interaction_id", T.LongType(), False),
        T.StructField("user_id", T.LongType(), False),
        T.StructField("recipe_id", T.LongType(), False),
        T.StructField("rating", T.ByteType()),
        T.StructField("interaction_date", T.DateType()),
    ]
)


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableRules:
    """What the schema declares about one table beyond its column types."""

    schema: T.StructType
    keys: tuple[tuple[str, ...], ...]
    foreign_keys: tuple[ForeignKey, ...] = ()
    max_lengths: dict[str, int] = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


RULES = {
    "recipes": TableRules(
        RECIPES,
        keys=(("recipe_id",),),
        max_lengths={"title": TITLE_MAX, "source": SOURCE_MAX},
    ),
    "ingredients": TableRules(
        INGREDIENTS,
        keys=(("ingredient_id",), ("ingredient_name_norm",)),
        max_lengths={
            "ingredient_name_raw": INGREDIENT_NAME_MAX,
            "ingredient_name_norm": INGREDIENT_NAME_MAX,
        },
    ),
    "recipe_ingredients": TableRules(
        RECIPE_INGREDIENTS,
        keys=(("recipe_id", "ingredient_id"),),
        foreign_keys=(
            ForeignKey("recipe_id", "recipes", "recipe_id"),
            ForeignKey("ingredient_id", "ingredients", "ingredient_id"),
        ),
    ),
    "interactions": TableRules(
        INTERACTIONS,
        keys=(("interaction_id",),),
        foreign_keys=(ForeignKey("recipe_id", "recipes", "recipe_id"),),
    ),
}


def all_strings(*names: str) -> T.StructType:
    """Raw files carry no types: every column is read as text and cast on selection."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])
