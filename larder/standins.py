"""The recipe tables played by the driver's tables.

orders are recipes and part are ingredients for search, lineitem is the junction; for ranking part
are recipes and lineitem the ratings; documents are raw recipes whose words are the ingredients.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from larder.plans.curate import RawPaths
from larder.sources.tables import CSV_SINK_OPTIONS
from larder.workspace import scratch_path


# Declared, so that opening a table runs no job to look into a file.
SCHEMAS = {
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, "
    "value double, props string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def search_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(recipes, ingredients, recipe_ingredients)"""
    recipes = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("recipe_id"), F.col("o_orderpriority").alias("title")
    )
    ingredients = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ingredient_id"), F.col("p_name").alias("ingredient_name_norm")
    )
    junction = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("recipe_id"), F.col("l_partkey").alias("ingredient_id")
    )
    return recipes, ingredients, junction


def ranked_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("recipe_id"),
        F.col("p_name").alias("title"),
        F.col("p_size").alias("minutes"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("recipe_id"), F.col("l_quantity").alias("rating")
    )


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings with a user and a date, no id yet."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("user_id"),
        F.col("l_partkey").alias("recipe_id"),
        F.col("l_quantity").cast("tinyint").alias("rating"),
        F.col("l_shipdate").cast("date").alias("interaction_date"),
    )


def list_literal(text: Column, separator: str) -> Column:
    """``['a', 'b']`` of the parts of ``text`` with backslashes and apostrophes escaped, as the raw
    files write lists. ``separator`` is a regular expression that matches neither of the two.

    Written in place: no part becomes a value of its own.
    """
    escaped = F.replace(
        F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")
    )
    return F.concat(F.lit("['"), F.regexp_replace(escaped, separator, "', '"), F.lit("']"))


def word_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with all words of the text as a list literal in ``ingredients``."""
    return table(spark, sf_dir, "documents").withColumn(
        "ingredients", list_literal(F.col("text"), r"\s+")
    )


def raw_recipe_files(spark: SparkSession, sf_dir: str) -> RawPaths:
    """Raw CSVs written from documents and labels: English text plays the first source.

    Numbers and dates are good, malformed, out of range or blank, by the document's id.
    """
    docs = word_lists(spark, sf_dir)
    doc_id = F.col("doc_id")
    day = F.lpad((doc_id % 28 + 1).cast("string"), 2, "0")
    title = F.concat_ws(" ", "source", F.col("doc_id").cast("string"))
    foodcom = docs.filter("lang = 'en'").select(
        title.alias("name"),
        F.col("doc_id").cast("string").alias("id"),
        F.when(doc_id % 7 == 0, "99999999999").otherwise(F.col("n_chars").cast("string")).alias("minutes"),
        F.when(doc_id % 4 == 0, "2020-02-30")
        .when(doc_id % 4 == 1, "soon")
        .when(doc_id % 4 == 2, F.concat(F.lit("2019-05-"), day))
        .otherwise("")
        .alias("submitted"),
        F.when(doc_id % 3 == 0, (doc_id % 50).cast("string"))
        .when(doc_id % 3 == 1, "x7")
        .otherwise("")
        .alias("n_steps"),
        F.col("text").alias("description"),
        "ingredients",
        F.when(doc_id % 5 == 0, "many").otherwise((doc_id % 40).cast("string")).alias("n_ingredients"),
    )
    recipenlg = docs.filter("lang <> 'en'").select(
        F.col("doc_id").cast("string").alias(" "),
        title.alias("title"),
        F.col("text").alias("directions"),
        F.col("ingredients").alias("NER"),
    )
    labels = table(spark, sf_dir, "labels").select(
        F.col("toxic").cast("string").alias("user_id"),
        F.col("doc_id").cast("string").alias("recipe_id"),
        F.when(doc_id % 3 == 0, F.concat(F.lit("2020-01-"), day))
        .when(doc_id % 3 == 1, "2020-13-01")
        .otherwise("")
        .alias("date"),
        F.when(doc_id % 4 == 0, "300").otherwise(F.col("quality").cast("string")).alias("rating"),
    )
    paths = RawPaths(
        foodcom_recipes=scratch_path(spark, "raw-recipes"),
        foodcom_interactions=scratch_path(spark, "raw-interactions"),
        recipenlg=scratch_path(spark, "raw-recipenlg"),
    )
    for df, path in (
        (foodcom, paths.foodcom_recipes),
        (labels, paths.foodcom_interactions),
        (recipenlg.withColumnRenamed(" ", ""), paths.recipenlg),
    ):
        df.write.options(**CSV_SINK_OPTIONS).csv(path)
    return paths
