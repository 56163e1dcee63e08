"""Every operator as a query over the driver's tables; ``larder.oracles`` has the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from larder import standins
from larder.functions.casting import blank_to_null, to_date, to_type
from larder.functions.text import normalize, parse_list
from larder.operators import audits, layout, rejects
from larder.operators.conform import FOODCOM_RECIPE, conform_recipes
from larder.operators.dedup import dedup_by_key
from larder.operators.dimension import (
    ingredient_dimension,
    measured,
    normalized_lists,
    recipe_ingredients,
    stage_items,
)
from larder.operators.ids import row_ids
from larder.operators.postings import write_postings
from larder.operators.references import keep_referenced, orphans
from larder.operators.summaries import RatingSums
from larder.plans import ranking, refresh, search
from larder.plans.curate import CuratedTables, curate, open_curated
from larder.schema import RECIPES
from larder.sources import inventory, raw_csv, tables
from larder.sources.incremental import Landing
from larder.standins import table
from larder.workspace import scratch_path, session_database, stage

Query = Callable[[SparkSession, str], DataFrame]

TERM = "cold widget"
SECOND_TERM = "small widget"


# --- queries -------------------------------------------------------------------------------


def top_rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 with J4, A4-A6, F6, O1."""
    return ranking.top_rated(
        standins.ranked_recipes(spark, sf_dir), standins.ratings(spark, sf_dir)
    )


def top_rated_agg_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 with the threshold and the ranking before the join."""
    return ranking.top_rated_agg_first(
        standins.ranked_recipes(spark, sf_dir), standins.ratings(spark, sf_dir)
    )


def quick_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 with F5, O2."""
    return ranking.quick_recipes(standins.ranked_recipes(spark, sf_dir))


def ingredient_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 with J3, F4, O3, P9."""
    return search.ingredient_search(*standins.search_tables(spark, sf_dir), TERM)


def ingredient_search_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1u: Q1 without a limit."""
    return search.ingredient_search(*standins.search_tables(spark, sf_dir), TERM, limit=None)


def multi_ingredient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4 with J5, J6, E9."""
    return search.multi_ingredient(
        *standins.search_tables(spark, sf_dir), [TERM, SECOND_TERM]
    )


def multi_ingredient_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 for k terms, without a limit."""
    return search.multi_ingredient_k(
        *standins.search_tables(spark, sf_dir), [TERM, SECOND_TERM]
    )


# --- sources, casts, conforming ------------------------------------------------------------


def _documents_csv(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "documents-csv")
    tables.write_csv(table(spark, sf_dir, "documents"), path)
    return path


def _as_documents(text: DataFrame) -> DataFrame:
    return text.select(
        to_type("doc_id", "long").alias("doc_id"),
        "text",
        "lang",
        "source",
        to_type("n_chars", "long").alias("n_chars"),
    )


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as CSV and back through the multi-line scan."""
    return _as_documents(raw_csv.scan_csv(spark, _documents_csv(spark, sf_dir)))


def csv_split_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same CSV landed by tasks that share each file."""
    landed = raw_csv.land_csv(
        spark, _documents_csv(spark, sf_dir), scratch_path(spark, "landed"), split_above=0
    )
    return _as_documents(landed)


def csv_odd_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in several files with a byte order mark and blank lines before the header
    and blank lines between records, landed by tasks that share each file."""
    quoted = [
        F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
        for c in ("text", "lang", "source")
    ]
    record = F.concat_ws(",", "doc_id", *quoted, "n_chars")
    docs = table(spark, sf_dir, "documents").select(
        (F.col("doc_id") % 16).alias("file"),
        F.when(F.col("doc_id") % 3 == 0, F.concat(record, F.lit("\n"))).otherwise(record).alias("value"),
        F.lit(1).alias("after"),
    )
    header = F.lit("\ufeff\n\ndoc_id,text,lang,source,n_chars")
    heads = docs.select("file", header.alias("value"), F.lit(0).alias("after")).distinct()
    lines = docs.unionByName(heads).repartition("file").sortWithinPartitions("file", "after")
    path = scratch_path(spark, "odd-csv")
    lines.drop("after").write.partitionBy("file").text(path)
    return _as_documents(raw_csv.land_csv(spark, path, scratch_path(spark, "landed"), split_above=0))


def curated_load_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose columns come in different orders, loaded by name."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("recipe_id"),
        F.col("o_orderpriority").alias("title"),
        F.col("o_custkey").alias("minutes"),
        F.lit(None).cast("int").alias("n_steps"),
        F.length("o_orderpriority").alias("n_ingredients"),
        F.col("o_orderdate").cast("date").alias("submitted"),
        F.col("o_orderstatus").alias("source"),
    )
    path = scratch_path(spark, "mixed-csv")
    odd = F.col("recipe_id") % 2 == 1
    tables.write_csv(orders.filter(odd), f"{path}/file=1")
    tables.write_csv(orders.filter(~odd).select(*reversed(orders.columns)), f"{path}/file=2")
    return tables.load_csv(spark, path, RECIPES)


def curated_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV with blanks loaded under declared types, matched by name."""
    blank_if_low = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey"))
    orders = table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("source"),
        F.col("o_orderdate").cast("date").alias("submitted"),
        blank_if_low.alias("minutes"),
        F.nullif(F.length("o_orderpriority"), F.lit(8)).alias("n_steps"),
        F.replace("o_orderpriority", F.lit("-LOW"), F.lit("")).alias("n_ingredients"),
        F.col("o_orderpriority").alias("title"),
        F.col("o_orderkey").alias("recipe_id"),
    )
    path = scratch_path(spark, "orders-csv")
    tables.write_csv(orders, path)
    loaded = tables.load_csv(spark, path, RECIPES)
    return tables.replace_table(loaded, scratch_path(spark, "orders"), RECIPES)


def blank_to_null_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blanks to NULL."""
    without_english = F.replace("lang", F.lit("en"), F.lit(""))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        blank_to_null(without_english).alias("foreign_lang"),
        blank_to_null("source").alias("source"),
    )


def cast_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text that is no number, out of range, or no date becomes NULL."""
    digits = F.regexp_replace("props", "[^0-9]", "")
    day = F.col("ts").cast("date")
    some_day = F.concat(F.date_format(day, "yyyy-MM-"), F.lpad(digits, 2, "0"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        to_type(F.replace("props", F.lit('{"k": 9}'), F.lit("9")), "long").alias("nine"),
        to_type(digits, "int").alias("k"),
        to_type(F.concat(digits, digits), "tinyint").alias("k_twice"),
        day.alias("day"),
        to_date(some_day).alias("some_day"),
    )


def conform_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources under one schema, ids kept apart."""
    foodcom = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_custkey").cast("string").alias("minutes"),
        F.replace("o_orderpriority", F.lit("-LOW"), F.lit("")).alias("n_steps"),
        F.length("o_orderpriority").cast("string").alias("n_ingredients"),
        F.col("o_orderdate").cast("date").cast("string").alias("submitted"),
    )
    recipenlg = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("row_idx"), F.col("s_name").alias("title")
    )
    return conform_recipes(foodcom, recipenlg)


# --- text, dimension, keys -----------------------------------------------------------------


def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1-E6."""
    normalized = normalize("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", normalized.alias("norm"), F.length(normalized).alias("norm_length")
    )


def parse_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of every document through the list parser."""
    items = standins.word_lists(spark, sf_dir).select(
        "doc_id", F.explode(parse_list("ingredients")).alias("item")
    )
    return items.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum(F.length("item")).alias("n_item_chars"),
        F.min("item").alias("first_item"),
        F.max("item").alias("last_item"),
    )


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = standins.word_lists(spark, sf_dir).select(
        F.col("doc_id").alias("recipe_id"), "ingredients"
    )
    return normalized_lists(lists, "ingredients")


def ingredient_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct names with dense ids."""
    return ingredient_dimension(_items(spark, sf_dir))


def recipe_ingredients_junction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which recipe has which ingredient."""
    items = stage_items(_items(spark, sf_dir))
    dimension = stage(ingredient_dimension(items), "ingredients")
    return recipe_ingredients(items, dimension)


def dedup_by_key_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: one line per order, always the same one."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        F.col("l_shipdate").cast("date").alias("shipped"),
    )
    return dedup_by_key(lines, ["l_orderkey"], ["l_linenumber"])


def row_ids_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings, which may repeat, with what their generated ids span."""
    numbered = row_ids(standins.interactions(spark, sf_dir), "interaction_id")
    ids = numbered.agg(
        F.min("interaction_id"), F.max("interaction_id"), F.count_distinct("interaction_id")
    ).first()
    spans = zip(("first_id", "last_id", "n_ids"), ids, strict=True)
    return numbered.drop("interaction_id").select(
        "*", *[F.lit(value).cast("long").alias(name) for name, value in spans]
    )


def interactions_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels whose document is there and English."""
    english = table(spark, sf_dir, "documents").filter("lang = 'en'")
    return keep_referenced(table(spark, sf_dir, "labels"), english, "doc_id")


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a label."""
    return orphans(
        table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "labels")
    )


# --- audits, inventory ---------------------------------------------------------------------


def _audited(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    recipes, ingredients, junction = standins.search_tables(spark, sf_dir)
    return {
        "recipes": recipes.withColumn("source", F.lit("orders")),
        "ingredients": ingredients.withColumn(
            "ingredient_name_raw", F.col("ingredient_name_norm")
        ),
        "recipe_ingredients": junction,
        "interactions": table(spark, sf_dir, "labels").select(
            F.col("doc_id").alias("interaction_id"),
            F.col("quality").cast("long").alias("user_id"),
            F.col("doc_id").alias("recipe_id"),
        ),
    }


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7, U2."""
    return audits.row_counts(_audited(spark, sf_dir))


def schema_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every declared rule over the four tables."""
    return audits.audit(_audited(spark, sf_dir))


def key_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is (order, line number) a key?"""
    return audits.key_summary(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order, line number) pairs held by several rows."""
    return audits.duplicate_keys(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


def length_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: texts and tags beyond the declared bounds."""
    return audits.too_long_counts(
        table(spark, sf_dir, "documents"), {"text": 512, "source": 32, "lang": 1}
    )


def null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULLs per column."""
    return audits.null_counts(
        table(spark, sf_dir, "documents"), ["doc_id", "text", "lang", "source", "n_chars"]
    )


def _table_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, n_rows) of the tables read here; a table may be a file or a folder of files."""
    parts = [
        inventory.rows_per_file(table(spark, sf_dir, name)) for name in sorted(standins.SCHEMAS)
    ]
    files = reduce(DataFrame.unionByName, parts)
    name = F.regexp_extract("path", r"/(\w+[.]parquet)(?:/[^/]*)?$", 1).alias("file")
    return files.groupBy(name).agg(F.sum("n_rows").alias("n_rows"))


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables as they lie in the folder, with their rows."""
    return _table_files(spark, sf_dir)


def directory_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many tables hold rows, and how many rows."""
    return _table_files(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("n_rows").alias("n_rows")
    )


def missing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected files that hold no rows, or are not there."""
    return inventory.missing_files(
        _table_files(spark, sf_dir), ["orders.parquet", "recipes.parquet", "interactions.parquet"]
    )


# --- layouts -------------------------------------------------------------------------------


def layout_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: Q1u over the junction sorted by ingredient."""
    recipes, ingredients, junction = standins.search_tables(spark, sf_dir)
    laid_out = layout.junction_by_ingredient(junction, scratch_path(spark, "junction"))
    return search.ingredient_search(recipes, ingredients, laid_out, TERM, limit=None)


def ratings_layout(spark: SparkSession, sf_dir: str, buckets: int = 8) -> layout.RatingsLayout:
    path = scratch_path(spark, "ratings")
    name = f"{session_database(spark)}.ratings_{path.rsplit('-', 1)[-1]}"
    return layout.ratings_by_recipe(
        standins.ratings(spark, sf_dir),
        standins.ranked_recipes(spark, sf_dir),
        name,
        path,
        buckets,
    )


def layout_top_rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: Q2 over tables bucketed by recipe."""
    laid_out = ratings_layout(spark, sf_dir)
    return ranking.top_rated_laid_out(laid_out, laid_out.recipes)


def layout_quick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3: Q3 over recipes sorted by cooking time."""
    recipes = standins.ranked_recipes(spark, sf_dir)
    return ranking.quick_recipes(
        layout.recipes_by_minutes(recipes, scratch_path(spark, "recipes"))
    )


def layout_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4: Q3 after going back to a plain layout."""
    recipes = standins.ranked_recipes(spark, sf_dir)
    path = scratch_path(spark, "recipes")
    sorted_copy = layout.recipes_by_minutes(recipes, path)
    return ranking.quick_recipes(layout.plain(sorted_copy, path + "-plain"))


def layout_zorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1, L3: one copy ordered by recipe and cooking time at once, asked by both."""
    recipes = standins.ranked_recipes(spark, sf_dir)
    copy = layout.recipes_zordered(recipes, scratch_path(spark, "zorder"))
    quick = ranking.quick_recipes(copy).withColumn("asked", F.lit("minutes"))
    low = copy.filter("recipe_id <= 20").withColumn("asked", F.lit("recipe_id"))
    return quick.unionByName(low)


def layout_bloom_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1, Q1: junction rows of one recipe from a copy in no order, by the row groups' filters."""
    _, _, junction = standins.search_tables(spark, sf_dir)
    copy = layout.with_bloom_filters(
        junction, scratch_path(spark, "bloom"), "recipe_id", per_row_group=200_000, files=8
    )
    return copy.filter("recipe_id = 1").groupBy("recipe_id", "ingredient_id").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


# --- loading again -------------------------------------------------------------------------


def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the English documents get ids, then those of all; the first keep theirs."""
    docs = standins.word_lists(spark, sf_dir).withColumnRenamed("doc_id", "recipe_id")
    is_english = F.coalesce(F.col("lang") == "en", F.lit(False))

    def names(lists: DataFrame) -> DataFrame:
        return normalized_lists(lists, "ingredients").select("ingredient_name_norm").distinct()

    path = scratch_path(spark, "ids")
    # Those of all are the first load's and those of the rest, so that no list is parsed twice.
    first = stage(names(docs.filter(is_english)), "first-load")
    refresh.named_ids(first, path)
    return refresh.named_ids(first.union(names(docs.filter(~is_english))), path)


def incremental_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents landed in two goes. In the second, files are new, replaced and removed."""
    docs = table(spark, sf_dir, "documents")
    english = F.col("lang") == "en"
    raw = scratch_path(spark, "raw")
    landing = Landing(spark, scratch_path(spark, "landing"))
    tables.write_csv(docs.filter(english), f"{raw}/part=en")
    tables.write_csv(docs.filter(english), f"{raw}/part=other")
    landing.land(raw)
    tables.write_csv(docs.filter(F.coalesce(~english, F.lit(True))), f"{raw}/part=other")
    landing.land(raw)
    return _as_documents(landing.read())


def top_rated_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of ratings merged batch by batch, one of them offered twice."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("recipe_id"), F.col("l_quantity").alias("rating"), "l_returnflag"
    )
    sums = RatingSums(spark, scratch_path(spark, "sums"), "double")
    returned = F.col("l_returnflag") == "R"
    for batch, of in (("returned", returned), ("rest", ~returned), ("rest", ~returned), ("unknown", returned.isNull())):
        sums.merge(batch, lines.filter(of).select("recipe_id", "rating"))
    return ranking.top_rated_of_sums(standins.ranked_recipes(spark, sf_dir), sums.read())


def multi_ingredient_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4, J5, J6 over bitmaps of recipe ids."""
    recipes, ingredients, junction = standins.search_tables(spark, sf_dir)
    postings = write_postings(junction, scratch_path(spark, "postings"))
    return search.multi_ingredient_bitmap(
        recipes, ingredients, postings, [TERM, SECOND_TERM], limit=None
    )


def _refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_csv.scan_csv(spark, standins.raw_recipe_files(spark, sf_dir).foodcom_recipes)
    return stage(rejects.checked(raw, RECIPES, FOODCOM_RECIPE, carry=["name"], source="foodcom"), "checked")


def rejected_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw value that its type refused, with the reason."""
    return rejects.rejected_values(_refused(spark, sf_dir), ["name"])


def rejected_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in, kept and dropped, and values lost on the way."""
    return rejects.loss_summary(_refused(spark, sf_dir))


def refreshed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded twice, the second time with nothing new; rows per table."""
    raw, out = standins.raw_recipe_files(spark, sf_dir), scratch_path(spark, "refreshed")
    refresh.refresh(spark, raw, out)
    return refresh.refresh(spark, raw, out).tables.row_counts()


# --- the whole job -------------------------------------------------------------------------


def curated_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV to four curated tables; rows per table."""
    raw = standins.raw_recipe_files(spark, sf_dir)
    return curate(spark, raw, scratch_path(spark, "curated")).row_counts()


def _curated(spark: SparkSession, sf_dir: str) -> CuratedTables:
    """Curated, and opened again from where it was written."""
    out = scratch_path(spark, "curated")
    curate(spark, standins.raw_recipe_files(spark, sf_dir), out)
    return open_curated(spark, out)


def curated_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain, every column of the recipes: good, malformed and blank values."""
    return _curated(spark, sf_dir).recipes


def curated_junction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain, every pair with its ingredient's name."""
    done = _curated(spark, sf_dir)
    named = measured(done.ingredients, "ingredient_name_raw", "ingredient_name_norm")
    return done.recipe_ingredients.join(named, "ingredient_id").select(
        "recipe_id", "ingredient_id", "ingredient_name_raw", "ingredient_name_norm"
    )


def curated_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain, every rating with what the generated ids span."""
    interactions = _curated(spark, sf_dir).interactions
    ids = interactions.agg(
        F.min("interaction_id"), F.max("interaction_id"), F.count_distinct("interaction_id")
    ).first()
    spans = zip(("first_id", "last_id", "n_ids"), ids, strict=True)
    return interactions.drop("interaction_id").select(
        "*", *[F.lit(value).cast("long").alias(name) for name, value in spans]
    )


def curated_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4 over the curated tables, opened again: documents with both words."""
    done = _curated(spark, sf_dir)
    return search.multi_ingredient(
        done.recipes, done.ingredients, done.recipe_ingredients, ["The", "of"], limit=None
    )


QUERIES: dict[str, Query] = {
    "top_rated": top_rated,
    "top_rated_agg_first": top_rated_agg_first,
    "quick_recipes": quick_recipes,
    "ingredient_search": ingredient_search,
    "ingredient_search_all": ingredient_search_all,
    "multi_ingredient": multi_ingredient,
    "multi_ingredient_k": multi_ingredient_k,
    "csv_roundtrip": csv_roundtrip,
    "csv_split_landing": csv_split_landing,
    "csv_odd_landing": csv_odd_landing,
    "curated_load": curated_load,
    "curated_load_mixed_headers": curated_load_mixed_headers,
    "blank_to_null": blank_to_null_columns,
    "cast_lenient": cast_lenient,
    "conform_union": conform_union,
    "normalize_text": normalize_text,
    "parse_explode": parse_explode,
    "ingredient_dim": ingredient_dim,
    "recipe_ingredients": recipe_ingredients_junction,
    "dedup_by_key": dedup_by_key_orders,
    "row_ids": row_ids_interactions,
    "interactions_fk": interactions_fk,
    "fk_orphans": fk_orphans,
    "row_counts": row_counts,
    "schema_audit": schema_audit,
    "key_audit": key_audit,
    "duplicate_keys": duplicate_keys,
    "length_audit": length_audit,
    "null_audit": null_audit,
    "file_inventory": file_inventory,
    "directory_totals": directory_totals,
    "missing_files": missing_files,
    "layout_search": layout_search,
    "layout_top_rated": layout_top_rated,
    "layout_quick": layout_quick,
    "layout_plain": layout_plain,
    "layout_zorder": layout_zorder,
    "layout_bloom_lookup": layout_bloom_lookup,
    "stable_ids": stable_ids,
    "incremental_landing": incremental_landing,
    "top_rated_maintained": top_rated_maintained,
    "multi_ingredient_bitmap": multi_ingredient_bitmap,
    "rejected_values": rejected_values,
    "rejected_summary": rejected_summary,
    "refreshed_tables": refreshed_tables,
    "curated_tables": curated_tables,
    "curated_recipes": curated_recipes,
    "curated_junction": curated_junction,
    "curated_interactions": curated_interactions,
    "curated_search": curated_search,
}
