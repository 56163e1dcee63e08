"""What the plans must and must not contain, and that layouts change plans but not answers."""

import re
import uuid

import pytest
from pyspark.sql import functions as F, types as T

from larder import registry, standins
from larder.functions.text import explode_list
from larder.operators import audits, layout
from larder.operators.dimension import (
    ingredient_dimension,
    normalized_items,
    normalized_lists,
    measured,
    recipe_ingredients,
)
from larder.operators.references import keep_referenced, orphans
from larder.operators.topk import any_of
from larder.plans import ranking, search
from larder.schema import ForeignKey, TableRules
from larder.workspace import scratch_path, stage

SF_DIR = "/root/testdata/sf0.01"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df):
    df.collect()
    return plan_of(df)


def scan_rows(df):
    """Rows that left the file scans of a plan without shuffles, after collecting it."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    return sum(s.metrics().apply("numOutputRows").value() for s in scans)


@pytest.fixture
def no_broadcast(conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(registry.QUERIES[name](spark, SF_DIR))
    for operator in ("EvalPython", "InPandas", "CartesianProduct", "NestedLoop"):
        assert operator not in plan
    # A window without partitioning would pull all rows into one task.
    for single in re.findall(r"Window [^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*SinglePartition", plan):
        raise AssertionError(single)


def test_quick_recipes_pushes_both_bounds(spark):
    plan = plan_of(registry.quick_recipes(spark, SF_DIR))
    assert "TakeOrderedAndProject" in plan
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(p_size,30\)", plan)
    assert "LessThanOrEqual(p_size,ScalarSubquery" in plan


def test_search_pushes_ids_and_reads_two_columns(spark):
    _, ingredients, junction = standins.search_tables(spark, SF_DIR)
    (hits,) = search._with_ingredient(ingredients, junction, [F.lit(registry.TERM)])
    plan = plan_of(hits)
    assert "In(l_partkey, [" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan
    assert "p_name" not in plan


def test_search_takes_leaders_without_a_join_of_all_recipes(spark, conf, no_broadcast):
    conf("spark.sql.maxMetadataStringLength", "100000")
    recipes, ingredients, junction = standins.search_tables(spark, SF_DIR)
    few = junction.filter(F.col("recipe_id") < 2000)
    plan = plan_of(search.ingredient_search(recipes, ingredients, few, registry.TERM))
    assert "Exchange hashpartitioning" not in plan
    assert "In(o_orderkey," in plan and "EqualTo(o_orderkey," in plan
    # With more leaders than needed the found rows are at hand, and nothing is run again.
    assert "Scan parquet" not in plan_of(registry.ingredient_search(spark, SF_DIR))


def jobs_of(spark, run):
    group = f"jobs-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "")
    run().collect()
    ids = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(ids)


@pytest.mark.parametrize(
    ("name", "small", "large"),
    [
        ("ingredient_search", 3, 5),
        ("ingredient_search_all", 4, 6),
        ("multi_ingredient", 7, 7),
    ],
)
def test_searches_run_few_jobs(spark, conf, name, small, large):
    def run():
        return registry.QUERIES[name](spark, SF_DIR)

    assert jobs_of(spark, run) <= small
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert jobs_of(spark, run) <= large


def test_top_rated_aggregates_before_the_join(spark, no_broadcast):
    plan = plan_of(registry.top_rated(spark, SF_DIR))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan
    # Ratings: partial sums, one shuffle by recipe. Recipes: copies counted, then by recipe.
    assert plan.rindex("partial_sum(") > plan.index("SortMergeJoin")
    assert plan.count("Exchange hashpartitioning") == 3


def test_agg_first_shuffles_the_sums_only(spark, no_broadcast):
    plan = plan_of(
        ranking.rating_stats(standins.ratings(spark, SF_DIR)).filter("n_ratings >= 20")
    )
    assert plan.count("Exchange") == 1
    # The ranking has run by now; what is left reads the titles of its leaders.
    titles = plan_of(registry.top_rated_agg_first(spark, SF_DIR))
    assert "Exchange hashpartitioning" not in titles and "lineitem" not in titles


def test_multi_ingredient_shuffles_each_list_once(spark, conf):
    recipes, ingredients, junction = standins.search_tables(spark, SF_DIR)
    hits = search._with_ingredient(
        ingredients, junction, [registry.TERM, registry.SECOND_TERM]
    )
    both = hits[0].distinct().join(hits[1].distinct().hint("merge"), "recipe_id", "left_semi")
    assert plan_of(both).count("Exchange hashpartitioning") == 2
    terms = [registry.TERM, registry.SECOND_TERM]
    # The hits are written, so Spark knows how few they are and does not shuffle recipes for them.
    k_way = search.multi_ingredient_k(recipes, ingredients, junction, terms)
    plan = plan_of(k_way)
    assert "Exchange hashpartitioning" not in plan and "BroadcastExchange" in plan
    # Many hits: one shuffle for them, one for the recipes that get their titles.
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    k_way = search.multi_ingredient_k(recipes, ingredients, junction, terms)
    assert plan_of(k_way).count("Exchange hashpartitioning") == 2


def test_list_parsing_stays_in_generated_code(spark):
    lists = spark.read.parquet(f"{SF_DIR}/documents.parquet").select(
        F.col("doc_id").alias("recipe_id"), "text"
    )
    plan = final_plan_of(normalized_items(explode_list(lists, "text", "ingredient_name_raw")))
    generate = next(line for line in plan.splitlines() if "Generate explode" in line)
    assert re.search(r"\*\(\d+\) Generate", generate)


LISTS = [(1, "['Salt', 'salt!', '', 'a\\'b']"), (2, "['salt', 'rice']"), (2, "['Rice', \"oil\"]"), (None, "['rice']"),
         (None, "['RICE', 'tea']"), (3, None), (4, "['--']"), (4, "no list"), (5, "['salt', 'salt']")]


@pytest.mark.parametrize("rows", [LISTS, LISTS[:2], LISTS[2:5], []])
def test_names_of_lists_are_those_of_their_items(spark, rows):
    lists = spark.createDataFrame(rows, "recipe_id long, items string")
    want = normalized_items(explode_list(lists, "items", "ingredient_name_raw"))
    got = normalized_lists(lists, "items")
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_recipes_with_one_list_are_not_shuffled(spark):
    lists = stage(spark.range(1_000).selectExpr("id AS recipe_id", "concat('[\\'Salt\\', \\'x', id, '\\']') AS items"), "lists")
    assert "Exchange" not in final_plan_of(normalized_lists(lists, "items"))
    twice = lists.union(lists.filter("recipe_id = 7"))
    assert normalized_lists(twice, "items").count() == 2_000


def skewed(spark, rows, hot_share=3):
    """A third of the rows carry one key."""
    return spark.range(rows).select(
        F.col("id").alias("recipe_id"),
        F.when(F.col("id") % hot_share == 0, "salt")
        .otherwise(F.concat(F.lit("item "), (F.col("id") % 997).cast("string")))
        .alias("ingredient_name_norm"),
    )


@pytest.fixture
def small_skew_limits(conf, no_broadcast):
    """AQE's size limits scaled down to the size of the test."""
    conf("spark.sql.shuffle.partitions", "64")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")


def test_hot_name_is_split_in_the_junction_join(spark, small_skew_limits, monkeypatch):
    monkeypatch.setattr("larder.operators.dimension.BROADCAST_BYTES", 0)
    items = stage(skewed(spark, 60_000), "items")
    names = items.select("ingredient_name_norm").distinct()
    dimension = stage(
        names.withColumn("ingredient_id", F.hash("ingredient_name_norm")), "names"
    )
    joined = recipe_ingredients(items, dimension)
    assert "skew=true" in final_plan_of(joined)
    assert joined.count() == 60_000


def test_written_dimension_is_in_name_order(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    items = stage(skewed(spark, 10_000), "items")
    dimension = stage(ingredient_dimension(items), "names")
    one = dimension.filter(F.col("ingredient_name_norm") == "item 500")
    assert scan_rows(one) < dimension.count() / 4
    assert one.count() == 1


def test_dimension_that_fits_is_broadcast(spark, conf):
    items = stage(skewed(spark, 1_000), "items")
    dimension = stage(ingredient_dimension(items), "names")
    conf("spark.sql.autoBroadcastJoinThreshold", "1b")
    plan = plan_of(recipe_ingredients(items, dimension))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_names_that_fit_are_broadcast_to_the_junction(spark, conf):
    dimension = stage(ingredient_dimension(stage(skewed(spark, 1_000), "items")), "names")
    junction = stage(spark.range(2_000).select(F.col("id").alias("ingredient_id")), "junction")
    names = ("ingredient_name_raw", "ingredient_name_norm")
    conf("spark.sql.autoBroadcastJoinThreshold", "1b")
    assert "BroadcastHashJoin" in plan_of(junction.join(measured(dimension, *names), "ingredient_id"))
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "Broadcast" not in plan_of(junction.join(measured(dimension, *names), "ingredient_id"))


def test_no_broadcast_where_the_session_wants_none(spark, no_broadcast):
    items = stage(skewed(spark, 1_000), "items")
    dimension = stage(ingredient_dimension(items), "names")
    assert "Broadcast" not in plan_of(recipe_ingredients(items, dimension))


def test_hot_recipe_is_split_in_the_reference_filter(spark, small_skew_limits):
    ratings = stage(
        skewed(spark, 60_000).select(
            F.when(F.col("ingredient_name_norm") == "salt", 1)
            .otherwise(F.col("recipe_id"))
            .alias("recipe_id"),
            F.col("recipe_id").alias("user_id"),
        ),
        "ratings",
    )
    recipes = stage(spark.range(60_000).withColumnRenamed("id", "recipe_id"), "recipes")
    for unique_parent in (True, False):
        kept = keep_referenced(ratings, recipes, "recipe_id", unique_parent)
        assert "skew=true" in final_plan_of(kept)
        assert kept.count() == 60_000


def test_bucketed_layout_needs_no_exchange(spark, no_broadcast):
    laid_out = registry.ratings_layout(spark, SF_DIR)
    stats = ranking.rating_stats(laid_out.bucketed)
    assert "Exchange" not in plan_of(stats)
    assert "Exchange" not in plan_of(stats.join(laid_out.recipes, "recipe_id"))
    plain = ranking.rating_stats(standins.ratings(spark, SF_DIR)).join(
        standins.ranked_recipes(spark, SF_DIR), "recipe_id"
    )
    assert plan_of(plain).count("Exchange") == 2


def test_hot_recipe_stays_out_of_the_buckets(spark, tmp_path):
    """A third of all ratings belong to one recipe: its rows are not in one task's bucket."""
    ratings = stage(
        spark.range(30_000).select(
            F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 500).alias("recipe_id"),
            (F.col("id") % 6).cast("tinyint").alias("rating"),
        ),
        "ratings",
    )
    recipes = spark.range(500).select(
        F.col("id").alias("recipe_id"), F.concat(F.lit("r"), F.col("id")).alias("title")
    )
    laid_out = layout.ratings_by_recipe(
        ratings, recipes, "larder_hot", str(tmp_path / "hot"), 8
    )
    assert laid_out.hot.select("recipe_id").distinct().count() == 1
    assert laid_out.bucketed.filter("recipe_id = 5").count() == 0
    assert laid_out.bucketed.count() + laid_out.hot.count() == 30_000
    got = ranking.top_rated_laid_out(laid_out, recipes, limit=500).collect()
    want = ranking.top_rated(recipes, ratings, limit=500).collect()
    assert got == want and len(got) == 500
    spark.sql("DROP TABLE larder_hot_interactions")
    spark.sql("DROP TABLE larder_hot_recipes")


def test_null_recipe_ids_are_not_lost(spark, tmp_path):
    ratings = spark.createDataFrame([(1, 5), (None, 4), (2, 3)], "recipe_id long, rating int")
    recipes = spark.createDataFrame([(1, "a")], "recipe_id long, title string")
    laid_out = layout.ratings_by_recipe(
        ratings, recipes, "larder_null", str(tmp_path / "null"), 2
    )
    assert laid_out.bucketed.count() == 2 and laid_out.hot.count() == 1
    spark.sql("DROP TABLE larder_null_interactions")
    spark.sql("DROP TABLE larder_null_recipes")


def test_sorted_junction_is_read_in_part(spark):
    _, _, junction = standins.search_tables(spark, SF_DIR)
    laid_out = layout.junction_by_ingredient(junction, scratch_path(spark, "l1"), files=16)
    one = F.col("ingredient_id").isin([1234])
    assert scan_rows(laid_out.filter(one)) < junction.count() / 8
    assert sorted(map(tuple, laid_out.filter(one).collect())) == sorted(
        map(tuple, junction.filter(one).collect())
    )


def test_sorted_recipes_are_read_in_part(spark):
    recipes = standins.ranked_recipes(spark, SF_DIR)
    laid_out = layout.recipes_by_minutes(recipes, scratch_path(spark, "l3"), files=16)
    assert scan_rows(laid_out.filter("minutes < 5")) < recipes.count() / 4
    assert ranking.quick_recipes(laid_out).collect() == ranking.quick_recipes(recipes).collect()


def test_scattered_keys_read_only_their_row_groups(spark):
    recipes = standins.ranked_recipes(spark, SF_DIR)
    laid_out = layout.recipes_by_id(recipes, scratch_path(spark, "l0"), files=100)
    wanted = list(range(3, 2_000, 166))
    # By its ends only, this list hits every file.
    assert scan_rows(laid_out.filter(F.col("recipe_id").isin(wanted))) > 1_900
    assert scan_rows(laid_out.filter(any_of("recipe_id", wanted))) < 500
    got = laid_out.filter(any_of("recipe_id", wanted)).select("recipe_id").collect()
    assert sorted(r.recipe_id for r in got) == wanted
    assert laid_out.filter(any_of("recipe_id", [])).count() == 0


def test_hot_ingredient_spans_files(spark):
    items = skewed(spark, 30_000).select(
        "recipe_id", F.hash("ingredient_name_norm").alias("ingredient_id")
    )
    path = scratch_path(spark, "l1-hot")
    laid_out = layout.junction_by_ingredient(items, path, files=12)
    per_file = (
        laid_out.groupBy(F.input_file_name()).count().agg(F.max("count")).collect()[0][0]
    )
    assert per_file < 30_000 / 6


def test_copies_of_one_row_span_files(spark):
    """A third of the rows are the same pair."""
    rows = stage(
        spark.range(30_000).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("recipe_id"),
            F.lit(1).alias("ingredient_id"),
        ),
        "copies",
    )
    laid_out = layout.junction_by_ingredient(rows, scratch_path(spark, "copies"), files=12)
    per_file = laid_out.groupBy(F.input_file_name()).count()
    assert per_file.agg(F.max("count")).collect()[0][0] < 30_000 / 6
    assert laid_out.exceptAll(rows).count() == 0 and laid_out.count() == 30_000


def test_common_keys_collapse_before_the_orphan_join(spark, no_broadcast):
    child = stage(spark.range(1_000).select((F.col("id") % 5).alias("k")), "child")
    parent = stage(spark.range(1_000).select((F.col("id") % 3).alias("k")), "parent")
    lost = orphans(child, "k", parent)
    plan = plan_of(lost)
    assert sorted(map(tuple, lost.collect())) == [(3, 200), (4, 200)]
    assert plan.count("Exchange") == 2
    # Each side is combined on both sides of its one shuffle.
    assert plan.count("HashAggregate") == 4


def test_plain_layout_is_idempotent(spark):
    recipes = standins.ranked_recipes(spark, SF_DIR)
    path = scratch_path(spark, "l4")
    layout.plain(recipes, path)
    again = layout.plain(recipes, path)
    assert again.exceptAll(recipes).count() == 0 and again.count() == recipes.count()


def test_zorder_serves_both_columns(spark):
    recipes = standins.ranked_recipes(spark, "/root/testdata/sf0.1")
    copy = layout.recipes_zordered(recipes, scratch_path(spark, "zorder"), files=64)
    everything = recipes.count()
    for low in (f"recipe_id <= {everything // 16}", "minutes <= 3"):
        assert scan_rows(copy.filter(low)) < everything / 3
        assert copy.filter(low).exceptAll(recipes.filter(low)).count() == 0
    assert copy.exceptAll(recipes).count() == 0 and copy.count() == everything


def test_zorder_of_odd_columns(spark):
    rows = stage(
        spark.range(3_000).select(
            F.when(F.col("id") % 3 > 0, F.col("id")).alias("recipe_id"),
            F.lit(None).cast("int").alias("minutes"),
        ),
        "odd",
    )
    copy = layout.recipes_zordered(rows, scratch_path(spark, "odd"), files=4)
    assert copy.exceptAll(rows).count() == 0 and copy.count() == 3_000
    none = layout.recipes_zordered(stage(rows.limit(0), "none"), scratch_path(spark, "none"))
    assert none.count() == 0


def test_interleaved_bits(spark):
    pairs = [(0, 0), (1, 0), (0, 1), (5, 3), (2**31 - 1, 0), (2**31 - 1, 2**31 - 1), (12345, 54321)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [r[0] for r in df.select(layout.interleaved(F.col("a"), F.col("b"), 31)).collect()]
    for (a, b), z in zip(pairs, got):
        assert z == sum((a >> i & 1) << 2 * i + 1 | (b >> i & 1) << 2 * i for i in range(31))


def test_bloom_filters_skip_row_groups(spark):
    rows = stage(spark.range(40_000).select((F.col("id") * 7_919).alias("k"), "id"), "keys")
    copy = layout.with_bloom_filters(rows, scratch_path(spark, "bloom"), "k", 5_000, files=16)
    bare = layout.plain(rows, scratch_path(spark, "bare"), files=16)
    one = F.col("k") == 7_919 * 12_345
    assert scan_rows(bare.filter(one)) == 40_000
    assert scan_rows(copy.filter(one)) <= 2 * 40_000 / 16
    assert [r["id"] for r in copy.filter(one).collect()] == [12_345]
    assert copy.exceptAll(rows).count() == 0 and copy.count() == 40_000


def test_audit_scans_each_table_twice_whatever_its_rules(spark):
    """Once for its columns, once for all its keys; the keys of all tables go through one shuffle."""
    tables = registry._audited(spark, SF_DIR)
    plan = plan_of(audits.audit(tables))
    assert plan.count("FileScan parquet") == 2 * len(tables)
    assert len(re.findall(r"Exchange hashpartitioning\(rule#\d+, n0#", plan)) == 1


def test_keys_of_unlike_rows_are_told_apart(spark):
    rules = {
        "t": TableRules(T.StructType([]), keys=(("a", "b"), ("b",)), foreign_keys=(ForeignKey("a", "p", "a"),)),
        "p": TableRules(T.StructType([]), keys=()),
    }
    rows = [("1", "2"), ("1", None), ("1", None), ("12", ""), ("", "12"), (None, None), (None, None), ('"', ',"')]
    tables = {
        "t": spark.createDataFrame(rows, "a string, b string"),
        "p": spark.createDataFrame([("1",), ("1",), (None,), ("",)], "a string"),
    }
    found = {r["rule"]: r["violations"] for r in audits._key_rules(tables, rules).collect()}
    assert found == {"unique (a, b)": 2, "unique (b)": 1, "a -> p.a": 2}
    none = {name: df.limit(0) for name, df in tables.items()}
    assert {r["violations"] for r in audits._key_rules(none, rules).collect()} == {0}
