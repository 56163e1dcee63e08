"""Best-of-five wall-clock of the headline queries; prints one JSON line.

The four queries run as they are and over the layouts made for them (built untimed), after
untimed passes; the building blocks of the curation job are best of three after a warm-up, their
whole result computed and discarded. Input tables are rewritten in several files first, as one file
with one row group is read by one task. ``empty_job`` is the time of a job without work: what a query
of two or three jobs cannot go below.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from larder import registry, standins
from larder.operators import layout
from larder.plans import ranking, search
from larder.workspace import clear_scratch, scratch_path

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
TRIALS = 5

PLAIN = {
    "q1_ingredient_search": registry.ingredient_search,
    "q1u_ingredient_search_all": registry.ingredient_search_all,
    "q2_top_rated": registry.top_rated,
    "q2_top_rated_agg_first": registry.top_rated_agg_first,
    "q3_quick_recipes": registry.quick_recipes,
    "q4_multi_ingredient": registry.multi_ingredient,
    "q4_multi_ingredient_k": registry.multi_ingredient_k,
}
ETL = [
    "csv_roundtrip",
    "csv_split_landing",
    "conform_union",
    "normalize_text",
    "parse_explode",
    "ingredient_dim",
    "recipe_ingredients",
    "dedup_by_key",
    "row_ids",
    "interactions_fk",
    "fk_orphans",
    "schema_audit",
    "curated_tables",
]


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("larder-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
    )
    warehouse = tempfile.mkdtemp(prefix="larder-bench-")
    spark = builder.config("spark.sql.warehouse.dir", warehouse).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 4)


def best(run) -> float:
    return min(timed(lambda: run().collect()) for _ in range(TRIALS))


def discard(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def spread_input(spark: SparkSession) -> str:
    """The tables in as many files as there are cores."""
    folder = scratch_path(spark, "input")
    for name in standins.SCHEMAS:
        rows = standins.table(spark, SF_DIR, name).repartition(int(CPUS))
        rows.write.parquet(f"{folder}/{name}.parquet")
    return folder


def laid_out(spark: SparkSession, sf_dir: str) -> dict:
    """The four queries over their layouts, as callables."""
    recipes, ingredients, junction = standins.search_tables(spark, sf_dir)
    by_ingredient = layout.junction_by_ingredient(junction, scratch_path(spark, "l1"))
    by_minutes = layout.recipes_by_minutes(
        standins.ranked_recipes(spark, sf_dir), scratch_path(spark, "l3")
    )
    ratings = registry.ratings_layout(spark, sf_dir, int(CPUS))
    tables = (recipes, ingredients, by_ingredient)
    terms = [registry.TERM, registry.SECOND_TERM]
    return {
        "q1_ingredient_search_laid_out": lambda: search.ingredient_search(
            *tables, registry.TERM
        ),
        "q2_top_rated_laid_out": lambda: ranking.top_rated_laid_out(ratings, ratings.recipes),
        "q3_quick_recipes_laid_out": lambda: ranking.quick_recipes(by_minutes),
        "q4_multi_ingredient_laid_out": lambda: search.multi_ingredient(*tables, terms),
    }


def main() -> None:
    spark = session()
    sf_dir = spread_input(spark)
    headline_runs = {n: partial(query, spark, sf_dir) for n, query in PLAIN.items()}
    headline_runs |= laid_out(spark, sf_dir)
    for run in 2 * list(headline_runs.values()):  # warm-up
        run().collect()
    timings = {name: best(run) for name, run in headline_runs.items()}
    headline = sum(timings.values())
    timings["empty_job"] = best(lambda: spark.range(1, numPartitions=1).selectExpr("rand() AS x"))
    for name in ETL:
        runs = [timed(lambda: discard(registry.QUERIES[name](spark, sf_dir))) for _ in range(4)]
        timings[name] = min(runs[1:])
    clear_scratch(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_best_of_5_total",
                "value": round(headline, 4),
                "unit": "sec",
                "queries": timings,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
