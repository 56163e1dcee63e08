"""Shell and ``spark-submit`` entry: ``python -m larder --help``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from larder.plans import ranking, search
from larder.plans.curate import RawPaths, curate, export_csv, open_curated
from larder.plans.lay_out import lay_out
from larder.plans.refresh import refresh
from larder.steps import watch


def parser() -> argparse.ArgumentParser:
    main_parser = argparse.ArgumentParser(prog="larder", description="Curate and query recipes.")
    main_parser.add_argument("--out", default="./out", help="folder of the curated tables")
    commands = main_parser.add_subparsers(dest="command", required=True)

    job = commands.add_parser("curate", help="raw CSV to curated tables")
    job.add_argument("--recipes", required=True, help="first source's recipes")
    job.add_argument("--ratings", required=True, help="first source's interactions")
    job.add_argument("--more-recipes", required=True, help="second source")
    job.add_argument("--csv", action="store_true", help="also write the tables as CSV")
    job.add_argument("--single-file", action="store_true", help="each CSV as one file")
    job.add_argument("--buckets", type=int, help="also write the query layouts, so many buckets")

    again = commands.add_parser("refresh", help="load what has changed; ids and sums are kept up")
    again.add_argument("--recipes", required=True, help="folder of the first source's recipes")
    again.add_argument("--ratings", required=True, help="folder of the first source's interactions")
    again.add_argument("--more-recipes", required=True, help="folder of the second source")

    limits = argparse.ArgumentParser(add_help=False)
    limits.add_argument("--limit", type=int, default=search.DISPLAY_LIMIT)
    limits.add_argument("--explain", action="store_true", help="also show the plan of every step")
    find = commands.add_parser("search", parents=[limits], help="recipes with all of the terms")
    find.add_argument("terms", nargs="+")
    best = commands.add_parser("top-rated", parents=[limits], help="best average ratings")
    best.add_argument("--min-ratings", type=int, default=ranking.MIN_RATINGS)
    quick = commands.add_parser("quick", parents=[limits], help="quickest recipes")
    quick.add_argument("--under", type=int, default=ranking.QUICK_MINUTES, help="minutes")
    return main_parser


def run_curate(spark: SparkSession, args: argparse.Namespace) -> None:
    done = curate(spark, RawPaths(args.recipes, args.ratings, args.more_recipes), args.out)
    if args.csv:
        export_csv(done, f"{args.out}/csv", args.single_file)
    if args.buckets:
        lay_out(done, args.out, "larder", args.buckets)
    done.row_counts().show(truncate=False)
    done.audit().filter("violations > 0").show(truncate=False)


def query(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    tables = open_curated(spark, args.out)
    if args.command == "top-rated":
        return ranking.top_rated(tables.recipes, tables.interactions, args.min_ratings, args.limit)
    if args.command == "quick":
        return ranking.quick_recipes(tables.recipes, args.under, args.limit)
    searched = (tables.recipes, tables.ingredients, tables.recipe_ingredients)
    if len(args.terms) == 1:
        return search.ingredient_search(*searched, args.terms[0], args.limit)
    return search.multi_ingredient(*searched, args.terms, args.limit)


def show_plan(name: str, df: DataFrame) -> None:
    print(f"== Step: {name} ==")
    df.explain("formatted")


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("larder").getOrCreate()
    if args.command == "curate":
        run_curate(spark, args)
        return
    if args.command == "refresh":
        done = refresh(spark, RawPaths(args.recipes, args.ratings, args.more_recipes), args.out)
        done.tables.row_counts().show(truncate=False)
        done.tables.audit().filter("violations > 0").show(truncate=False)
        return
    if args.explain:
        with watch(show_plan):
            found = query(spark, args)
        show_plan("result", found)
    else:
        found = query(spark, args)
    found.show(args.limit, truncate=False)


if __name__ == "__main__":
    main()
