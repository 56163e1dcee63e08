"""The whole job on a small raw fixture with every odd case, against results worked out by hand."""

import csv
import datetime
import re

import pytest

from larder.__main__ import main
from larder.operators.audits import audit
from larder.plans.curate import RawPaths, curate, export_csv, open_curated
from larder.plans.lay_out import lay_out, open_layouts
from larder.plans.ranking import quick_recipes, top_rated, top_rated_agg_first
from larder.plans.search import ingredient_search, multi_ingredient, multi_ingredient_k
from larder.schema import RULES
from larder.sizing import scan_bytes, shuffle_partitions
from larder.sources.tables import in_schema, load_csv, replace_catalog_table

LONG = "z" * 5_000

FOODCOM = [
    # name, id, minutes, contributor_id, submitted, tags, n_steps, description, ingredients, n_ingr.
    ["garlic soup", "1", "25", "9", "2005-09-16", "[]", "3", 'He said ""hi""', "['Garlic', 'Salt', 'salt ']", "3"],
    ["pepper stew", "2", "90", "9", "bad", "[]", "x", "line1\nline2", "['Jalapeño Peppers', \"Half & Half\", '2% milk', '!!!', '']", "5"],
    ["", "3", "5", "9", "2005-01-02", "[]", "1", "no title", r"['confectioners\' sugar', 'garlic']", "2"],
    ["bad id", "bad", "1", "9", "2005-01-02", "[]", "1", "", "['lost']", "1"],
    ["twice b", "4", "10", "9", "2005-01-02", "[]", "1", "", "['garlic']", "1"],
    ["twice a", "4", "11", "9", "2005-01-02", "[]", "1", "", "['chicken']", "1"],
    ["no list", "5", "", "9", "", "[]", "1", "", "", "0"],
    ["empty list", "6", "29", "9", "2005-01-02", "[]", "1", "", "[]", "0"],
    ["unclosed", "7", "30", "9", "2005-01-02", "[]", "1", "", "['garlic', 'chick", "2"],
    ["long", "8", "4", "9", "2005-01-02", "[]", "1", "", f"['{LONG}']", "1"],
]
RECIPENLG = [
    ["0", "Garlic Chicken, \"best\"", "[]", "link", '["garlic", "chicken"]'],
    ["1", "", "[]", "link", '["orphan item"]'],
    ["x", "bad row", "[]", "link", '["lost"]'],
    ["9223372036854775807", "id too big", "[]", "link", '["lost"]'],
    ["1000", "Chicken", "[]", "link", '["CHICKEN"]'],
]
INTERACTIONS = (
    [["10", "1", "2020-01-01", str(r), "yum"] for r in [5] * 19 + [0]]
    + [["11", "4", "2020-01-02", "4", ""]] * 10
    + [["12", "4", "2020-01-02", "", ""]] * 10
    + [["13", "6", "2020-01-02", "300", ""]] * 20
    + [["14", "7", "bad", "4", "multi\nline"]] * 20
    + [["15", "5", "2020-01-02", "5", ""]] * 19
    + [["16", "999", "2020-01-02", "5", "unknown recipe"]]
    + [["", "1", "2020-01-02", "5", "no user"], ["17", "", "2020-01-02", "5", "no recipe"]]
)


def _write(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f, lineterminator="\n")
        writer.writerow(header)
        writer.writerows(rows)
    return str(path)


@pytest.fixture(scope="module")
def out(tmp_path_factory):
    return tmp_path_factory.mktemp("curated")


@pytest.fixture(scope="module")
def done(spark, out):
    raw = RawPaths(
        foodcom_recipes=_write(
            out / "recipes.csv",
            "name id minutes contributor_id submitted tags n_steps description ingredients "
            "n_ingredients".split(),
            FOODCOM,
        ),
        foodcom_interactions=_write(
            out / "interactions.csv",
            "user_id recipe_id date rating review".split(),
            INTERACTIONS,
        ),
        recipenlg=_write(
            out / "second.csv", ["", "title", "directions", "link", "NER"], RECIPENLG
        ),
    )
    return curate(spark, raw, str(out))


def by_key(df, key):
    return {r[key]: r for r in df.collect()}


def test_recipes(done):
    rows = by_key(done.recipes, "recipe_id")
    assert set(rows) == {1, 2, 3, 4, 5, 6, 7, 8, 10_000_000, 10_001_000}
    assert tuple(rows[1]) == (1, "garlic soup", 25, 3, 3, datetime.date(2005, 9, 16), "foodcom")
    assert rows[2].submitted is None and rows[2].n_steps is None and rows[2].minutes == 90
    assert rows[3].title is None
    assert rows[4].title == "twice a"
    assert rows[5].minutes is None and rows[5].submitted is None
    nlg = rows[10_000_000]
    assert nlg.title == 'Garlic Chicken, "best"' and nlg.source == "recipenlg"
    assert nlg.minutes is nlg.n_steps is nlg.n_ingredients is nlg.submitted is None


def test_ingredients(done):
    names = sorted(
        ["garlic", "salt", "jalape o peppers", "half half", "2 milk", "confectioners sugar",
         "chicken", LONG, "orphan item"]
    )
    rows = done.ingredients.orderBy("ingredient_id").collect()
    assert [r.ingredient_id for r in rows] == list(range(1, len(names) + 1))
    assert [r.ingredient_name_norm for r in rows] == names
    assert [r.ingredient_name_raw for r in rows] == names


def test_junction(done):
    named = done.recipe_ingredients.join(done.ingredients, "ingredient_id")
    pairs = sorted((r.recipe_id, r.ingredient_name_norm) for r in named.collect())
    assert pairs == sorted(
        [(1, "garlic"), (1, "salt"), (2, "jalape o peppers"), (2, "half half"), (2, "2 milk"),
         (3, "confectioners sugar"), (3, "garlic"), (4, "garlic"), (4, "chicken"), (7, "garlic"),
         (8, LONG), (10_000_000, "garlic"), (10_000_000, "chicken"), (10_000_001, "orphan item"),
         (10_001_000, "chicken")]
    )


def test_interactions(done):
    rows = done.interactions.orderBy("interaction_id").collect()
    assert [r.interaction_id for r in rows] == list(range(1, 100))
    assert {r.recipe_id for r in rows} == {1, 4, 5, 6, 7}
    assert all(r.rating is None for r in rows if r.recipe_id == 6)
    assert all(r.interaction_date is None for r in rows if r.recipe_id == 7)


def test_schemas(done):
    for name, df in done.by_name().items():
        declared = RULES[name].schema
        assert [(f.name, f.dataType) for f in df.schema] == [
            (f.name, f.dataType) for f in declared
        ]


def test_counts(done):
    assert {r.tbl: r.n for r in done.row_counts().collect()} == {
        "recipes": 10, "ingredients": 9, "recipe_ingredients": 15, "interactions": 99,
    }


def test_audit_reports_exactly_the_bad_rows(done):
    found = {(r.tbl, r.rule): r.violations for r in done.audit().collect()}
    bad = {k: v for k, v in found.items() if v}
    assert bad == {
        ("recipes", "not null title"): 1,
        ("ingredients", "length ingredient_name_raw <= 255"): 1,
        ("ingredients", "length ingredient_name_norm <= 255"): 1,
        ("recipe_ingredients", "recipe_id -> recipes.recipe_id"): 1,
    }
    assert len(found) == 23


def test_audit_finds_nothing_on_clean_tables(spark, done):
    tables = done.by_name()
    tables["recipes"] = tables["recipes"].fillna("untitled", ["title"])
    tables["ingredients"] = tables["ingredients"].filter("length(ingredient_name_norm) < 256")
    tables["recipe_ingredients"] = tables["recipe_ingredients"].join(
        tables["recipes"], "recipe_id", "left_semi"
    ).join(tables["ingredients"], "ingredient_id", "left_semi")
    assert audit(tables).filter("violations > 0").count() == 0


@pytest.fixture(params=["10MB", "-1"])
def broadcast_limit(request, conf):
    """Small tables joined directly, and the way big ones take."""
    conf("spark.sql.autoBroadcastJoinThreshold", request.param)


@pytest.mark.parametrize("query", [top_rated, top_rated_agg_first])
def test_top_rated(done, query, broadcast_limit):
    rows = [tuple(r) for r in query(done.recipes, done.interactions).collect()]
    # Recipes 4 and 7 tie at 4.0 and go by id; NULL ratings count, and all NULL comes last.
    assert rows == [
        ("garlic soup", 4.75, 20),
        ("twice a", 4.0, 20),
        ("unclosed", 4.0, 20),
        ("empty list", None, 20),
    ]
    assert query(done.recipes, done.interactions, 19).count() == 5
    assert query(done.recipes, done.interactions, 19, limit=1).collect()[0].title == "no list"


def test_top_rated_counts_repeated_recipes_like_the_sql(spark):
    recipes = spark.createDataFrame(
        [(1, "a"), (1, "a"), (1, "b"), (2, "c")], "recipe_id long, title string"
    )
    ratings = spark.createDataFrame(
        [(1, 5), (1, None), (1, 4), (2, 3)], "recipe_id long, rating int"
    )
    recipes.createOrReplaceTempView("r")
    ratings.createOrReplaceTempView("x")
    want = spark.sql(
        "SELECT title, avg(rating), count(*) FROM x JOIN r USING (recipe_id) "
        "GROUP BY recipe_id, title HAVING count(*) >= 2 ORDER BY 2 DESC, recipe_id, title"
    ).collect()
    assert [tuple(r) for r in top_rated(recipes, ratings, 2).collect()] == [
        tuple(r) for r in want
    ] == [("a", 4.5, 6), ("b", 4.5, 3)]


def test_quick_recipes(done):
    rows = [tuple(r) for r in quick_recipes(done.recipes).collect()]
    assert rows == [
        (8, "long", 4), (3, None, 5), (4, "twice a", 11), (1, "garlic soup", 25),
        (6, "empty list", 29),
    ]
    assert [r.recipe_id for r in quick_recipes(done.recipes, 30, 2).collect()] == [8, 3]
    assert quick_recipes(done.recipes, under_minutes=1).collect() == []


def search_args(done):
    return done.recipes, done.ingredients, done.recipe_ingredients


def test_ingredient_search(done, broadcast_limit):
    rows = [tuple(r) for r in ingredient_search(*search_args(done), " GARLIC! ").collect()]
    assert [r[0] for r in rows] == [1, 3, 4, 7, 10_000_000]
    assert {r[2] for r in rows} == {"garlic"}
    two = ingredient_search(*search_args(done), "garlic", limit=2).collect()
    assert [r.recipe_id for r in two] == [1, 3]
    assert ingredient_search(*search_args(done), "half & half").count() == 1
    # The recipe of this ingredient was dropped for want of a title.
    assert ingredient_search(*search_args(done), "orphan item", limit=None).count() == 0
    assert ingredient_search(*search_args(done), "unheard of").count() == 0


@pytest.mark.parametrize("query", [multi_ingredient, multi_ingredient_k])
def test_multi_ingredient(done, query, broadcast_limit):
    both = query(*search_args(done), ["Garlic", "chicken"], limit=20).collect()
    assert [(r.recipe_id, r.matched_ingredients) for r in both] == [
        (4, "garlic, chicken"), (10_000_000, "garlic, chicken"),
    ]
    same = query(*search_args(done), ["garlic", "garlic"], limit=None).collect()
    assert sorted(r.recipe_id for r in same) == [1, 3, 4, 7, 10_000_000]
    three = query(*search_args(done), ["2% milk", "half & half", "jalapeño peppers"])
    assert [r.recipe_id for r in three.collect()] == [2]
    assert query(*search_args(done), ["garlic", "unheard of"]).count() == 0


@pytest.mark.parametrize("query", [multi_ingredient, multi_ingredient_k])
def test_search_without_literal_ids(done, query, monkeypatch):
    monkeypatch.setattr("larder.plans.search.MAX_LITERAL_IDS", 0)
    both = query(*search_args(done), ["garlic", "chicken"], limit=20).collect()
    assert [r.recipe_id for r in both] == [4, 10_000_000]


def test_layouts_change_no_answer(spark, done, out, broadcast_limit):
    args = search_args(done)
    for _ in range(2):
        tables = lay_out(done, str(out), "larder_golden", buckets=4)
        assert tables.top_rated(19).collect() == top_rated(
            done.recipes, done.interactions, 19
        ).collect()
        assert tables.quick_recipes().collect() == quick_recipes(done.recipes).collect()
        for term in ("garlic", "chicken", "unheard of"):
            want = ingredient_search(*args, term).collect()
            assert tables.ingredient_search(term).collect() == want
        both = multi_ingredient(*args, ["garlic", "chicken"]).collect()
        assert tables.multi_ingredient(["garlic", "chicken"]).collect() == both
    spark.sql("DROP TABLE larder_golden_interactions")
    spark.sql("DROP TABLE larder_golden_recipes")


def test_csv_export_loads_back(spark, done, out):
    export_csv(done, str(out / "export"), single_file=True)
    for name, df in done.by_name().items():
        back = load_csv(spark, str(out / "export" / name), RULES[name].schema)
        assert back.columns == RULES[name].schema.names
        assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_catalog_table(spark, done):
    declared = RULES["recipes"].schema
    saved = replace_catalog_table(done.recipes, "larder_test_recipes", declared)
    saved = replace_catalog_table(done.recipes, "larder_test_recipes", declared)
    assert saved.count() == 10 and saved.columns == declared.names
    spark.sql("DROP TABLE larder_test_recipes")


def test_rerun_replaces(spark, done, out):
    raw = RawPaths(
        str(out / "recipes.csv"),
        str(out / "interactions.csv"),
        str(out / "second.csv"),
    )
    before = sorted(map(tuple, done.ingredients.collect()))
    again = curate(spark, raw, str(out))
    assert sorted(map(tuple, again.ingredients.collect())) == before
    assert again.interactions.count() == 99


def test_columns_go_by_name_not_position(spark):
    shuffled = spark.createDataFrame(
        [(7, 3, 1)], "recipe_id long, user_id long, interaction_id long"
    ).selectExpr("*", "cast(4 as tinyint) rating", "cast(null as date) interaction_date")
    row = in_schema(shuffled, RULES["interactions"].schema).collect()[0]
    assert tuple(row) == (1, 3, 7, 4, None)


def test_command_line(spark, out, done, tmp_path, capsys):
    width = spark.conf.get("spark.sql.shuffle.partitions")
    main(
        [
            "--out", str(tmp_path), "curate",
            "--recipes", str(out / "recipes.csv"),
            "--ratings", str(out / "interactions.csv"),
            "--more-recipes", str(out / "second.csv"),
            "--csv", "--single-file", "--buckets", "2",
        ]
    )
    printed = capsys.readouterr().out
    assert "recipe_ingredients|15" in printed.replace(" ", "")
    assert len(list((tmp_path / "csv/recipes").glob("part-*.csv"))) == 1
    assert (tmp_path / "layouts/junction").exists()
    assert spark.conf.get("spark.sql.shuffle.partitions") == width
    for command in (["search", "salt"], ["search", "salt", "garlic"], ["top-rated"], ["quick"]):
        main(["--out", str(tmp_path), *command, "--limit", "3", "--explain"])
        printed = capsys.readouterr().out
        assert "Physical Plan" in printed and "title" in printed
        # Every step is shown: what is looked up while a search is built reads three tables.
        steps = re.findall(r"== Step: (.*) ==", printed)
        assert steps[-1] == "result"
        if command[0] == "search":
            assert steps[:2] == ["ids of names", "leading candidates"]
            for column in ("ingredient_name_norm", "ingredient_id", "recipe_id"):
                assert re.search(rf"PushedFilters: \[[^\n]*\b{column}\b", printed), column
    main(["--out", str(tmp_path), "search", "salt"])
    assert "== Step" not in capsys.readouterr().out
    # A session that knows nothing of the run: only the files are there.
    fast = lay_out_of(spark, tmp_path).top_rated(min_ratings=1).collect()
    spark.sql("DROP TABLE larder_interactions")
    spark.sql("DROP TABLE larder_recipes")
    other = spark.newSession()
    assert lay_out_of(other, tmp_path).top_rated(min_ratings=1).collect() == fast
    opened = open_curated(other, str(tmp_path))
    assert opened.recipes.schema == done.recipes.schema
    assert opened.recipe_ingredients.count() == 15
    assert "Exchange hashpartitioning" not in plan_of(
        lay_out_of(other, tmp_path).ratings.bucketed.groupBy("recipe_id").count()
    )
    spark.sql("DROP TABLE larder_interactions")
    spark.sql("DROP TABLE larder_recipes")


def lay_out_of(spark, path):
    return open_layouts(spark, str(path), "larder", 2)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_widths_grow_with_the_data():
    assert [shuffle_partitions(n, 200) for n in (10, 10**12, 10**14)] == [200, 3_726, 372_530]
    assert [scan_bytes(n) // 2**20 for n in (10, 10**12, 10**14)] == [128, 128, 953]
