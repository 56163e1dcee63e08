"""Loading again: stable keys, landing by file, kept-up sums, and what a load refuses."""

import os
import random

import pytest
from compare import canonical
from pyspark.sql import functions as F

from larder.__main__ import main
from larder.operators import rejects
from larder.operators.conform import FOODCOM_RECIPE, conform
from larder.operators.postings import postings, recipes_with_all
from larder.operators.stable import extend_ids
from larder.operators.summaries import RatingSums
from larder.plans import ranking, search
from larder.plans.curate import RawPaths, curate
from larder.plans.refresh import NumberedRatings, refresh
from larder.schema import INGREDIENTS, RECIPES, all_strings
from larder.sources.incremental import CHANGED, GONE, NEW, SAME, Landing
from larder.sources.versioned import Versioned


def rows_of(df):
    return canonical([tuple(r) for r in df.collect()], df.columns)


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "name string")


ID = INGREDIENTS["ingredient_id"]


def test_ids_survive_loads(spark, tmp_path):
    path = str(tmp_path / "ids")
    rng = random.Random(1)
    before = {}
    for load in range(4):
        batch = [f"n{rng.randrange(60):02}" for _ in range(40)]
        table = extend_ids(names(spark, *batch), path, "name", ID)
        rows = [(r["name"], r["ingredient_id"]) for r in table.collect()]
        now = dict(rows)
        assert len(rows) == len(now) and sorted(now.values()) == list(range(1, len(now) + 1))
        assert before.items() <= now.items()
        fresh = sorted(set(batch) - set(before))
        assert [now[n] for n in fresh] == list(range(len(before) + 1, len(now) + 1))
        before = now
    again = extend_ids(names(spark, *before), path, "name", ID)
    assert dict((r["name"], r["ingredient_id"]) for r in again.collect()) == before


def test_ids_past_their_type_are_an_error(spark, tmp_path):
    path = str(tmp_path / "ids")
    full = spark.createDataFrame([(2**31 - 1, "last")], "ingredient_id int, name string")
    full.write.parquet(path)
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        extend_ids(names(spark, "one more"), path, "name", ID)


def test_versions(spark, tmp_path, monkeypatch):
    table = Versioned(spark, str(tmp_path / "t"), "k long")
    assert table.read().count() == 0
    table.write(spark.range(3).toDF("k"))
    for _ in range(3):
        # Made from its own last state.
        table.write(table.read().withColumn("k", F.col("k") + 1))
    assert rows_of(table.read()) == [(3,), (4,), (5,)]
    # A writer that dies before the log leaves the last state readable, and the next goes on.
    table.read().write.mode("overwrite").parquet(table._folder(table.version() + 1))
    assert rows_of(table.read()) == [(3,), (4,), (5,)]
    table.write(table.read().filter("k > 3"))
    assert rows_of(table.read()) == [(4,), (5,)]


def put(folder, name, text, when=None):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text(text)
    if when:
        os.utime(path, (when, when))
    return path


@pytest.mark.parametrize("split_above", [0, 1 << 30])
def test_only_changed_files_are_landed(spark, tmp_path, split_above):
    raw = tmp_path / "raw"
    landing = Landing(spark, str(tmp_path / "landing"))
    kept = put(raw, "a b+%.csv", 'id,p\n1,"x\ny"\n2,z\n', 1_000)
    put(raw, "b.csv", "p,id\nold,3\n", 1_000)
    put(raw, "c.csv", "id,p\n4,gone\n", 1_000)
    put(raw, "empty.csv", "")

    def states():
        found = landing.land(str(raw), split_above).collect()
        return {r["path"].rsplit("/", 1)[-1]: r["state"] for r in found}

    assert states() == {"a b+%.csv": NEW, "b.csv": NEW, "c.csv": NEW}
    assert rows_of(landing.read().select("id", "p")) == [
        ("1", "x\ny"), ("2", "z"), ("3", "old"), ("4", "gone"),
    ]
    # Were the unchanged file opened again, its new content would show.
    kept.write_text('id,p\n9,"9\n9"\n9,9\n')
    os.utime(kept, (1_000, 1_000))
    put(raw, "b.csv", "p,id,q\nnew,3,more\n", 2_000)
    (raw / "c.csv").unlink()
    put(raw, "d.csv", "id,p\n5,added\n", 2_000)
    assert states() == {"a b+%.csv": SAME, "b.csv": CHANGED, "c.csv": GONE, "d.csv": NEW}
    assert rows_of(landing.read().select("id", "p", "q")) == [
        ("1", "x\ny", None), ("2", "z", None), ("3", "new", "more"), ("5", "added", None),
    ]
    version = landing.manifest.version()
    assert set(states().values()) == {SAME} and landing.manifest.version() == version


def test_a_landing_that_died_is_made_whole(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    landing = Landing(spark, str(tmp_path / "landing"))
    put(raw, "a.csv", "id,p\n1,x\n")
    with monkeypatch.context() as broken:
        broken.setattr(Versioned, "write", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            landing.land(str(raw))
    assert landing.read().count() == 0
    landing.land(str(raw))
    assert rows_of(landing.read().select("id", "p")) == [("1", "x")]


def test_unread_partitions_are_pruned(spark, tmp_path):
    raw = tmp_path / "raw"
    landing = Landing(spark, str(tmp_path / "landing"))
    for i in range(6):
        put(raw, f"{i}.csv", f"id,p\n{i},x\n")
    landing.land(str(raw))
    one = landing.manifest.read().filter("path LIKE '%/3.csv'")
    found = landing.read(one)
    assert [r["id"] for r in found.collect()] == ["3"]
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()


RATINGS = "recipe_id long, rating int"


def test_sums_equal_all_ratings(spark, tmp_path):
    rng = random.Random(4)
    batches = {
        f"b{i}": [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice([None, 0, 3, 5])) for _ in range(50)]
        for i in range(5)
    }
    frames = {b: spark.createDataFrame(rows, RATINGS) for b, rows in batches.items()}
    sums = RatingSums(spark, str(tmp_path / "sums"))
    asked = []

    def ratings_of(wanted):
        found = sorted(r["batch"] for r in wanted.collect())
        asked.append(found)
        out = spark.createDataFrame([], RATINGS)
        for b in found:
            out = out.union(frames[b])
        return out

    def check(*current):
        rows = spark.createDataFrame([r for b in current for r in batches[b]], RATINGS)
        want = ranking.rating_stats(rows).withColumn("rating_sum", F.coalesce("rating_sum", F.lit(0)))
        assert rows_of(sums.read()) == rows_of(want)

    sums.merge("b0", frames["b0"])
    sums.merge("b1", frames["b1"])
    sums.merge("b0", frames["b0"])
    check("b0", "b1")
    for current in (["b0", "b1", "b2", "b3"], ["b1", "b3", "b4"], ["b1", "b3", "b4"]):
        sums.sync(spark.createDataFrame([(b,) for b in current], "batch string"), ratings_of)
        check(*current)
    # Only what came and what went was read.
    assert asked == [["b2", "b3"], ["b4"], ["b0", "b2"]]
    recipes = spark.createDataFrame([(i, f"t{i}") for i in (1, 2, 3)], "recipe_id long, title string")
    rows = spark.createDataFrame([r for b in current for r in batches[b]], RATINGS)
    best = ranking.top_rated_of_sums(recipes, sums.read(), 5)
    assert best.collect() == ranking.top_rated_agg_first(recipes, rows, 5).collect()


HEADS = {
    "recipes": "name,id,minutes,submitted,n_steps,ingredients,n_ingredients",
    "second": ",title,NER",
    "ratings": "user_id,recipe_id,date,rating",
}


def lists(*items):
    return '"[' + ", ".join(f"'{i}'" for i in items) + ']"'


@pytest.fixture
def raw(tmp_path):
    for kind, rows in {
        "recipes": [f"soup,1,25,2020-01-01,1,{lists('Garlic', 'salt')},2", f"stew,2,9,,1,{lists('pepper')},1"],
        "second": [f"0,pie,{lists('apple', 'garlic')}"],
        "ratings": ["7,1,2020-01-01,5", "8,1,2020-01-02,", "9,3,2020-01-03,4", "bad,1,2020-01-03,4"],
    }.items():
        put(tmp_path / kind, "1.csv", "\n".join([HEADS[kind], *rows]) + "\n", 1_000)
    return RawPaths(*(str(tmp_path / k) for k in ("recipes", "ratings", "second")))


def contents(done):
    """What does not depend on how ids were given out."""
    named = done.recipe_ingredients.join(done.ingredients, "ingredient_id")
    return (
        rows_of(done.recipes),
        rows_of(named.select("recipe_id", "ingredient_name_norm")),
        rows_of(done.interactions.drop("interaction_id")),
    )


def second_load(tmp_path):
    """New files, a changed one, one recipe that ratings have waited for, and names in front of others."""
    put(tmp_path / "recipes", "2.csv", f"{HEADS['recipes']}\ncake,3,40,2021-01-01,2,{lists('almond', 'salt')},2\n", 2_000)
    put(tmp_path / "second", "1.csv", f"{HEADS['second']}\n0,pie,{lists('apple', 'zest')}\n", 2_000)
    put(tmp_path / "ratings", "2.csv", f"{HEADS['ratings']}\n7,2,2021-01-01,3\n7,2,2021-01-01,3\n", 2_000)


def test_refresh(spark, tmp_path, raw):
    out = str(tmp_path / "out")
    first = refresh(spark, raw, out)
    assert contents(first.tables) == contents(curate(spark, raw, str(tmp_path / "once")))
    ids = {r["ingredient_name_norm"]: r["ingredient_id"] for r in first.tables.ingredients.collect()}
    ratings = {r["interaction_id"]: tuple(r) for r in first.tables.interactions.collect()}
    assert ids == {"apple": 1, "garlic": 2, "pepper": 3, "salt": 4}
    second_load(tmp_path)
    again = refresh(spark, raw, out)
    assert contents(again.tables) == contents(curate(spark, raw, str(tmp_path / "twice")))
    now = {r["ingredient_name_norm"]: r["ingredient_id"] for r in again.tables.ingredients.collect()}
    assert now == ids | {"almond": 5, "zest": 6}
    later = {r["interaction_id"]: tuple(r) for r in again.tables.interactions.collect()}
    assert ratings.items() <= later.items() and len(later) == 5
    # The rating that waited for its recipe has the id of its own load.
    assert [i for i, r in later.items() if r[2] == 3][0] <= 3 < min(set(later) - set(range(4)))
    args = again.tables.recipes, again.tables.interactions
    for n in (1, 2):
        assert again.top_rated(n).collect() == ranking.top_rated(*args, n).collect()
    # The changed file of ratings gives its ids up and its sums back.
    put(tmp_path / "ratings", "1.csv", f"{HEADS['ratings']}\n7,1,2020-01-01,1\n", 3_000)
    last = refresh(spark, raw, out)
    args = last.tables.recipes, last.tables.interactions
    assert last.top_rated(1).collect() == ranking.top_rated(*args, 1).collect()
    assert len({r["interaction_id"] for r in last.tables.interactions.collect()} - set(later)) == 1
    assert last.tables.audit().filter("violations > 0").count() == 0


@pytest.mark.parametrize("where, step", [(NumberedRatings, "number"), (RatingSums, "sync")])
def test_a_refresh_that_died_is_made_whole(spark, tmp_path, raw, monkeypatch, where, step):
    out = str(tmp_path / "out")
    refresh(spark, raw, out)
    second_load(tmp_path)
    with monkeypatch.context() as broken:
        broken.setattr(where, step, lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh(spark, raw, out)
    done = refresh(spark, raw, out)
    assert contents(done.tables) == contents(curate(spark, raw, str(tmp_path / "once")))
    args = done.tables.recipes, done.tables.interactions
    assert done.top_rated(1).collect() == ranking.top_rated(*args, 1).collect()


def test_refresh_from_the_shell(spark, tmp_path, raw, capsys):
    out = ["--out", str(tmp_path / "out")]
    folders = ["--recipes", raw.foodcom_recipes, "--ratings", raw.foodcom_interactions, "--more-recipes", raw.recipenlg]
    for _ in range(2):
        main([*out, "refresh", *folders])
        assert "interactions|2" in capsys.readouterr().out.replace(" ", "")
        second = ["search", "garlic", "--limit", "3"]
        main([*out, *second])
        assert "soup" in capsys.readouterr().out


# Postings


@pytest.mark.parametrize("seed", range(3))
def test_bitmaps_against_sets(spark, seed):
    rng = random.Random(seed)
    ids = [rng.choice([-70_000, -1, 0, 32_767, 32_768, 2**40]) + rng.randrange(40) for _ in range(60)]
    pairs = [(rng.choice(ids), rng.choice([1, 1, 1, 2, 3, 4])) for _ in range(400)] + [(None, 1), (5, None)]
    table = postings(spark.createDataFrame(pairs, "recipe_id long, ingredient_id int"))
    for terms in ([[1]], [[1], [2]], [[1], [2, 3], [4]], [[2, 3], [3, 4]], [[1], []], [[9], [1]]):
        have = [{r for r, i in pairs if i in of and r is not None} for of in terms]
        got = sorted(r["recipe_id"] for r in recipes_with_all(table, terms).collect())
        assert got == sorted(set.intersection(*have))


def test_bitmaps_are_shuffled_by_block(spark):
    junction = spark.range(200_000).select(
        (F.col("id") % 100_000).alias("recipe_id"), (F.col("id") % 2).cast("int").alias("ingredient_id")
    )
    table = postings(junction)
    assert table.count() == 8
    plan = recipes_with_all(table, [[0], [1]])
    assert plan.count() == 0
    text = plan._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert moved and not any("hashpartitioning(recipe_id" in line for line in moved)


def test_many_ingredients_of_a_name(spark):
    """More ids to a name than a search makes literals of: rows are joined, none are refused."""
    many = search.MAX_LITERAL_IDS + 100
    ids = spark.range(2 * many)
    ingredients = ids.select(
        F.col("id").cast("int").alias("ingredient_id"),
        F.expr("if(id % 2 = 0, 'salt', 'rice')").alias("ingredient_name_norm"),
    ).union(spark.createDataFrame([(None, "salt"), (0, "salt"), (7, None)], "a int, b string"))
    recipes = spark.range(-50, 3 * many).select(
        F.col("id").alias("recipe_id"), F.concat(F.lit("r"), F.col("id").cast("string")).alias("title")
    )
    # Every recipe has one ingredient; those divisible by 3 have its neighbour, of the other name, too.
    pairs = recipes.select("recipe_id", F.expr(f"cast(pmod(recipe_id, {2 * many}) AS int)").alias("i"))
    pairs = pairs.union(pairs.filter("recipe_id % 3 = 0").selectExpr("recipe_id", "i ^ 1"))
    table = postings(pairs.toDF("recipe_id", "ingredient_id"))
    found = search.multi_ingredient_bitmap(recipes, ingredients, table, ["salt", "Rice"], limit=None)
    want = [(r, f"r{r}", "salt, rice") for r in range(-48, 3 * many, 3)]
    assert sorted(map(tuple, found.collect())) == want


def test_bitmaps_are_as_large_as_what_they_hold(spark):
    """One recipe in a block takes one word of it, and not a bit for every id."""
    sparse = spark.range(50).select(F.shiftleft("id", 15).alias("recipe_id"), F.lit(1).alias("ingredient_id"))
    dense = spark.range(1 << 15).select(F.col("id").alias("recipe_id"), F.lit(2).alias("ingredient_id"))
    sizes = postings(sparse.union(dense).union(dense)).select("ingredient_id", F.size("recipes")).collect()
    assert sorted(map(tuple, sizes)) == [(1, 1)] * 50 + [(2, 512)]


# Rejects

REFUSED = [
    ("1", "soup", "5", "2020-01-01"),
    ("2", None, "99999999999", "2020-02-30"),
    ("x", "stew", "many", "soon"),
    (None, "pie", "", " "),
    ("99999999999999999999", "jam", " 7 ", None),
    ("3", "tea", "-", "2020-01-02"),
]


def test_rejects_account_for_every_row(spark):
    raw = spark.createDataFrame(REFUSED, all_strings("id", "name", "minutes", "submitted"))
    columns = {f: c for f, c in FOODCOM_RECIPE.items() if c in raw.columns}
    found = rejects.checked(raw, RECIPES, columns, carry=["name"], source="foodcom")
    want = conform(raw, RECIPES, columns, source="foodcom")
    assert rows_of(rejects.rows_kept(found)) == rows_of(want)
    refused = [
        ("minutes", "99999999999", "out of range"), ("submitted", "2020-02-30", "malformed"),
        ("recipe_id", "x", "malformed"), ("minutes", "many", "malformed"),
        ("submitted", "soon", "malformed"), ("recipe_id", None, "no id"),
        ("recipe_id", "99999999999999999999", "out of range"), ("minutes", "-", "malformed"),
    ]
    got = rejects.rejected_values(found).select("column_name", "raw_text", "reason").collect()
    assert sorted(map(tuple, got), key=str) == sorted(refused, key=str)
    assert tuple(rejects.loss_summary(found).first()) == (6, 3, 3, 3)
    assert tuple(rejects.loss_summary(found.limit(0)).first()) == (0, 0, 0, 0)
    # One scan gives both.
    assert found._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
