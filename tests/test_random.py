"""The whole job and the four queries on random raw files, against brute force in Python."""

import csv
import random
import re
from collections import Counter, defaultdict

import pytest

from larder.plans.curate import RawPaths, curate
from larder.plans.lay_out import lay_out
from larder.plans.ranking import quick_recipes, top_rated, top_rated_agg_first
from larder.plans.search import ingredient_search, multi_ingredient, multi_ingredient_k
from larder.schema import RECIPENLG_ID_OFFSET

NAMES = ["Garlic", "garlic ", "salt", "Sea-Salt", "olive oil", "Olive  Oil!", "egg", "½ cup", "!!"]


def norm(s):
    return re.sub("[^a-z0-9]+", " ", s.lower()).strip(" ")


def literal(rng, names):
    quote = rng.choice("'\"")
    return "[" + ", ".join(f"{quote}{n}{quote}" for n in names) + "]"


def to_int(s, bits):
    try:
        n = int(s)
    except ValueError:
        return None
    return n if -(2 ** (bits - 1)) <= n < 2 ** (bits - 1) else None


def write(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator="\n").writerows([header, *rows])
    return str(path)


def random_raw(rng):
    def names():
        return rng.choices(NAMES, k=rng.randrange(0, 9))

    first = [
        [
            rng.choice([f'title "{i}"', f"two\nlines {i}", ""]),
            rng.choice([str(rng.randrange(60)), "bad", ""]),
            rng.choice([str(rng.randrange(100)), "", "x", "99999999999"]),
            literal(rng, names()),
        ]
        for i in range(150)
    ]
    second = [
        [rng.choice([str(i), "bad"]), rng.choice([f"second {i}", ""]), literal(rng, names())]
        for i in range(60)
    ]
    ratings = [
        [
            rng.choice([str(rng.randrange(9)), ""]),
            str(1 if rng.random() < 0.33 else rng.randrange(70)),
            rng.choice(["0", "3", "4", "5", "", "300"]),
        ]
        for _ in range(2_500)
    ]
    return first, second, ratings


def brute(first, second, ratings):
    """(titles and minutes candidates per id, ingredient names per id, ratings per id)"""
    rows, items = defaultdict(list), defaultdict(set)
    for title, rid, minutes, names in first:
        rid = to_int(rid, 64)
        if rid is not None:
            rows[rid].append((title or None, to_int(minutes, 32)))
            items[rid] |= parse(names)
    for rid, title, names in second:
        rid = to_int(rid, 64)
        if rid is not None:
            rid += RECIPENLG_ID_OFFSET
            items[rid] |= parse(names)
            if title:
                rows[rid].append((title, None))
    # First title in order, missing ones last; then the lowest minutes, missing ones first.
    recipes = {
        rid: min(
            found, key=lambda r: (r[0] is None, (r[0] or "").encode(), r[1] is not None, r[1] or 0)
        )
        for rid, found in rows.items()
    }
    scores = defaultdict(list)
    for user, rid, rating in ratings:
        rid = to_int(rid, 64)
        if to_int(user, 64) is not None and rid in recipes:
            scores[rid].append(to_int(rating, 8))
    return recipes, items, scores


def parse(names):
    found = re.findall(r"'[^']*'|\"[^\"]*\"", names)
    return {norm(n[1:-1]) for n in found} - {""}


@pytest.mark.parametrize("limits", ["10MB", "-1"])
@pytest.mark.parametrize("seed", range(3))
def test_random_raw_files(spark, conf, tmp_path, seed, limits):
    conf("spark.sql.autoBroadcastJoinThreshold", limits)
    first, second, ratings = random_raw(random.Random(seed))
    raw = RawPaths(
        write(tmp_path / "r.csv", ["name", "id", "minutes", "ingredients", "n_steps",
              "n_ingredients", "submitted"], [r + ["1", "2", "2020-01-01"] for r in first]),
        write(tmp_path / "i.csv", ["user_id", "recipe_id", "rating", "date"],
              [r + ["2020-01-01"] for r in ratings]),
        write(tmp_path / "s.csv", ["", "title", "NER"], second),
    )
    recipes, items, scores = brute(first, second, ratings)
    done = curate(spark, raw, str(tmp_path))

    got = {r.recipe_id: (r.title, r.minutes) for r in done.recipes.collect()}
    assert got == recipes
    names = sorted(set().union(*items.values()))
    ids = {n: i for i, n in enumerate(names, 1)}
    assert [tuple(r) for r in done.ingredients.orderBy("ingredient_id").collect()] == [
        (i, n, n) for n, i in ids.items()
    ]
    assert sorted(map(tuple, done.recipe_ingredients.collect())) == sorted(
        (rid, ids[n]) for rid, found in items.items() for n in found
    )
    rated = [(r.recipe_id, r.rating) for r in done.interactions.collect()]
    assert Counter(rated) == Counter((rid, s) for rid, all_ in scores.items() for s in all_)

    def mean(all_):
        known = [s for s in all_ if s is not None]
        return sum(known) / len(known) if known else None

    ranked = sorted(
        (
            (rid, mean(all_), len(all_))
            for rid, all_ in scores.items()
            if len(all_) >= 5
        ),
        key=lambda r: (r[1] is None, -(r[1] or 0), r[0]),
    )
    want = [(recipes[rid][0], avg, n) for rid, avg, n in ranked][:20]
    assert len(want) > 10
    for query in (top_rated, top_rated_agg_first):
        assert [tuple(r) for r in query(done.recipes, done.interactions, 5).collect()] == want

    quick = sorted((m, rid) for rid, (_, m) in recipes.items() if m is not None and m < 30)[:20]
    assert [(r.minutes, r.recipe_id) for r in quick_recipes(done.recipes).collect()] == quick

    tables = (done.recipes, done.ingredients, done.recipe_ingredients)
    laid_out = lay_out(done, str(tmp_path), f"larder_random_{seed}", buckets=3)
    assert [tuple(r) for r in laid_out.top_rated(5).collect()] == want
    for term in ("Garlic", "sea salt", "OLIVE OIL", "cup"):
        with_it = sorted(rid for rid in recipes if norm(term) in items[rid])
        found = ingredient_search(*tables, term).collect()
        assert [r.recipe_id for r in found] == with_it[:20]
        assert laid_out.ingredient_search(term).collect() == found
        every = ingredient_search(*tables, term, limit=None).collect()
        assert sorted(r.recipe_id for r in every) == with_it
    terms = ["garlic", "Sea Salt", "egg"]
    with_all = sorted(rid for rid in recipes if {"garlic", "sea salt", "egg"} <= items[rid])
    assert with_all
    for query in (multi_ingredient, multi_ingredient_k):
        found = query(*tables, terms, limit=20).collect()
        assert [r.recipe_id for r in found] == with_all[:20]
    spark.sql(f"DROP TABLE larder_random_{seed}_interactions")
    spark.sql(f"DROP TABLE larder_random_{seed}_recipes")
