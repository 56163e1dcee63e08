"""List parsing and normalisation against plain Python, on strings the data does not hold."""

import random
import re
from urllib.parse import unquote, urlparse

from hypothesis import HealthCheck, given, settings, strategies as st
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from larder import registry
from larder.functions.text import normalize, normalized_names, normalized_terms, parse_list
from larder.operators.dimension import normalized_lists, stage_items
from larder.standins import SCHEMAS, list_literal


def scan_items(s):
    """Brute force: walk the string, take each quoted item that closes."""
    items, i = [], 0
    while i < len(s or ""):
        quote, j = s[i], i + 1
        if quote in "'\"":
            while j < len(s) and s[j] != quote:
                if s[j] == "\\":
                    if j + 1 >= len(s) or s[j + 1] == "\n":
                        j = len(s)
                        break
                    j += 1
                j += 1
            if j < len(s):
                items.append(s[i + 1 : j])
                i = j
        i += 1
    return items


def parsed(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    rows = df.select("i", parse_list("s").alias("items")).collect()
    return [r["items"] for r in sorted(rows, key=lambda r: r["i"])]


def test_random_lists(spark):
    rng = random.Random(7)
    alphabet = ["'", '"', "\\", "a", "é", ",", " ", "\n", "\r", "\u2028", "[", "𝒳"]
    texts = [
        "".join(rng.choices(alphabet, k=rng.randrange(0, 24))) for _ in range(20_000)
    ] + [None, "", "[]"]
    assert parsed(spark, texts) == [scan_items(t) for t in texts]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(codec="utf-8")), min_size=1, max_size=60))
def test_any_text(spark, items):
    literals = ["[" + ", ".join(f"'{t}'" for t in items) + "]", *items]
    assert parsed(spark, literals) == [scan_items(t) for t in literals]


def test_known_lists(spark):
    texts = ["""['x', "y's", '']""", r"['confectioners\' sugar']", "['a', 'b", None, "[]"]
    assert parsed(spark, texts) == [
        ["x", "y's", ""],
        [r"confectioners\' sugar"],
        ["a"],
        [],
        [],
    ]


def test_long_items(spark):
    texts = [f"['{'a' * n}']" for n in (5_000, 200_000)] + ["'" + r"\'" * 100_000 + "'"]
    assert [len(items[0]) for items in parsed(spark, texts)] == [5_000, 200_000, 200_000]


def test_normalize(spark):
    expected = {
        "Jalapeño Peppers": "jalape o peppers",
        "Half & Half": "half half",
        "2% milk": "2 milk",
        "!!!": "",
        "  Salt \t\n ": "salt",
        "no\u00a0break": "no break",
    }
    df = spark.createDataFrame([(k,) for k in expected], "s string")
    got = {r.s: r.n for r in df.select("s", normalize("s").alias("n")).collect()}
    assert got == expected


def test_normalize_random(spark):
    rng = random.Random(11)
    texts = ["".join(rng.choices("aZé9-' \t\n\rß\u3000", k=12)) for _ in range(2_000)]

    def brute(s):
        s = re.sub(r"[^a-z0-9\s]", " ", s.lower(), flags=re.ASCII)
        return re.sub(r"\s+", " ", s, flags=re.ASCII).strip(" ")

    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for row in df.select("s", normalize("s").alias("n")).collect():
        assert row.n == brute(row.s)


def test_terms_are_cleaned_like_names(spark):
    cleaned = spark.range(1).select(*normalized_terms(["Half & Half ", "GARLIC"])).first()
    assert tuple(cleaned) == ("half half", "garlic")
    with pytest.raises(ValueError):
        normalized_terms([])


def test_no_python_in_plan(spark):
    df = spark.range(1).select(F.explode(parse_list(F.lit("['a']"))).alias("x"))
    plan = df.select(normalize("x"))._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan


def test_list_literals_are_written_in_place(spark):
    texts = ["", " ", "a", " a  b\n", "it's 'so'", "a\\ \\'b' \"c\"", "x\u00a0y\tz\u0085", "$1 \\$2", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, text string").repartition(1)
    found = rows.select("n", list_literal(F.col("text"), r"\s+").alias("found"), F.split("text", r"\s+").alias("parts"))
    for row in found.collect():
        if row["parts"] is None:
            assert row["found"] is None
            continue
        escaped = [p.replace("\\", "\\\\").replace("'", "\\'") for p in row["parts"]]
        assert row["found"] == "['" + "', '".join(escaped) + "']"


def test_stable_ids_parses_no_list_twice(spark, tmp_path, monkeypatch):
    texts = [("en", "b a"), ("en", "B c"), ("de", "d b"), (None, "e a"), ("en", None), ("de", "")]
    docs = [(i % 5, text, lang, "s", 1) for i, (lang, text) in enumerate(texts)]
    spark.createDataFrame(docs, SCHEMAS["documents"]).write.parquet(f"{tmp_path}/documents.parquet")
    parsed = []

    def counted(lists, text):
        parsed.append(lists.count())
        return normalized_lists(lists, text)

    monkeypatch.setattr(registry, "normalized_lists", counted)
    rows = registry.stable_ids(spark, str(tmp_path)).collect()
    assert sorted((r["ingredient_id"], r["ingredient_name_norm"]) for r in rows) == [
        (1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e")
    ]
    assert sum(parsed) == len(docs)


def test_names_of_random_lists(spark):
    """Lists cleaned whole against items cut out and cleaned one by one."""
    rng = random.Random(8)
    alphabet = ["'", "'", '"', "\\", "a", "B", "7", "é", "İ", "Σ", "K", ",", " ", "\n", "\x01", "$1", "𝒳"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(0, 30))) for _ in range(20_000)]
    texts += [None, "", "[]", "['']", "['olive  oil!', \"Sea-Salt \"]", "'" + "a\\'" * 20_000 + "'"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    rows = df.select("i", normalized_names("s").alias("names")).collect()
    got = {r["i"]: r["names"] for r in rows}
    assert len(rows) == len(texts) and got[20_000] is None
    for i, text in enumerate(texts):
        cleaned = {re.sub("[^a-z0-9]+", " ", item.lower()).strip(" ") for item in scan_items(text)}
        names = [name for name in got[i] or [] if name]
        assert sorted(names) == sorted(cleaned - {""}), text


def test_no_expression_runs_per_item(spark, capsys):
    lists = spark.createDataFrame([(1, "['Olive  Oil!', 'salt']")], "recipe_id long, items string")
    names = normalized_lists(lists, "items")
    assert sorted(names.collect()) == [(1, "olive oil"), (1, "salt")]
    names.explain(True)
    assert "lambda" not in capsys.readouterr().out


def test_items_are_written_without_dictionaries(spark):
    items = spark.createDataFrame([(i, f"name {i % 3}") for i in range(3_000)], "recipe_id long, ingredient_name_norm string")
    staged = stage_items(items)
    assert sorted(staged.collect()) == sorted(items.collect())
    files = [unquote(urlparse(path).path) for path in staged.inputFiles()]
    assert files
    for file in files:
        group = pq.read_metadata(file).row_group(0)
        assert not [e for c in range(2) for e in group.column(c).encodings if "DICTIONARY" in e]
