"""Every operator and stage over odd rows and over none."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from larder.llm import language, mixing, quality, secrets, sharding, toxicity
from larder.llm.exact_dedup import copy_groups
from larder.llm.near_dedup import near_duplicates
from larder.llm.packing import pack
from larder.llm.vocabulary import tokenizer_file

from .conftest import LONG, ODD


def labels(spark):
    rows = [(1, 0, 1), (4, 1, 0), (4, 1, 1), (None, 1, 1), (11, None, None), (99, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def toxic(docs):
    learns = F.lit(True)
    return toxicity.score(docs, toxicity.train(docs, labels(docs.sparkSession), learns))


PER_ROW = {
    "copies": copy_groups,
    "quality": quality.judge,
    "toxicity": toxic,
    "shards": sharding.shard_rows,
    "secrets": secrets.find_secrets,
    "language": lambda docs: language.predict(docs, language.train(docs)),
    "mixing": lambda docs: mixing.mix(docs),
    "near": near_duplicates,
}


@pytest.mark.parametrize("name", PER_ROW)
def test_a_row_for_every_row(odd, empty, name):
    found = PER_ROW[name](odd)
    ids = sorted((r["doc_id"] for r in found.select("doc_id").collect()), key=str)
    assert ids == sorted((r[0] for r in ODD), key=str)
    none = PER_ROW[name](empty)
    assert none.count() == 0
    assert none.columns == found.columns


@pytest.mark.parametrize("name", [*PER_ROW, "packing"])
def test_very_long_lines_and_words(spark, name):
    line = "over the hill and far away there is a house of stone, " * 20_000
    word = "abcdefghijklmnop" * 20_000
    rows = [(1, line), (2, word), (3, word + " " + line), (4, "a short text of some words")]
    docs = spark.createDataFrame(
        [(i, text, "en", "s") for i, text in rows], "doc_id long, text string, lang string, source string"
    )
    operator = PER_ROW.get(name, lambda docs: pack(docs, tokenizer_file()))
    assert {r["doc_id"] for r in operator(docs).select("doc_id").collect()} == {1, 2, 3, 4}


def test_packing(odd, empty):
    rows = pack(odd, tokenizer_file()).toPandas()
    assert set(rows["doc_id"].dropna().astype(int)) == {r[0] for r in ODD if r[0] is not None}
    assert rows["doc_id"].isna().sum() == 2
    assert (rows.groupby("sequence_id")["length"].sum() <= 4096).all()
    # Null, empty and blank texts are the end token alone.
    assert rows[rows["doc_id"].isin([1, 2, 3])]["length"].tolist() == [1, 1, 1]
    assert pack(empty, tokenizer_file()).count() == 0


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages(spark, odd, empty, sf_dir, stage):
    name, function = stage
    found = function(spark, odd, sf_dir)
    assert function(spark, empty, sf_dir).count() == 0
    if name != corpus_pipeline.STAGES[-1][0]:
        assert found.columns == odd.columns
        # Whole rows come out as they went in, but for a language filled in.
        before = {(r["doc_id"], r["text"], r["source"], r["kept"]) for r in odd.collect()}
        after = [(r["doc_id"], r["text"], r["source"], r["kept"]) for r in found.collect()]
        assert set(after) <= before
        assert any(r[1] in (LONG, LONG + " tail") for r in after)


def test_language_stage_rejects_texts_without_letters(spark, odd, sf_dir):
    found = corpus_pipeline.known_language(spark, odd, sf_dir).toPandas()
    assert set(found["doc_id"].dropna().astype(int)) == {4, 5, 6, 7, 8, 10, 11, 12, 1 << 62}
    assert found["lang"].notna().all()


def test_copies_of_odd_rows(odd):
    rows = {}
    for r in copy_groups(odd).collect():
        rows.setdefault(r["doc_id"], []).append((r["keep_id"], r["group_size"], r["kept"]))
    # Null and empty are equal; a null id is the smallest.
    assert rows[1] == [(2, 3, False)] and rows[2] == [(2, 3, True)]
    assert sorted(rows[5]) == [(5, 3, False), (5, 3, True)]
    assert rows[4] == [(5, 3, False)]
    assert set(rows[None]) == {(None, 1, True), (2, 3, False)}


def test_near_duplicates_of_odd_rows(odd):
    rows = {}
    for r in near_duplicates(odd).collect():
        rows.setdefault(r["doc_id"], set()).add((r["n_shingles"], r["component_id"], r["kept"]))
    assert rows[1] == {(0, 1, True)} and rows[3] == {(0, 3, True)}
    # One word in either case is one shingle.
    assert rows[4] == {(1, 4, True)} and rows[5] == {(1, 4, False)} and rows[6] == {(1, 4, False)}
    assert {r[1] for r in rows[8]} == {7}


def test_quality_of_odd_rows(odd):
    rows = {r["doc_id"]: r for r in quality.judge(odd).collect()}
    assert rows[1]["n_words"] == rows[3]["n_words"] == 0 and rows[1]["base_failed"]
    assert rows[12]["word_chars"] == len("a\x00b \U0001f926\U0001f3fdé")
    assert rows[11]["n_repeat_words"] == rows[11]["n_words"] and not rows[11]["kept"]


def test_shards_of_odd_rows(odd):
    rows = sharding.shard_rows(odd, shards=3).toPandas()
    assert rows.groupby("shard").size().max() - rows.groupby("shard").size().min() <= 1
    for _, of in rows.groupby("shard"):
        assert sorted(of["slot"]) == list(range(len(of)))
    for r in rows.itertuples():
        assert sharding.row_at(r.shard, r.slot, len(rows), 3) == r.row_number


def test_mixing_of_odd_rows_without_a_topic_column(odd, empty):
    found = mixing.mix(odd.drop("topic"))
    rows = found.toPandas()
    assert len(rows) == len(ODD)
    blank = rows[rows["doc_id"].isin([1, 2, 3, 9])]
    assert (blank["topic"] == mixing.OTHER).all()
    assert (rows[rows["doc_id"] == 4]["topic"] != mixing.OTHER).all()
    assert mixing.mix(empty.drop("topic")).columns == found.columns
    assert mixing.sample(empty.drop("topic")).count() == 0
    assert mixing.sample(odd.drop("topic"), share=1.0).count() == len(ODD)


def test_pages_of_odd_rows(spark):
    from larder.llm.html_text import extract

    long = "<div class='sidebar'><p>" + "the words of it " * 100_000 + "</div>" * 3 + "<div class=legal-x>" * 5_000
    rows = [
        (1, "u", None), (2, None, ""), (None, "u", "<p>a</p>"), (3, "u", "<article>x"), (3, "u", "<article>x"),
        (4, "u", long), (5, "u", "<" * 50_000), (6, "u", "<p>&#0;&bad;\x00\U0001f926</p>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.withColumn("text", F.lit("x")).withColumn("n_chars", F.lit(1)).repartition(3)
    found = extract(pages)
    got = [(r["page_id"], r["url"], r["text"], r["n_chars"]) for r in found.collect()]
    assert sorted(map(str, (r[0] for r in got))) == sorted(str(r[0]) for r in rows)
    by = {r[0]: r for r in got}
    assert by[1][2] == by[2][2] == "" and by[3] == (3, "u", "x", 1) and by[None][2] == "a"
    assert by[4][3] == len("the words of it ") * 100_000 - 1
    assert all(r[3] == len(r[2]) for r in got)
    none = extract(pages.limit(0))
    assert none.count() == 0 and none.columns == found.columns
