"""Ids, de-duplication, references and the top-k helpers, with hot keys and many copies."""

import random

import pytest
from pyspark.sql import Window, functions as F

from larder.operators.audits import duplicate_keys, key_summary
from larder.operators.dedup import dedup_by_key
from larder.operators.ids import dense_ids, row_ids
from larder.operators.references import keep_referenced, orphans
from larder.operators.topk import SLACK, join_existing, lowest_k, top_k_existing

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture
def many_partitions(conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")


def test_dense_ids_equal_the_global_window(spark, many_partitions):
    names = spark.read.parquet(f"{SF_DIR}/orders.parquet").select(
        F.concat_ws("#", "o_orderpriority", "o_orderkey").alias("name")
    )
    got = dense_ids(names, ["name"], "id")
    want = names.withColumn("id", F.row_number().over(Window.orderBy("name")).cast("long"))
    assert got.columns == ["id", "name"]
    assert got.count() == want.count()
    assert got.join(want, ["id", "name"]).count() == want.count()


def test_dense_ids_of_nothing(spark):
    assert dense_ids(spark.range(0), ["id"], "n").count() == 0


def test_row_ids_without_a_shuffle(spark, many_partitions, capsys):
    """Dense ids over rows that repeat, in place: the same on every read, and no exchange."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k")
    )
    got = row_ids(rows, "n")
    got.explain()
    assert "Exchange" not in capsys.readouterr().out
    stats = got.agg(F.min("n"), F.max("n"), F.count_distinct("n"), F.count("k")).collect()[0]
    assert tuple(stats) == (1, 30_000, 30_000, 30_000)
    assert got.groupBy("k").count().filter("k = 7").collect()[0]["count"] == 10_001
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, got.collect()))
    per_task = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).collect()[0][0]
    assert per_task < 20_000


def test_row_ids_of_nothing(spark):
    assert row_ids(spark.range(0), "n").count() == 0


def test_dedup_winner_ignores_order(spark):
    rows = [(i % 5, random.Random(i).choice([None, 1, 2]), str(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, a int, b string")
    one = dedup_by_key(df, ["k"], [F.col("a").asc_nulls_last()])
    two = dedup_by_key(
        df.orderBy(F.rand(3)).repartition(7), ["k"], [F.col("a").asc_nulls_last()]
    )
    want = {}
    for k, a, b in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2])):
        want.setdefault(k, (k, a, b))
    assert sorted(map(tuple, one.collect())) == sorted(want.values())
    assert sorted(map(tuple, two.collect())) == sorted(want.values())


def test_dedup_shrinks_before_the_shuffle(spark):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").select("l_orderkey", "l_partkey")
    plan = dedup_by_key(lines, ["l_orderkey"])._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange hashpartitioning(l_orderkey")
    assert "row_number(), 1, Final" in above
    assert "row_number(), 1, Partial" in below


def test_references(spark):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    parent = spark.createDataFrame([("x", 1), ("y", 1), ("z", 3)], "w string, k int")
    kept = keep_referenced(child.select("v", "k"), parent, "k")
    assert kept.columns == ["v", "k"]
    assert sorted(map(tuple, kept.collect())) == [("a", 1), ("b", 1)]
    assert [tuple(r) for r in orphans(child, "k", parent).collect()] == [(2, 1)]


def test_key_summary(spark):
    rows = [(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)]
    df = spark.createDataFrame(rows, "a int, b int")
    assert tuple(key_summary(df, ["a", "b"]).collect()[0]) == (5, 2, 1, 2)
    assert tuple(key_summary(df.limit(0), ["a"]).collect()[0]) == (0, 0, 0, 0)
    assert {tuple(r) for r in duplicate_keys(df, ["a", "b"]).collect()} == {
        (1, 1, 2),
        (None, 1, 2),
    }


@pytest.fixture(params=["small lookup", "big lookup"])
def lookup_size(request, conf):
    """Whether the lookup counts as small enough to broadcast."""
    if request.param == "big lookup":
        conf("spark.sql.autoBroadcastJoinThreshold", "-1")


@pytest.mark.parametrize("orphan_share", [0.0, 0.5, 0.99, 1.0])
def test_top_k_existing(spark, lookup_size, orphan_share):
    """Same as join then limit, however many of the leaders are orphans."""
    rng = random.Random(int(orphan_share * 100))
    n = 4 * SLACK
    candidates = spark.createDataFrame(
        [(i, rng.randrange(50)) for i in range(n)] + [(3, 0), (3, 0)], "k int, score int"
    )
    kept = [i for i in range(n) if rng.random() >= orphan_share]
    lookup = spark.createDataFrame([(i, f"t{i}") for i in kept], "k int, title string")
    order = [F.col("score").desc(), F.col("k").asc()]
    got = top_k_existing(candidates, lookup, "k", order, 20).select("k", "score", "title")
    want = candidates.join(lookup, "k").orderBy(*order).limit(20).select("k", "score", "title")
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]


def test_top_k_leaders_all_orphans(spark, lookup_size):
    candidates = spark.range(1000).select(F.col("id").alias("k"))
    lookup = spark.range(990, 1000).select(F.col("id").alias("k"))
    got = top_k_existing(candidates, lookup, "k", [F.col("k").asc()], 5)
    assert [r.k for r in got.collect()] == [990, 991, 992, 993, 994]


def test_join_existing(spark, lookup_size):
    candidates = spark.createDataFrame([(i % 40,) for i in range(60)] + [(None,)], "k int")
    lookup = spark.createDataFrame([(i, f"t{i}") for i in range(0, 80, 3)], "k int, title string")
    got = join_existing(candidates, lookup, "k").select("k", "title")
    want = candidates.join(lookup, "k").select("k", "title")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert join_existing(candidates.limit(0), lookup, "k").count() == 0


def test_lowest_k(spark):
    df = spark.createDataFrame(
        [(i, None if i % 7 == 0 else i % 4, "x" * i) for i in range(60)],
        "id int, m int, wide string",
    )
    got = [(r.m, r.id) for r in lowest_k(df, "m", "id", 20).collect()]
    want = sorted((i % 4, i) for i in range(60) if i % 7)[:20]
    assert got == want
    assert lowest_k(df.filter("m is null"), "m", "id", 3).count() == 0
