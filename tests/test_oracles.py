"""Every registered query against its SQL at sf0.01, types included."""

import pytest
from compare import connect, duck_result, same_types, spark_result

import __spark_entry__ as entry_module
from larder.oracles import ORACLES
from larder.registry import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, duck, name):
    got, spark_types = spark_result(QUERIES[name](spark, SF_DIR))
    want, duck_types = duck_result(duck, ORACLES[name])
    assert set(spark_types) == set(duck_types)
    assert same_types(spark_types, duck_types), (spark_types, duck_types)
    assert len(got) == len(want)
    assert got == want
    # Only a check that finds nothing may be empty.
    assert got or name == "duplicate_keys"


@pytest.mark.parametrize(
    "name",
    [n for n in QUERIES if n.startswith(("top_", "ingredient_s", "multi_"))],
)
def test_matches_sql_with_nothing_small(spark, conf, duck, name):
    """The way tables too big to broadcast take."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    got, _ = spark_result(QUERIES[name](spark, SF_DIR))
    want, _ = duck_result(duck, ORACLES[name])
    assert got == want


def test_entry(spark):
    assert len(entry_module.entry(spark).collect()) == 20
