"""Registered queries against their SQL, and the pipeline as a whole."""

import corpus_pipeline
import pytest

import __spark_entry__ as entry
from larder.llm.queries import ORACLES, QUERIES
from compare import connect, duck_result, same_types, spark_result


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_agrees(spark, name):
    sf = "/root/testdata/sf0.01"
    rows, types = spark_result(QUERIES[name](spark, sf))
    want, want_types = duck_result(connect(sf), ORACLES[name])
    assert rows == want and same_types(types, want_types)


def test_entry_has_all():
    names = set(entry.queries())
    assert set(QUERIES) <= names and "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert (rows.groupby("sequence_id")["length"].sum() <= 4096).all()
    assert set(rows["doc_id"]) <= {r["doc_id"] for r in docs.select("doc_id").collect()}


@pytest.mark.parametrize("name", ["op2_exact_dedup", "op3_quality"])
def test_native_queries_run_no_python(spark, sf_dir, name, capsys):
    from larder.llm import exact_dedup, quality

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plans = [exact_dedup.drop_copies(docs), quality.base_counts(docs), QUERIES[name](spark, sf_dir)]
    for plan in plans:
        plan.explain()
        shown = capsys.readouterr().out
        assert "Python" not in shown and "Pandas" not in shown and "Arrow" not in shown
