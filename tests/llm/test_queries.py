"""The registered queries: against their SQL, and over whole tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare
from lutrin.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, sf_dir, name):
    _, count, verdict = compare(spark, sf_dir, name, queries.QUERIES[name], queries.SQL[name])
    assert verdict == "ok" and count > 0


TABLES = {"op3": "embeddings", "op7": "pages", "op10": "pages"}


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op1_best_fit_packing", "op11_embedding_whitening"}))
def test_one_row_for_every_row_of_the_table(spark, sf_dir, name):
    table = TABLES.get(name.split("_")[0], "documents")
    assert queries.QUERIES[name](spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()


def test_registered_with_the_driver():
    assert queries.QUERIES.items() <= entry.queries().items() and "pipeline" in entry.queries()
    assert queries.SQL.items() <= entry.oracle_sql().items()
