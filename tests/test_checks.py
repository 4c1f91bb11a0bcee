"""Every registered query against its SQL, and the shape of its plan."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare
from checks.files import PYTHON
from checks.registry import QUERIES, SQL


def test_every_query_is_registered_with_its_sql():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.items() <= entry.queries().items() and SQL.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sf_dir, name):
    _, count, verdict = compare(spark, sf_dir, name, QUERIES[name], SQL[name])
    assert verdict == "ok" and count > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - PYTHON))
def test_no_python_and_no_pairing_of_all_rows(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["journee", "session", "bibliotheque", "frequentation", "occupation"]
    assert df.count() > 0


@pytest.mark.parametrize(
    "name, filters",
    [
        ("drop_listed", "Not(In(c_mktsegment, [BUILDING,MACHINERY]))"),
        ("drop_like", "StringContains(p_name,ring)"),
        ("date_range_scan", "LessThan(ts,2024-01-20T00:00)"),
    ],
)
def test_deletes_reach_the_scan(spark, sf_dir, name, filters):
    assert filters in formatted(QUERIES[name](spark, sf_dir))


def formatted(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize(
    "name, columns",
    [
        ("latest_by", "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>"),
        ("daily_sum", "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>"),
        ("key_check", "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>"),
        ("length_check", "ReadSchema: struct<p_name:string,p_type:string>"),
    ],
)
def test_only_needed_columns_are_read(spark, sf_dir, name, columns):
    assert columns in formatted(QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["latest_by", "insert_new", "link_left", "circulation_loans", "staff"])
def test_ranking_starts_before_the_shuffle(spark, sf_dir, name):
    plan = formatted(QUERIES[name](spark, sf_dir))
    assert plan.count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", ["synonym_multi", "traffic", "students", "staff", "room_bookings"])
def test_small_lookups_are_broadcast(spark, sf_dir, name):
    """By size, not by hint."""
    plan = formatted(QUERIES[name](spark, sf_dir))
    assert "BroadcastHashJoin" in plan


def test_large_lookups_are_not_broadcast(spark, sf_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ["synonym_multi", "case_level_join", "lookup_chain", "status_antijoin", "synonym_gate"]:
            plan = formatted(QUERIES[name](spark, sf_dir))
            assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
            assert compare(spark, sf_dir, name, QUERIES[name], SQL[name])[2] == "ok"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_results_do_not_depend_on_adaptive_execution(spark, sf_dir):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ["link_left", "training_registrations", "circulation_loans", "traffic"]:
            assert compare(spark, sf_dir, name, QUERIES[name], SQL[name])[2] == "ok"
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
