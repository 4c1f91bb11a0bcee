from pyspark.sql import functions as F

from checks.deliveries import state_version
from lutrin.warehouse import latest_version


def test_the_version_is_found_by_spark_and_is_that_of_the_listing(spark):
    rows = [(3, 1), (3, 2), (12, 1), (9, 1), (40, 2), (None, 1), (-5, 1)]
    talks = spark.createDataFrame(rows, "conv_id long, turn int").withColumn("conv_id", F.col("conv_id") + F.lit(0))
    found = state_version(spark, {"conversations": talks}.get)
    listing = [(f"version={conv}", turn == 1) for conv, turn in rows]
    assert [r.version for r in found.collect()] == [latest_version(listing)] == [12]
    assert "HashAggregate" in found._jdf.queryExecution().executedPlan().toString()  # no row made in the driver
    assert state_version(spark, {"conversations": talks.where("false")}.get).first().version is None
