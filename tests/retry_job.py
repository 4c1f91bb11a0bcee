"""Run by `test_retries`: link, merge and rank over tasks of which half fail at first."""

import sys

from pyspark import TaskContext
from pyspark.sql import functions as F

from lutrin.operators import links, merge
from lutrin.session import build_session

spark = build_session(
    "retries",
    "local[4,4]",
    **{
        "spark.sql.shuffle.partitions": "6",
        "spark.driver.memory": "2g",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    },
)
spark.sparkContext.setLogLevel("OFF")


def failing(batches):
    context = TaskContext.get()
    if context.attemptNumber() == 0 and context.partitionId() % 2 == 0:
        raise RuntimeError("lost")
    yield from batches


def shaky(df):
    return df.mapInPandas(failing, df.schema) if sys.argv[1] == "lose" else df


logins = (
    F.when(F.col("id") % 3 == 0, "guest")
    .when(F.col("id") % 3 == 1, "")
    .otherwise(F.concat(F.lit("u"), (F.col("id") % 500).cast("string")))
)
facts = shaky(spark.range(0, 12000, 1, 6).select("id", logins.alias("login")))
persons = shaky(spark.range(0, 400, 1, 3).select(F.concat(F.lit("u"), "id").alias("usager"), F.col("id").alias("n")))
linked = links.link(facts, persons, "login", "usager", {"n": "n"})
latest = merge.latest_by(facts, ["login"], [F.desc("id")])
merged = merge.upsert(latest, facts.filter("id % 7 = 0").withColumn("login", F.lit("x")), ["id"], update=["login"])
for df in (linked, latest, merged):
    print(df.count(), df.agg(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()[0])
spark.stop()
