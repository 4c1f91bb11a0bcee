"""Merges: upsert, insert if absent, snapshot replacement, latest row per key."""

from pyspark.sql import functions as F
from pyspark.sql import Window


def latest_by(df, keys, order):
    """The first row per key in `order`.

    Spark ranks inside each input partition first and shuffles at most one row
    per key and partition, so a key that holds a third of the rows costs no more
    than the others.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def upsert(target, source, keys, update, reset=(), fill=()):
    """Target with the source merged in, matched on `keys` (unique on both sides).

    On a match the `update` columns take the source value, the `reset` columns
    become NULL for later steps to fill again, the `fill` columns take the source
    value unless it is NULL, and all others keep the target value. New rows carry
    whatever the source has.
    """
    columns = target.columns
    have = set(source.columns)
    mine = target.select(
        *[F.col(c).alias(f"_t_{c}") for c in columns], F.lit(True).alias("_in_target")
    )
    theirs = source.select(
        *[F.col(c).alias(f"_s_{c}") for c in columns if c in have], F.lit(True).alias("_in_source")
    )
    match = None
    for key in keys:
        term = F.col(f"_t_{key}") == F.col(f"_s_{key}")
        match = term if match is None else match & term
    joined = mine.join(theirs, match, "full_outer")
    matched = F.col("_in_target") & F.col("_in_source")

    def value(column):
        old = F.col(f"_t_{column}")
        new = F.col(f"_s_{column}") if column in have else F.lit(None)
        if column in keys:
            return F.coalesce(old, new)
        if column in reset:
            return F.when(F.col("_in_source"), F.lit(None)).otherwise(old)
        if column in update:
            return F.when(F.col("_in_source"), new).otherwise(old)
        if column in fill:
            return F.coalesce(new, old)
        return F.when(matched | F.col("_in_source").isNull(), old).otherwise(new)

    types = dict(target.dtypes)
    return joined.select(*[value(c).cast(types[c]).alias(c) for c in columns])


def insert_new(target, source, keys, order):
    """Target plus the source rows whose key it lacks; the first in `order` wins in the source."""
    return insert_absent(target, latest_by(source.select(*target.columns), keys, order), keys)


def insert_absent(target, source, keys):
    """Target plus the source rows, one per key already, whose key it lacks."""
    absent = source.select(*target.columns).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(absent)


def replace_keys(target, source, keys):
    """Target with all rows of the source's keys exchanged for the source rows; other rows stay."""
    delivered = source.select(*keys).distinct()
    return target.join(delivered, list(keys), "left_anti").select(*target.columns).unionByName(
        source.select(*target.columns)
    )


def replace_days(target, source, day="journee"):
    """Target with all rows of the source's days exchanged for the source rows."""
    # At most one row per calendar day: bounded by the calendar, not by the data.
    days = F.broadcast(source.select(day).distinct())
    return target.join(days, day, "left_anti").select(*target.columns).unionByName(
        source.select(*target.columns)
    )


def combine(students, staff):
    """Both kinds of people in one table; a column one side lacks is NULL there."""
    return students.unionByName(staff, allowMissingColumns=True)
