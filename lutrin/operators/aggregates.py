"""Daily sums, participant counts, split factors and weighted population."""

from pyspark.sql import functions as F

from lutrin.functions.dates import day_of
from lutrin.schemas import TABLES

SHARE = "decimal(21,20)"
QUARTERS_PER_HOUR = 4


def daily_sum(df, instant, by, value, into):
    """Sum per day and group; partial sums are made before the shuffle."""
    return df.groupBy(day_of(F.col(instant)).alias("journee"), *by).agg(
        F.sum(F.col(value).cast("bigint")).alias(into)
    )


def whole_hours(samples):
    """Sum of a column of quarter-hour samples, as whole hours truncated towards zero."""
    return F.expr(f"sum({samples}) div {QUARTERS_PER_HOUR}")


def daily_hours(df, instant, by, value, into):
    """Hours per day and group."""
    return (
        df.select(day_of(F.col(instant)).alias("journee"), *by, F.col(value).alias("_samples"))
        .groupBy("journee", *by)
        .agg(whole_hours("_samples").alias(into))
    )


def left_count(parents, children, on, child_key, counted, into):
    """Number of non-missing `counted` values per parent; zero where there is none.

    The children are counted before the join, so a parent with most of the
    children costs one row.
    """
    counts = children.groupBy(F.col(child_key).alias(on)).agg(F.count(counted).alias(into))
    return parents.join(counts, on, "left").withColumn(into, F.coalesce(into, F.lit(0)))


def split_factor(disciplines):
    """Each row's share of its discipline: 1 / number of rows of the discipline, 20 decimals.

    Counted with partial aggregation and joined back, not with a window: a window
    would bring each whole discipline into one task.
    """
    counts = disciplines.groupBy("discipline").agg(F.count(F.lit(1)).alias("_n"))
    share = (F.lit(1).cast(SHARE) / F.col("_n")).cast(SHARE)
    kept = [c for c in disciplines.columns if c != "facteur"]
    return disciplines.join(counts, "discipline", "left").select(
        *kept, share.alias("facteur")
    )


def population_counts(people, except_function, by=()):
    """People per discipline, function, level and term, and per `by`. Counts of parts of the people add up."""
    return (
        people.filter(F.col("fonction") != except_function)
        .groupBy(*by, "discipline", "fonction", "niveau", "session")
        .agg(F.count("usager").alias("nb"))
    )


def weigh(counts, disciplines):
    """Counts, added up, times the librarians' shares.

    Only the counts meet the librarians. A count is cut to decimal(12,0) so that the product
    keeps all 20 decimals of the share.
    """
    added = counts.groupBy("discipline", "fonction", "niveau", "session").agg(F.sum("nb").alias("_n"))
    weighted = F.col("_n").cast("decimal(12,0)") * F.col("facteur").cast(SHARE)
    joined = added.join(
        disciplines.select("discipline", "bibliothecaire", "bibliotheque", "secteur", "facteur"),
        "discipline",
    )
    columns = TABLES["disciplines_stats"].schema.names
    return joined.withColumn("nb_personnes", weighted.cast("decimal(34,20)")).select(*columns)


def weighted_population(people, disciplines, except_function):
    """People per discipline, librarian, function, level and term, times the librarian's share."""
    return weigh(population_counts(people, except_function), disciplines)
