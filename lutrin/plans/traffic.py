"""Door counts: entries and occupancy per library and day."""

from pyspark.sql import functions as F

from lutrin import values as V
from lutrin.functions.dates import term_start
from lutrin.operators import gates as G
from lutrin.operators.aggregates import daily_sum, whole_hours
from lutrin.operators.lookups import normalize
from lutrin.operators.merge import upsert
from lutrin.schemas import conform


def daily_traffic(entries, occupancy, synonyms):
    """Entries per library and day, with the hours of occupancy where there are samples.

    Sums are made per sector code first, which leaves few rows; codes of one
    library then meet under its name. Samples are summed before they become hours.
    """
    sums = daily_sum(entries, "Date", ["Secteur"], "Entrees", "frequentation")
    counted = _by_library(sums, synonyms).groupBy("journee", "bibliotheque").agg(
        F.sum("frequentation").alias("frequentation")
    )
    samples = daily_sum(occupancy, "Date", ["Secteur"], "Occupation", "_samples")
    hours = _by_library(samples, synonyms).groupBy("journee", "bibliotheque").agg(
        whole_hours("_samples").alias("occupation")
    )
    return counted.join(hours, ["journee", "bibliotheque"], "left")


def _by_library(sums, synonyms):
    named = normalize(sums, ["Secteur"], synonyms, V.TRAFFIC)
    return named.withColumnRenamed("Secteur", "bibliotheque")


def build_traffic(entries, occupancy, synonyms, current):
    """Daily traffic merged into the current table; a delivered day is replaced as a whole."""
    merged = upsert(
        current,
        daily_traffic(entries, occupancy, synonyms),
        ["journee", "bibliotheque"],
        update=("frequentation", "occupation"),
        reset=("session",),
    )
    rows = merged.withColumn("session", F.coalesce("session", term_start(F.col("journee"))))
    names = synonyms.filter(F.col("domaine") == V.TRAFFIC).select("rejeter")
    return G.Build(
        conform(rows, "frequentation"),
        [
            G.Gate("traffic: unknown libraries", G.unlisted(entries, "Secteur", names)),
            G.Gate("occupancy: unknown libraries", G.unlisted(occupancy, "Secteur", names)),
            G.Gate("traffic: key", G.missing_values(entries, ["Date", "Secteur"])),
        ],
    )
