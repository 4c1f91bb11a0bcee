"""Training events and registrations."""

from pyspark.sql import functions as F

from lutrin import values as V
from lutrin.functions.dates import day_of, term_start
from lutrin.functions.privacy import pseudonymize
from lutrin.functions.text import blank_to_null
from lutrin.operators import gates as G
from lutrin.operators.aggregates import left_count
from lutrin.operators.filters import drop_containing_any_case
from lutrin.operators.links import HOT_SHARE, enrich_missing, hot_keys, unique_persons
from lutrin.operators.merge import upsert
from lutrin.schemas import conform


def build_events(staging, registrations, current):
    """Events with their number of registrations, merged into the current ones."""
    events = drop_containing_any_case(
        staging.withColumn("presenter", blank_to_null(F.col("presenter"))),
        "presenter",
        V.TEST_PRESENTER_PART,
    )
    counted = left_count(events, registrations, "id", "event_id", "email", "nb_participants")
    source = counted.select(
        "id",
        F.col("title").alias("titre"),
        day_of(F.col("start")).alias("journee"),
        F.col("owner").alias("proprietaire"),
        F.col("presenter").alias("presentateur"),
        "nb_participants",
    )
    merged = upsert(
        current,
        source,
        ["id"],
        update=("titre", "journee", "proprietaire", "presentateur", "nb_participants"),
        reset=("session",),
    )
    rows = merged.withColumn(
        "presentateur", F.coalesce("presentateur", "proprietaire")
    ).withColumn("session", F.coalesce("session", term_start(F.col("journee"))))
    return G.Build(
        conform(rows, "evenements"), [G.Gate("events: key", G.broken_keys(staging, ["id"]))]
    )


def build_registrations(staging, persons, current, salts):
    """Registrations merged into the current ones; all without a person are looked up again."""
    source = staging.select(
        F.col("booking_id").alias("id"),
        pseudonymize(F.col("email"), salts).alias("courriel"),
        F.col("event_id").alias("evenement_id"),
    )
    merged = upsert(
        current, source, ["id", "evenement_id"], update=("courriel",), reset=("usager",)
    )
    # The blank pseudonym has no person row, so it stays unlinked; being hot, it is spread.
    # Hot keys are counted in both tables rather than in their merger; half the share
    # in one of them is reached by any key that has the share in the whole.
    hot = (
        hot_keys(staging, "email", HOT_SHARE / 2)
        .select(pseudonymize(F.col("email"), salts).alias("courriel"))
        .union(hot_keys(current.filter(F.col("usager").isNull()), "courriel", HOT_SHARE / 2))
        .distinct()
    )
    rows = enrich_missing(
        merged,
        unique_persons(persons, "courriel", salts),
        "courriel",
        "courriel",
        {"usager": "usager", "discipline": "discipline"},
        missing=["usager"],
        hot=hot,
    )
    return G.Build(
        conform(rows, "inscriptions"),
        [G.Gate("registrations: key", G.broken_keys(staging, ["event_id", "booking_id"]))],
    )
