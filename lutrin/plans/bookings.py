"""Room bookings.

The table has no key of its own: two bookings of a person in a room on one day may look
alike. A technical column keeps the source key of every row, so that a booking that is
delivered again replaces itself, and bookings that a delivery does not list stay.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lutrin import values as V
from lutrin.functions.dates import day_of, term_start
from lutrin.functions.privacy import pseudonymize
from lutrin.operators import gates as G
from lutrin.operators.filters import drop_flagged, drop_listed
from lutrin.operators.links import link, unique_persons
from lutrin.operators.lookups import normalize
from lutrin.operators.merge import replace_keys
from lutrin.schemas import TABLES, conform

# The technical column of the table's files.
SOURCE_KEY = "cle_source"
SOURCE_KEY_DDL = f"{SOURCE_KEY} string"
_KEY_FIELDS = ("fromDate", "location_name", "item_name", "email")


def kept_bookings(staging, statuts):
    return drop_listed(
        drop_flagged(staging, "status", statuts), "location_name", V.TEST_LOCATIONS
    )


def booking_gates(staging, lookups):
    kept = kept_bookings(staging, lookups.statuts)
    names = lookups.synonymes.filter(F.col("domaine") == V.BOOKINGS).select("rejeter")
    return [
        G.Gate("bookings: unknown statuses", G.unlisted(kept, "status", lookups.statuts.select("nom"))),
        G.Gate("bookings: unknown libraries", G.unlisted(kept, "location_name", names)),
    ]


def with_source_key(staging, salts):
    """Time, place, room and address as a salted hash, and a number for rows that share them."""
    text = F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in _KEY_FIELDS])
    hashed = staging.withColumn("_key", pseudonymize(text, salts))
    same = Window.partitionBy("_key").orderBy("status", "category_name")
    numbered = F.concat(F.col("_key"), F.lit("-"), F.row_number().over(same).cast("string"))
    return hashed.withColumn(SOURCE_KEY, numbered).drop("_key")


def merge_bookings(current, delivered):
    """Current rows, with their source keys, and those of a delivery in place of their equals."""
    return replace_keys(current, delivered, [SOURCE_KEY])


def build_bookings(staging, persons, lookups, salts, keyed=False):
    """Bookings with person and discipline. Without a person the discipline is unknown;
    a person without a discipline leaves it missing. `keyed` adds the source key."""
    kept = kept_bookings(staging, lookups.statuts)
    linked = link(
        with_source_key(kept, salts) if keyed else kept,
        unique_persons(persons, "courriel", salts),
        "email",
        "courriel",
        {"usager": "usager", "discipline": "discipline"},
        encode=lambda c: pseudonymize(c, salts),
    )
    named = normalize(linked, ["location_name"], lookups.synonymes, V.BOOKINGS)
    rows = named.select(
        "usager",
        pseudonymize(F.col("email"), salts).alias("courriel"),
        F.when(F.col("usager").isNull(), V.UNKNOWN_DISCIPLINE)
        .otherwise(F.col("discipline"))
        .alias("discipline"),
        day_of(F.col("fromDate")).alias("journee"),
        term_start(day_of(F.col("fromDate"))).alias("session"),
        F.col("location_name").alias("bibliotheque"),
        F.col("category_name").alias("categorie"),
        F.col("item_name").alias("salle"),
        *([SOURCE_KEY] if keyed else []),
    )
    if keyed:
        rows = rows.select(
            *[F.col(f.name).cast(f.dataType) for f in TABLES["reservations"].schema.fields], SOURCE_KEY
        )
    else:
        rows = conform(rows, "reservations")
    return G.Build(rows, booking_gates(staging, lookups))
