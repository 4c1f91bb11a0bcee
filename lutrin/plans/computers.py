"""Sessions on public computers."""

from functools import reduce
from operator import and_, or_

from pyspark.sql import functions as F

from lutrin import values as V
from lutrin.functions.dates import day_of, term_start
from lutrin.functions.privacy import pseudonymize
from lutrin.operators import gates as G
from lutrin.operators.filters import drop_containing
from lutrin.operators.links import HOT_SHARE, enrich_missing, hot_keys, unique_persons
from lutrin.operators.lookups import normalize
from lutrin.operators.merge import upsert
from lutrin.schemas import conform

KEY = ["usager", "ordinateur", "dateheure"]
PERSON_COLUMNS = ("courriel", "discipline", "bibliotheque")


def computer_source(staging, salts):
    kept = drop_containing(staging, "Secteur", V.TEST_SECTOR_PART)
    return kept.select(
        pseudonymize(F.col("Utilisateur_Login"), salts).alias("usager"),
        day_of(F.col("Ouverture_session")).alias("journee"),
        F.col("Ouverture_session").alias("dateheure"),
        F.col("Secteur").alias("lieu"),
        F.col("Station").alias("ordinateur"),
        F.col("Duree").alias("duree"),
    )


def computer_gates(staging, synonyms, salts):
    kept = drop_containing(staging, "Secteur", V.TEST_SECTOR_PART)
    names = synonyms.filter(F.col("domaine") == V.COMPUTERS).select("rejeter")
    return [
        G.Gate("computers: unknown libraries", G.unlisted(kept, "Secteur", names)),
        G.Gate("computers: repeated sessions", G.broken_keys(computer_source(staging, salts), KEY)),
    ]


def refresh_sessions(sessions, persons, synonyms, salts, hot=None):
    """Names, person columns, unknown discipline and term of all given sessions."""
    named = normalize(sessions, ["lieu"], synonyms, V.COMPUTERS)
    known = unique_persons(persons, "usager", salts)
    linked = enrich_missing(
        named,
        known,
        "usager",
        "usager",
        {c: c for c in PERSON_COLUMNS},
        missing=PERSON_COLUMNS,
        hot=hot,
    )
    filled = linked.withColumn(
        "discipline", F.coalesce("discipline", F.lit(V.UNKNOWN_DISCIPLINE))
    ).withColumn("session", F.coalesce("session", term_start(F.col("journee"))))
    return conform(filled, "sessions_ordinateurs")


def build_computer_sessions(staging, persons, synonyms, current, salts):
    """Sessions merged into the current ones. Re-delivered sessions are derived anew, and
    older ones that lack person columns are looked up again."""
    merged = upsert(
        current,
        computer_source(staging, salts),
        KEY,
        update=("journee", "lieu", "duree"),
        reset=("session", *PERSON_COLUMNS),
    )
    # Hot accounts are counted in both tables rather than in their merger; half the
    # share in one of them is reached by any account that has the share in the whole.
    hot = (
        hot_keys(staging, "Utilisateur_Login", HOT_SHARE / 2)
        .select(pseudonymize(F.col("Utilisateur_Login"), salts).alias("usager"))
        .union(hot_keys(current, "usager", HOT_SHARE / 2))
        .distinct()
    )
    return G.Build(
        refresh_sessions(merged, persons, synonyms, salts, hot),
        computer_gates(staging, synonyms, salts),
    )


def waiting_pairs(sessions):
    """Accounts and days of sessions that lack a person column: (usager, journee)."""
    lacking = reduce(or_, [F.col(c).isNull() for c in PERSON_COLUMNS])
    return sessions.filter(lacking & F.col("usager").isNotNull()).select("usager", "journee").distinct()


def changed_persons(persons, seen):
    """Persons that are new, or have other columns than in an earlier version of the table."""
    names = ["usager", *PERSON_COLUMNS]
    before = seen.select(*[F.col(c).alias(f"_old_{c}") for c in names])
    same = [F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in PERSON_COLUMNS]
    match = reduce(and_, same, F.col("usager") == F.col("_old_usager"))
    return persons.join(before, match, "left_anti")


def days_to_refresh(waiting, persons, salts):
    """Days with a session that waits for one of these persons.

    Both sides are small against the sessions: an account has one pair a day, however many
    sessions, and persons are only those that have changed.
    """
    known = unique_persons(persons, "usager", salts).select("usager")
    return waiting.join(known, "usager", "left_semi").select("journee").distinct()
