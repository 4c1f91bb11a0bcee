"""People: students and staff, the person table, term snapshots, population statistics."""

from pyspark.sql import functions as F

from lutrin import values as V
from lutrin.functions.dates import term_start
from lutrin.functions.people import (
    programme_of,
    staff_audience,
    staff_function,
    staff_level,
    student_level,
)
from lutrin.functions.privacy import pseudonymize
from lutrin.operators import gates as G
from lutrin.operators.aggregates import population_counts, weigh, weighted_population
from lutrin.operators.filters import drop_retired, without
from lutrin.operators.lookups import lookup, lookup_chain
from lutrin.operators.merge import combine, latest_by, upsert
from lutrin.plans.lookup_tables import with_missing_factors
from lutrin.schemas import COUNTS, LINKS, PEOPLE, conform, spec

# Columns only students, or only staff, bring; the other kind leaves them alone.
OWN_COLUMNS = ("code_programme", "programme", "code_unite", "unite")
SHARED_COLUMNS = (
    "courriel",
    "codebarres",
    "fonction",
    "niveau",
    "discipline",
    "bibliotheque",
    "clientele",
)


def _pseudonyms(salts, login, courriel, codebarres):
    return [
        pseudonymize(F.col(login), salts).alias("usager"),
        pseudonymize(F.col(courriel), salts).alias("courriel"),
        pseudonymize(F.col(codebarres), salts).alias("codebarres"),
    ]


def with_student_discipline(students, lookups):
    """Discipline by second-campus programme, else generic programme, else named programme."""
    generic = lookups.programmes.filter(F.col("nom").isNull())
    named = lookups.programmes.filter(F.col("nom").isNotNull())
    code = programme_of(F.col("codeCycle"))
    return lookup_chain(
        students,
        [
            (lookups.programmes_laval, [("codeProgramme", "codeprogramme")], "discipline"),
            (generic, [(code, "code")], "discipline"),
            (named, [(code, "code"), ("programme", "nom")], "discipline"),
        ],
        "discipline",
    )


def build_students(staging, lookups, salts, by=()):
    """Student rows for the person table. `by` adds columns, such as the day, to gate reports."""
    placed = with_student_discipline(staging, lookups)
    rows = lookup(placed, lookups.disciplines, {"discipline": "discipline"}, "bibliotheque").select(
        "journee",
        *_pseudonyms(salts, "login", "courriel", "codebarres"),
        F.lit(V.STUDENT).alias("fonction"),
        student_level(F.col("codeCycle")).alias("niveau"),
        F.col("codeProgramme").alias("code_programme"),
        "programme",
        "discipline",
        "bibliotheque",
        F.lit(True).alias("clientele"),
    )
    by = list(by)
    return G.Build(
        rows,
        [
            G.Gate("students: key", G.broken_keys(staging, ["journee", "login"])),
            G.Gate("students: unknown cycles", G.unknown_cycles(staging, lookups.cycles, by)),
            G.Gate(
                "students: programmes without discipline",
                G.unresolved(
                    placed, "discipline", [*by, "codeCycle", "codeProgramme", "programme"]
                ).orderBy("codeCycle"),
            ),
            G.Gate(
                "students: undefined disciplines",
                G.unmatched(
                    placed.filter(F.col("discipline").isNotNull()),
                    "discipline",
                    lookups.disciplines,
                    by,
                ),
            ),
        ],
    )


def active_staff(staging, students):
    """Staff still employed, one row per login and day (the last in the file), not students."""
    employed = drop_retired(staging).filter(F.col("Login").isNotNull())
    single = latest_by(employed, ["journee", "Login"], [F.desc("id")])
    logins = students.select("journee", F.col("login").alias("Login"))
    return without(single, logins, ["journee", "Login"])


def build_staff(staging, students, lookups, salts):
    """Staff rows for the person table. An unknown unit gives a missing discipline."""
    staff = active_staff(staging, students)
    placed = lookup(staff, lookups.unites, {"CodeUnite": "code"}, "discipline")
    rows = lookup(placed, lookups.disciplines, {"discipline": "discipline"}, "bibliotheque").select(
        "journee",
        *_pseudonyms(salts, "Login", "Courriel", "CodeBarres"),
        staff_function(F.col("Statut")).alias("fonction"),
        staff_level(F.col("Statut")).alias("niveau"),
        F.col("CodeUnite").alias("code_unite"),
        F.col("DescUnite").alias("unite"),
        "discipline",
        "bibliotheque",
        staff_audience(F.col("Statut"), F.col("Fonction")).alias("clientele"),
    )
    return G.Build(rows)


def merge_people(current, students, staff):
    """The person table with the day's people merged in, before older rows are dropped."""
    people = conform(combine(students, staff), "_clientele_cumul")
    merged = upsert(
        current, people, ["journee", "usager"], update=SHARED_COLUMNS, fill=OWN_COLUMNS
    )
    term = term_start(F.col("journee")).cast("string")
    return conform(
        merged.withColumn("session", F.coalesce("session", term)), "_clientele_cumul"
    )


def latest_people(people):
    """Only the latest row of each person."""
    return latest_by(people, ["usager"], [F.desc("journee")])


def update_person_dim(current, students, staff):
    """The person table with people of any days merged in: the latest row of each person.

    A row only meets one of the same person and day, so nothing but the latest day of a
    person on either side can be in the result. Older rows go first, while rows are narrow.
    """
    students, staff = latest_people(students), latest_people(staff)
    return latest_people(merge_people(latest_people(current), students, staff))


def add_day(current, students, staff, day):
    """The person table before and after older rows are dropped, for people of one day.

    Returns the merged rows of the day and the whole new table. Only rows of that
    day can meet the day's people, so only they go through the merge; the rest of
    the table is shuffled once, by person.
    """
    same_day = F.col("journee") == F.lit(str(day)).cast("date")
    today = merge_people(current.filter(same_day), students, staff)
    return today, latest_people(current.filter(~same_day).unionByName(today))


def changed_links(before, after):
    """Persons whose link columns differ between two states: usager, and of each side the columns (`_old_`, `_new_`)."""
    names = spec(next(iter(LINKS))).schema.names
    old = before.select(*[F.col(c).alias(f"_old_{c}") for c in names])
    new = after.select(*[F.col(c).alias(f"_new_{c}") for c in names])
    both = old.join(new, F.col("_old_usager") == F.col("_new_usager"), "full_outer")
    same = F.lit(True)
    for c in names:
        same = same & F.col(f"_old_{c}").eqNullSafe(F.col(f"_new_{c}"))
    return both.filter(~same).withColumn("usager", F.coalesce("_old_usager", "_new_usager"))


def write_people(warehouse, before, after, numbers=None):
    """Replace some buckets of the person table (all by default), and follow up in its copies by link key.

    `before` and `after` are all rows of these buckets. In the copies only the buckets of keys
    that a changed person had or has are rewritten.
    """
    with warehouse.commit():
        changed = warehouse.stage("_clientele_modifiee", changed_links(before, after))
        checks = warehouse.write_buckets(PEOPLE, after, numbers)
        for name, key in LINKS.items():
            new = changed.select(*[F.col(f"_new_{c}").alias(c) for c in spec(name).schema.names]).filter(F.col(key).isNotNull())
            keys = changed.select(F.col(f"_old_{key}").alias(key)).union(new.select(key)).filter(F.col(key).isNotNull())
            touched = warehouse.buckets_of(name, keys)
            if not touched:
                continue
            kept = warehouse.read_buckets(name, touched).join(changed.select("usager"), "usager", "left_anti")
            checks += warehouse.write_buckets(name, conform(kept, name).unionByName(conform(new, name)), touched)
    return checks


def build_snapshot(people, day=None):
    """The audience of a day, or of every day present."""
    rows = people.filter(F.col("clientele"))
    if day is not None:
        rows = rows.filter(F.col("journee") == F.lit(str(day)).cast("date"))
    return conform(rows, "clientele")


def discipline_stats(snapshots, disciplines):
    """Weighted population over all snapshots, sorted in each output file."""
    return sorted_stats(weighted_population(snapshots, disciplines, V.EMPLOYEE))


def sorted_stats(stats):
    return conform(stats, "disciplines_stats").sortWithinPartitions(
        "discipline", "bibliothecaire", "fonction", "niveau", "bibliotheque", "secteur", "session"
    )


def refresh_stats(warehouse, disciplines, days):
    """The statistics table anew, from people counted per snapshot.

    Only the snapshots of `days`, and of days that were never counted, are read; a day whose
    snapshot is gone loses its counts. The others add up from their counts.
    """
    def folders(name):
        return {p.removeprefix("journee=") for p in warehouse.entries(name)}

    snapshots, counted = folders("clientele"), folders(COUNTS)
    fresh = sorted((snapshots - counted) | ({str(d) for d in days} & snapshots))
    with warehouse.commit():
        for day in counted & ({*fresh} | (counted - snapshots)):
            warehouse.drop_day(COUNTS, day)
        if fresh:
            people = warehouse.read_days("clientele", fresh)
            warehouse.write_days(COUNTS, conform(population_counts(people, V.EMPLOYEE, ["journee"]), COUNTS))
        stats = weigh(warehouse.read(COUNTS), with_missing_factors(disciplines))
        warehouse.overwrite("disciplines_stats", sorted_stats(stats))
