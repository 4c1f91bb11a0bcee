"""Backfill of the person table from a directory of daily files, in one pass.

The day is a column, so all days are built side by side. The result is that of
loading the days one after the other, because in the end only the latest row of
each person stays.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lutrin import values as V
from lutrin.operators.gates import contract_gates, run_gates, write_report
from lutrin.plans.people import (
    build_snapshot,
    build_staff,
    build_students,
    latest_people,
    merge_people,
    refresh_stats,
    write_people,
)
from lutrin.schemas import LEDGER, PEOPLE, conform, empty_table
from lutrin.sources.daily_files import (
    files_to_load,
    one_sided_days,
    people_files,
    read_staff_directory,
    read_student_directory,
)

FAILED = "contrôles"


@dataclass(frozen=True)
class Backfill:
    people: DataFrame
    snapshots: DataFrame


def days_left_out(students, staff, lookups, salts):
    """Days that fail a gate or lack one of the two files: (journee, raison).

    At most three rows per calendar day.
    """
    gated = build_students(students, lookups, salts, by=["journee"])
    failed = reduce(
        DataFrame.unionByName, [g.violations.select("journee") for g in gated.gates]
    ).distinct()
    return failed.withColumn("raison", F.lit(FAILED)).union(one_sided_days(students, staff))


def build_backfill(students, staff, lookups, salts, current, left_out=()):
    """People and snapshots of all days but those left out, a list of dates.

    The list is no longer than the calendar; as a filter it reaches the scan of staged rows.
    """

    def kept(rows):
        return rows.filter(~F.col("journee").isin(*left_out)) if left_out else rows

    students, staff = kept(students), kept(staff)
    merged = merge_people(
        current,
        build_students(students, lookups, salts).rows,
        build_staff(staff, students, lookups, salts).rows,
    )
    # Snapshots are those of the days that were loaded, not of people known before.
    new_days = F.broadcast(students.select("journee").distinct())
    snapshots = build_snapshot(merged.join(new_days, "journee", "left_semi"))
    return Backfill(latest_people(merged), snapshots)


def backfill_people(warehouse, directory, lookups, salts, snapshot=False, again=False):
    """Read, build and write; returns the days left out, as (journee, raison) rows.

    A ledger keeps which files were loaded, with their size and time; only days with a new or
    changed file are read, or all days if `again`. It is written in the commit that makes
    their rows readable, so each file is loaded once however often a run dies. Parsed files
    are staged once, the days to leave out are found and written once. With `snapshot` the
    term statistics follow. People join the latest state, so days before it only add
    persons that it lacks.
    """
    spark = warehouse.spark
    ledger = warehouse.read_state(LEDGER)
    listed = people_files(spark, directory)
    chosen = listed if again else files_to_load(listed, ledger)
    chosen = warehouse.stage("_fichiers_a_charger", chosen.coalesce(1))
    files = chosen.collect()  # two files for each day of the calendar
    paths = {kind: [f.chemin for f in files if f.genre == kind] for kind in (V.STUDENT_FILE_START, V.STAFF_FILE_START)}
    if not files:
        warehouse.clear_staging()
        return []

    def rows(read, name, kind):
        if paths[kind]:
            return read(spark, directory, paths[kind])
        return empty_table(spark, name).withColumn("fichier", F.lit(None).cast("string"))

    students = warehouse.stage("_tmp_etudiants", rows(read_student_directory, "_tmp_etudiants", V.STUDENT_FILE_START))
    staff = warehouse.stage("_tmp_personnel", rows(read_staff_directory, "_tmp_personnel", V.STAFF_FILE_START))
    run_gates(
        contract_gates(students, "_tmp_etudiants", key=False)
        + contract_gates(staff, "_tmp_personnel", key=False),
        warehouse.reports_path(),
    )
    left_out = warehouse.stage("_jours_exclus", days_left_out(students, staff, lookups, salts).coalesce(1))
    write_report(left_out, f"{warehouse.reports_path()}/backfill-left-out")
    excluded = [tuple(r) for r in left_out.collect()]  # bounded by the calendar
    before = warehouse.read_state(PEOPLE)
    result = build_backfill(students, staff, lookups, salts, before, sorted({day for day, _ in excluded}))
    why = left_out.groupBy("journee").agg(F.array_join(F.sort_array(F.collect_set("raison")), ", ").alias("raison"))
    loaded = conform(chosen.join(why, "journee", "left"), LEDGER)
    with warehouse.commit():
        if snapshot:
            warehouse.write_days("clientele", result.snapshots)
            days = sorted({f.journee for f in files} - {day for day, _ in excluded})
            refresh_stats(warehouse, lookups.disciplines, days)
        write_people(warehouse, before, result.people)
        warehouse.write_state(LEDGER, ledger.join(loaded.select("chemin"), "chemin", "left_anti").select(*loaded.columns).union(loaded))
    warehouse.clear_staging()
    return sorted(excluded)
