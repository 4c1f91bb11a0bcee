"""The daily run: every domain for one day, each on its own."""

import logging
import threading
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark import InheritableThread
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lutrin.functions.dates import day_of, parse_instant
from lutrin.operators.gates import Gate, GateFailure, contract_gates, run_gates
from lutrin.plans.bookings import SOURCE_KEY_DDL, build_bookings, merge_bookings
from lutrin.plans.computers import (
    build_computer_sessions,
    changed_persons,
    computer_gates,
    computer_source,
    days_to_refresh,
    waiting_pairs,
)
from lutrin.plans.loans import build_loans, loan_gates
from lutrin.plans.people import (
    add_day,
    build_snapshot,
    build_staff,
    build_students,
    refresh_stats,
    write_people,
)
from lutrin.plans.traffic import build_traffic
from lutrin.plans.trainings import build_events, build_registrations
from lutrin.schemas import LINKS, PEOPLE, TABLES, WAITING
from lutrin.sources.daily_files import stale_files
from lutrin.sources.delimited import (
    load_staging,
    normalize_loan_dates,
    stamp_day,
    to_table_types,
)
from lutrin.sources.fixed_width import read_staff, read_students
from lutrin.sources.json_pages import read_bookings, read_events, read_registrations
from lutrin.warehouse import days_in

log = logging.getLogger(__name__)


def yesterday():
    return (date.today() - timedelta(days=1)).isoformat()


@dataclass
class Result:
    domain: str
    done: bool
    gates: list = field(default_factory=list)
    error: str = ""


@dataclass(frozen=True)
class Run:
    """What the domains of one run share.

    `inputs` maps input names to paths or, for counters, computers and loans, to
    DataFrames. `multiline` allows line breaks in the text of delimited files, which
    costs two more scans of them. People files not changed on the day `fresh_on` stop their domain.
    """

    warehouse: object
    inputs: dict
    lookups: object
    salts: object
    day: str = field(default_factory=yesterday)
    home: str = ""
    snapshot: bool = False
    fresh_on: str = ""
    multiline: bool = False

    @property
    def spark(self):
        return self.warehouse.spark

    def persons(self, key="usager"):
        """The person table, bucketed by the key that facts are linked by."""
        copies = {k: name for name, k in LINKS.items()}
        return self.warehouse.read_state(copies.get(key, PEOPLE))

    def check(self, gates):
        return run_gates(gates, self.warehouse.reports_path())


def _load(run, name, source):
    """Staging rows of a file, or of a DataFrame with the columns of such a file in order."""
    given = run.inputs[source]
    if isinstance(given, DataFrame):
        rows = to_table_types(given.toDF(*TABLES[name].loaded), name)
    else:
        rows = load_staging(run.spark, name, given, multiline="split" if run.multiline else False)
    if name == "_tmp_emprunts":
        rows = normalize_loan_dates(rows)
    return run.warehouse.stage(name, rows)


def run_people(run):
    files = [run.inputs["students"], run.inputs["staff"]]
    checks = []
    if run.fresh_on:
        checks = run.check([Gate("people: stale files", stale_files(run.spark, files, run.fresh_on))])
    students = run.warehouse.stage(
        "_tmp_etudiants", stamp_day(read_students(run.spark, files[0]), run.day)
    )
    staff = run.warehouse.stage(
        "_tmp_personnel", stamp_day(read_staff(run.spark, files[1]), run.day)
    )
    student_build = build_students(students, run.lookups, run.salts)
    staff_build = build_staff(staff, students, run.lookups, run.salts)
    checks += run.check(
        student_build.gates
        + contract_gates(students, "_tmp_etudiants", key=False)
        + contract_gates(staff, "_tmp_personnel", key=False)
    )
    # Only buckets of delivered persons change. A snapshot needs the rows of the day of all others, too.
    warehouse = run.warehouse
    delivered = student_build.rows.select("usager").union(staff_build.rows.select("usager"))
    touched = warehouse.buckets_of(PEOPLE, delivered)
    before = warehouse.read_buckets(PEOPLE, touched)
    today, dim = add_day(before, student_build.rows, staff_build.rows, run.day)
    with warehouse.commit():
        if run.snapshot:
            everyone = warehouse.read_state(PEOPLE)
            today, _ = add_day(everyone, student_build.rows, staff_build.rows, run.day)
            checks += warehouse.write_day("clientele", build_snapshot(today, run.day), run.day)
            refresh_stats(warehouse, run.lookups.disciplines, [run.day])
        checks += write_people(warehouse, before, dim, touched)
    return checks


def run_bookings(run):
    pages, complete = read_bookings(run.spark, run.inputs["bookings"])
    checks = run.check([complete])
    staging = run.warehouse.stage(
        "_tmp_reservations", to_table_types(pages, "_tmp_reservations")
    )
    build = build_bookings(staging, run.persons("courriel"), run.lookups, run.salts, keyed=True)
    checks += run.check(build.gates + contract_gates(staging, "_tmp_reservations"))
    days = days_in(staging.select(day_of(F.col("fromDate")).alias("journee")))
    current = run.warehouse.read_days("reservations", days, SOURCE_KEY_DDL)
    checks += run.warehouse.write_days("reservations", merge_bookings(current, build.rows))
    return checks


def run_events(run):
    answers, whole = read_events(run.spark, run.inputs["events"])
    events = run.warehouse.stage("_tmp_evenements", to_table_types(answers, "_tmp_evenements"))
    registrations, tagged = read_registrations(run.spark, run.inputs["registrations"])
    before = run.warehouse.read_state("evenements")
    build = build_events(events, registrations, before)
    checks = run.check(
        [whole, tagged] + build.gates + contract_gates(events, "_tmp_evenements", key=False)
    )
    checks += run.warehouse.write_state("evenements", build.rows)
    return checks


def run_registrations(run):
    rows, tagged = read_registrations(run.spark, run.inputs["registrations"])
    staging = run.warehouse.stage("_tmp_inscriptions", rows)
    before = run.warehouse.read_state("inscriptions")
    build = build_registrations(staging, run.persons("courriel"), before, run.salts)
    checks = run.check(
        [tagged] + build.gates + contract_gates(staging, "_tmp_inscriptions", key=False)
    )
    checks += run.warehouse.write_state("inscriptions", build.rows)
    return checks


def run_traffic(run):
    entries = _load(run, "_tmp_frequentation", "entries")
    occupancy = _load(run, "_tmp_occupation", "occupancy")
    days = days_in(entries.select(F.col("Date").cast("date").alias("journee")))
    current = run.warehouse.read_days("frequentation", days)
    build = build_traffic(entries, occupancy, run.lookups.synonymes, current)
    checks = run.check(
        build.gates
        + contract_gates(entries, "_tmp_frequentation")
        + contract_gates(occupancy, "_tmp_occupation")
    )
    checks += run.warehouse.write_days("frequentation", build.rows)
    return checks


def run_computers(run):
    staging = _load(run, "_tmp_sessions_ordinateurs", "computers")
    persons, synonyms = run.persons(), run.lookups.synonymes
    checks = run.check(
        computer_gates(staging, synonyms, run.salts)
        + contract_gates(staging, "_tmp_sessions_ordinateurs")
    )
    # What waits for a person is kept beside the sessions, and only persons that changed since
    # this domain last ran can end the wait: the history is read once, on the first run.
    warehouse = run.warehouse
    if warehouse.has_state(WAITING):
        waiting = warehouse.read_state(WAITING)
    else:
        waiting = waiting_pairs(warehouse.read("sessions_ordinateurs"))
    seen = warehouse.read_pinned(PEOPLE, "computers")
    changed = persons if seen is None else changed_persons(persons, seen)
    days = set(days_in(computer_source(staging, run.salts)))
    days = sorted(days | set(days_in(days_to_refresh(waiting, changed, run.salts))))
    touched = warehouse.read_days("sessions_ordinateurs", days)
    build = build_computer_sessions(staging, persons, synonyms, touched, run.salts)
    with warehouse.commit():
        checks += warehouse.write_days("sessions_ordinateurs", build.rows)
        left = waiting.filter(~F.col("journee").isin(*days)) if days else waiting
        now = waiting_pairs(warehouse.read_days("sessions_ordinateurs", days))
        checks += warehouse.write_state(WAITING, left.union(now))
    warehouse.pin(PEOPLE, "computers")
    return checks


def run_loans(run):
    staging = _load(run, "_tmp_emprunts", "loans")
    persons, synonyms = run.persons("codebarres"), run.lookups.synonymes
    checks = run.check(
        loan_gates(staging, synonyms, run.home) + contract_gates(staging, "_tmp_emprunts")
    )
    days = days_in(staging.select(day_of(parse_instant(F.col("date"))).alias("journee")))
    touched = run.warehouse.read_days("emprunts", days)
    build = build_loans(staging, persons, synonyms, touched, run.home, run.salts)
    checks += run.warehouse.write_days("emprunts", build.rows)
    return checks


# Domain -> the inputs it needs and its run. Event counts and registrations both
# read the registrations of the same day.
DOMAINS = {
    "people": (("students", "staff"), run_people),
    "bookings": (("bookings",), run_bookings),
    "events": (("events", "registrations"), run_events),
    "registrations": (("registrations",), run_registrations),
    "traffic": (("entries", "occupancy"), run_traffic),
    "computers": (("computers",), run_computers),
    "loans": (("loans",), run_loans),
}


# Domains that read what another one of the same run writes.
AFTER = {name: ("people",) for name in ("bookings", "registrations", "computers", "loans")}


STAGED = {
    "people": ("_tmp_etudiants", "_tmp_personnel", "_clientele_modifiee"),
    "bookings": ("_tmp_reservations",),
    "events": ("_tmp_evenements",),
    "registrations": ("_tmp_inscriptions",),
    "traffic": ("_tmp_frequentation", "_tmp_occupation"),
    "computers": ("_tmp_sessions_ordinateurs",),
    "loans": ("_tmp_emprunts",),
}


def _run_domain(run, name, step):
    try:
        result = Result(name, True, step(run))
        run.warehouse.clear_staging(*STAGED[name])
        return result
    except GateFailure as failure:  # names, counts and report paths; no violating row
        log.error("%s stopped by its gates: %s", name, failure)
        return Result(name, False, failure.results, str(failure))
    except Exception as error:  # a broken source must not stop the other domains
        log.error("%s failed: %s", name, error)
        return Result(name, False, [], str(error))


def run_daily(run, domains=None, at_once=4, stop_dependents=False):
    """Run the domains whose inputs are given, up to `at_once` of them side by side.

    A domain starts when those it reads from have ended; the others don't wait for each other,
    and each has its own pool of the fair scheduler. A domain that fails does not stop the
    others: those that link to persons then take the persons known before, or with
    `stop_dependents` are left out. A domain merges into what earlier runs left, whatever their
    day, so deliveries of a day add up, a repeated one changes nothing, and a late one does not
    undo later days. Staging of a domain is removed once it has succeeded.
    """
    chosen = {
        name: step
        for name, (needed, step) in DOMAINS.items()
        if (not domains or name in domains) and set(needed) <= set(run.inputs)
    }
    ended = {name: threading.Event() for name in chosen}
    room = threading.Semaphore(max(1, at_once))
    results = {}

    def work(name):
        try:
            before = [other for other in AFTER.get(name, ()) if other in chosen]
            for other in before:
                ended[other].wait()
            failed = [other for other in before if not results[other].done]
            if stop_dependents and failed:
                results[name] = Result(name, False, [], f"not run: {', '.join(failed)} failed")
                return
            with room:
                run.spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
                results[name] = _run_domain(run, name, chosen[name])
        finally:
            results.setdefault(name, Result(name, False, [], "its thread ended early"))
            ended[name].set()

    threads = [InheritableThread(target=work, args=(name,), name=f"lutrin-{name}") for name in chosen]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    return {name: results[name] for name in chosen}
