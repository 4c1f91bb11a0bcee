"""Domains side by side, statistics that add up, gates counted while writing, files loaded once."""

import threading
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

import landing
from conftest import rows
from lutrin.operators.gates import GateFailure, Watch, contract_gates, run_gates
from lutrin.plans import daily, people
from lutrin.plans.backfill import backfill_people
from lutrin.plans.daily import Run, run_daily
from lutrin.plans.loans import loan_gates
from lutrin.plans.lookup_tables import load_lookups
from lutrin.schemas import COUNTS, LEDGER, PEOPLE, conform
from lutrin.warehouse import Warehouse


@pytest.fixture(scope="module")
def lookups(spark, tmp_path_factory):
    return load_lookups(spark, landing.write_lookups(tmp_path_factory.mktemp("lookups")))


# ---- domains


def fake(monkeypatch, steps):
    monkeypatch.setattr(daily, "DOMAINS", {name: ((), step) for name, step in steps.items()})
    monkeypatch.setattr(daily, "STAGED", {name: ("none",) for name in steps})
    monkeypatch.setattr(daily, "AFTER", {"second": ("first",), "third": ("first",)})


def run_of(spark, tmp_path):
    return Run(Warehouse(spark, str(tmp_path)), {}, None, None)


def test_independent_domains_overlap_and_dependent_ones_wait(spark, tmp_path, monkeypatch):
    both, seen = threading.Barrier(2, timeout=20), []

    def meet(run):
        both.wait()  # only passes if two domains run at once
        seen.append(run.spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
        return []

    def after(run):
        assert "first" in seen
        seen.append("after")
        return []

    fake(monkeypatch, {"first": meet, "other": meet, "second": after, "third": after})
    results = run_daily(run_of(spark, tmp_path))
    assert list(results) == ["first", "other", "second", "third"] and all(r.done for r in results.values())
    assert set(seen[:2]) == {"first", "other"} and seen[2:] == ["after"] * 2


@pytest.mark.parametrize("stop", [False, True])
def test_a_failed_domain_stops_only_what_depends_on_it(spark, tmp_path, monkeypatch, stop):
    def fail(run):
        raise ValueError("broken")

    fake(monkeypatch, {"first": fail, "second": lambda run: [], "other": lambda run: []})
    results = run_daily(run_of(spark, tmp_path), stop_dependents=stop)
    assert not results["first"].done and results["other"].done
    assert results["second"].done is not stop


def test_no_more_domains_at_once_than_allowed(spark, tmp_path, monkeypatch):
    running, most = [], []

    def step(run):
        running.append(1)
        most.append(len(running))
        time.sleep(0.2)
        running.pop()
        return []

    fake(monkeypatch, {name: step for name in "abcde"})
    run_daily(run_of(spark, tmp_path), at_once=2)
    assert max(most) == 2


# ---- gates in the pass that writes


def jobs_of(spark, work):
    """How many jobs `work` starts."""
    context, group = spark.sparkContext, f"count-{time.time()}"
    context.setJobGroup(group, "count")
    try:
        result = work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return len(context.statusTracker().getJobIdsForGroup(group)), result


def loans(spark, dates, cote="c"):
    table = spark.createDataFrame([("d", cote, "p", "u", d, "b", "i", "j") for d in dates], "cb_document string, cote string, bibliotheque_pret string, cb_usager string, date string, bibliotheque_document string, institution_doc string, institution_usager string")
    return table


def test_gates_of_rows_take_no_job_of_their_own(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    staged = warehouse.stage("_tmp_emprunts", loans(spark, ["2024-01-10 08:00:00", "", None]))
    assert staged.seen == {"_tmp_emprunts: text length": 0, "loans: impossible dates": 0, "loans: odd dates": 0}
    gates = contract_gates(staged, "_tmp_emprunts") + [g for g in loan_gates(staged, spark.createDataFrame([], "domaine string, rejeter string, accepter string"), "x") if "dates" in g.name]
    jobs, results = jobs_of(spark, lambda: run_gates(gates))
    assert jobs == 0 and [r.count for r in results] == [0, 0, 0]


def test_gates_that_saw_something_count_and_report(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    staged = warehouse.stage("_tmp_emprunts", loans(spark, ["2024-01-10 08:00:00.5", "2024-13-45 08:00:00"], "c" * 300))
    assert staged.seen["_tmp_emprunts: text length"] == 2 and staged.seen["loans: odd dates"] >= 1
    with pytest.raises(GateFailure) as failure:
        run_gates(contract_gates(staged, "_tmp_emprunts"), str(tmp_path / "reports"))
    assert [(r.name, r.count) for r in failure.value.results] == [("_tmp_emprunts: text length", 2)]
    names = spark.createDataFrame([], "domaine string, rejeter string, accepter string")
    watched = {g.name: g.violations.count() for g in loan_gates(staged, names, "x") if "dates" in g.name}
    assert {name: bool(staged.seen[name]) for name in watched} == {name: n > 0 for name, n in watched.items()}


def test_watching_nothing_and_no_rows(spark, tmp_path):
    assert Watch(spark.range(3), {}).seen() == {}
    staged = Warehouse(spark, str(tmp_path)).stage("_tmp_emprunts", loans(spark, ["x"]).filter("false"))
    assert set(staged.seen.values()) == {0}


# ---- statistics


def snapshot(spark, day, n):
    rows_ = [(day, f"u{i}", "Étudiant" if i % 3 else "Personnel", "n", f"D{1 + i % 2}", day[:8] + "01") for i in range(n)]
    return conform(spark.createDataFrame(rows_, "journee string, usager string, fonction string, niveau string, discipline string, session string"), "clientele")


def test_statistics_add_up_and_read_the_new_snapshot_alone(spark, tmp_path, lookups, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    for day, n in (("2024-01-05", 20), ("2024-05-05", 31)):
        warehouse.write_day("clientele", snapshot(spark, day, n), day)
    people.refresh_stats(warehouse, lookups.disciplines, ["2024-05-05"])  # both were never counted

    def whole():
        return rows(people.discipline_stats(warehouse.read("clientele"), lookups.disciplines))

    assert rows(warehouse.read("disciplines_stats")) == whole() != []
    warehouse.write_day("clientele", snapshot(spark, "2024-09-05", 44), "2024-09-05")
    read, days = Warehouse.read_days, []
    monkeypatch.setattr(Warehouse, "read_days", lambda self, name, d, extra="": days.append((name, list(d))) or read(self, name, d, extra))
    plain = Warehouse.read
    monkeypatch.setattr(Warehouse, "read", lambda self, name, extra="": plain(self, name, extra) if name != "clientele" else pytest.fail("all snapshots are read"))
    people.refresh_stats(warehouse, lookups.disciplines, [date(2024, 9, 5)])
    assert days == [("clientele", ["2024-09-05"])]
    monkeypatch.setattr(Warehouse, "read", plain)
    assert rows(warehouse.read("disciplines_stats")) == whole()
    # a snapshot that is replaced, and one that goes
    warehouse.write_day("clientele", snapshot(spark, "2024-05-05", 7), "2024-05-05")
    warehouse.write_day("clientele", snapshot(spark, "2024-01-05", 0), "2024-01-05")
    people.refresh_stats(warehouse, lookups.disciplines, ["2024-05-05"])
    assert rows(warehouse.read("disciplines_stats")) == whole()
    assert {str(r.journee) for r in warehouse.read(COUNTS).collect()} == {"2024-05-05", "2024-09-05"}
    # a snapshot of employees alone has no counts
    only = snapshot(spark, "2024-05-05", 7).withColumn("fonction", F.lit("Personnel"))
    warehouse.write_day("clientele", only, "2024-05-05")
    people.refresh_stats(warehouse, lookups.disciplines, ["2024-05-05"])
    assert rows(warehouse.read("disciplines_stats")) == whole()


# ---- the ledger of loaded files


def test_each_file_is_loaded_once(spark, tmp_path, lookups, salts, monkeypatch):
    folder = tmp_path / "in"
    for day in ("20240102", "20240103"):
        landing.write_students(folder / f"synchro_ac.TXT.{day}", landing.STUDENTS)
        landing.write_staff(folder / f"synchro_rh.txt.{day}", landing.STAFF)
    landing.write_students(folder / "synchro_ac.TXT.20240104", landing.STUDENTS)  # its staff file is late
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    left = backfill_people(warehouse, str(folder), lookups, salts)
    assert [reason for _, reason in left] == ["sans personnel"]
    assert warehouse.read_state(LEDGER).count() == 5
    first = rows(warehouse.read_state(PEOPLE))
    commits = warehouse.last_commit()
    opened = []
    from lutrin.plans import backfill

    for name in ("read_student_directory", "read_staff_directory"):
        real = getattr(backfill, name)
        monkeypatch.setattr(backfill, name, lambda s, d, files, real=real: opened.extend(f.split("/")[-1] for f in files) or real(s, d, files))
    assert backfill_people(Warehouse(spark, str(tmp_path / "w")), str(folder), lookups, salts) == []
    assert opened == [] and warehouse.last_commit() == commits and rows(warehouse.read_state(PEOPLE)) == first
    # the late file brings its day, a changed one is loaded anew
    landing.write_staff(folder / "synchro_rh.txt.20240104", landing.STAFF)
    landing.write_students(folder / "synchro_ac.TXT.20240103", landing.STUDENTS + [("b9", "1DROI", "1", "x", "p9@example.org", "etu9")])
    assert backfill_people(warehouse, str(folder), lookups, salts) == []
    assert sorted(opened) == [f"synchro_{kind}.2024010{d}" for kind in ("ac.TXT", "rh.txt") for d in (3, 4)]
    state = warehouse.read_state(PEOPLE).collect()
    assert len(state) == len(first) + 1 and {str(r.journee) for r in state} == {"2024-01-02", "2024-01-03"}
    ledger = {r.chemin.split("/")[-1]: r.raison for r in warehouse.read_state(LEDGER).collect()}
    assert len(ledger) == 6 and set(ledger.values()) == {None}
    opened.clear()
    backfill_people(warehouse, str(folder), lookups, salts, again=True)
    assert len(opened) == 6
