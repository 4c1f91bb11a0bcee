from dataclasses import replace
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import landing
from conftest import rows
from lutrin.functions.privacy import pseudonymize
from lutrin.operators.gates import GateFailure, run_gates
from lutrin.plans import backfill, bookings, computers, loans, people, traffic, trainings
from lutrin.plans.daily import Run, run_daily
from lutrin.plans.lookup_tables import load_lookups
from lutrin.schemas import TABLES, DOMAINS, conform, empty_table
from lutrin.sources.delimited import extract_loans, load_staging, stamp_day, to_table_types
from lutrin.sources.fixed_width import read_staff, read_students
from lutrin.sources.json_pages import read_bookings
from lutrin.warehouse import Warehouse

DAY = "2024-01-10"


@pytest.fixture(scope="module")
def lookups(spark, tmp_path_factory):
    return load_lookups(spark, landing.write_lookups(tmp_path_factory.mktemp("lookups")))


@pytest.fixture(scope="module")
def names(spark, salts):
    """Readable names for pseudonyms."""
    known = [r for p in landing.STUDENTS for r in (p[0], p[4], p[5])]
    known += [r for p in landing.STAFF for r in (p[3], p[4], p[6])]
    known += ["", "nobody@example.org", "invite", "zzz", "p9@example.org", "etu9", "b9"]
    df = spark.createDataFrame([(k,) for k in set(known)], "k string")
    return {r[1]: r[0] for r in df.select("k", pseudonymize(F.col("k"), salts)).collect()} | {None: None}


def test_contract_covers_every_table(spark):
    assert len(TABLES) == 26
    assert sorted(n for names in DOMAINS.values() for n in names) == sorted(TABLES)
    assert empty_table(spark, "emprunts").columns == TABLES["emprunts"].schema.names


# ---- people


def stage(spark, tmp_path, students=landing.STUDENTS, staff=landing.STAFF):
    return (
        stamp_day(read_students(spark, landing.write_students(tmp_path / "ac.txt", students)), DAY),
        stamp_day(read_staff(spark, landing.write_staff(tmp_path / "rh.txt", staff)), DAY),
    )


def test_students(spark, tmp_path, lookups, salts, names):
    staged, _ = stage(spark, tmp_path)
    built = people.build_students(staged, lookups, salts)
    run_gates(built.gates)
    got = {names[r.usager]: r for r in built.rows.collect()}
    assert {k: (r.discipline, r.bibliotheque) for k, r in got.items()} == {
        "etu1": ("D1", "B1"),
        "etu2": ("D3", "B9"),  # the generic programme wins over the named one
        "etu3": ("D2", "B2"),
        "etu4": ("D3", "B9"),  # second campus
    }
    assert got["etu3"].niveau == "Étudiant - Certificat" and got["etu3"].clientele is True


def failing_gates(build):
    with pytest.raises(GateFailure) as failure:
        run_gates(build.gates)
    return {r.name: r.count for r in failure.value.results if r.count}


def test_student_gates(spark, tmp_path, lookups, salts):
    bad = landing.STUDENTS + [
        ("b5", "9DROI", "1", "x", "", "etu5"),
        ("b6", "1ZZZZ", "1", "x", "", "etu6"),
        ("b7", "1DROI", "1", "x", "", "etu1"),
    ]
    built = people.build_students(stage(spark, tmp_path, students=bad)[0], lookups, salts)
    assert failing_gates(built) == {
        "students: key": 1, "students: unknown cycles": 1, "students: programmes without discipline": 1,
    }


def test_blank_discipline_passes_one_gate_and_stops_at_the_next(spark, tmp_path, lookups, salts):
    blank = lookups.programmes.withColumn(
        "discipline", F.when(F.col("code") == "DROI", "").otherwise(F.col("discipline"))
    )
    built = people.build_students(
        stage(spark, tmp_path)[0], replace(lookups, programmes=blank), salts
    )
    assert failing_gates(built) == {"students: undefined disciplines": 1}


def test_staff(spark, tmp_path, lookups, salts, names):
    students, staff = stage(spark, tmp_path)
    got = {
        names[r.usager]: (names[r.courriel], r.fonction, r.niveau, r.discipline, r.bibliotheque, r.clientele)
        for r in people.build_staff(staff, students, lookups, salts).rows.collect()
    }
    prof, charge = "Professeur", "Chargé de cours"
    assert got == {
        "prof1": ("s1@example.org", prof, prof, "D1", "B1", True),
        "prof2": ("s2@example.org", prof, prof, "D1", "B1", False),
        "charge1": ("s3@example.org", charge, charge, "D2", "B2", True),
        "pers1": ("s4@example.org", "Personnel", None, None, None, False),
        "double": ("new@example.org", "Personnel", None, "D2", "B2", False),
        "autre1": ("z@example.org", None, None, "D1", "B1", None),
    }


def test_same_day_reload_keeps_what_it_does_not_list(spark):
    def person(**values):
        row = {"journee": date(2024, 1, 1), "usager": "u"} | values
        return conform(
            spark.createDataFrame([row], ", ".join(
                f"{k} {'date' if k == 'journee' else 'boolean' if k == 'clientele' else 'string'}" for k in row
            )), "_clientele_cumul",
        )

    current = person(code_unite="U", unite="N", discipline="old", session="kept", code_programme="old")
    student = person(discipline=None, code_programme="P", programme="X").drop("code_unite", "unite")
    nobody = empty_table(spark, "_clientele_cumul").drop("code_programme", "programme")
    row = people.merge_people(current, student, nobody).first()
    assert (row.code_unite, row.unite, row.discipline, row.session, row.code_programme) == ("U", "N", None, "kept", "P")


def test_adding_a_day_equals_the_whole_merge(spark, tmp_path, lookups, salts):
    students, staff = stage(spark, tmp_path)
    new = (
        people.build_students(students, lookups, salts).rows,
        people.build_staff(staff, students, lookups, salts).rows,
    )
    older = people.update_person_dim(empty_table(spark, "_clientele_cumul"), *new)
    shifted = older.withColumn("journee", F.expr(f"CASE WHEN fonction = 'Personnel' THEN date'{DAY}' ELSE date'2023-09-05' END"))
    current = spark.createDataFrame(shifted.collect(), older.schema)
    _, dim = people.add_day(current, *new, DAY)
    assert rows(dim) == rows(people.update_person_dim(current, *new))


# ---- the daily run


@pytest.fixture(scope="module")
def daily(spark, tmp_path_factory, lookups, salts):
    root = tmp_path_factory.mktemp("daily")
    run = Run(
        Warehouse(spark, str(root / "warehouse")), landing.land_day(root / "landed"), lookups, salts, DAY,
        home="Université exemple", snapshot=True,
    )
    return run, run_daily(run)


def content(warehouse, name):
    state = name in ("_clientele_cumul", "evenements", "inscriptions")
    return rows(warehouse.read_state(name) if state else warehouse.read(name))


FINAL = [
    "_clientele_cumul", "clientele", "disciplines_stats", "reservations", "evenements", "inscriptions",
    "frequentation", "sessions_ordinateurs", "emprunts",
]


def test_daily_run_does_every_domain(daily):
    _, results = daily
    assert {k: r.error for k, r in results.items() if not r.done} == {}
    assert list(results) == ["people", "bookings", "events", "registrations", "traffic", "computers", "loans"]


def test_daily_people(daily, names):
    warehouse = daily[0].warehouse
    dim = {names[r.usager]: r for r in warehouse.read_state("_clientele_cumul").collect()}
    assert len(dim) == 10 and dim["etu1"].session == "2024-01-01" and dim["etu1"].code_unite is None
    assert sorted(names[r.usager] for r in warehouse.read("clientele").collect()) == [
        "charge1", "etu1", "etu2", "etu3", "etu4", "prof1",
    ]
    stats = {
        (r.discipline, r.bibliothecaire, r.fonction, r.niveau): r.nb_personnes
        for r in warehouse.read("disciplines_stats").collect()
    }
    first = ("Étudiant", "Étudiant - 1er cycle")
    assert stats[("D1", "Lib A", *first)] == Decimal("0.5") == stats[("D1", "Lib B", *first)]
    assert sum(stats.values()) == 6


def test_daily_bookings(daily, names):
    got = {r.salle: (names[r.usager], r.discipline, r.bibliotheque) for r in daily[0].warehouse.read("reservations").collect()}
    assert got == {
        "A-1": ("etu1", "D1", "B1"),
        "A-2": (None, "Inconnue", "B2"),
        "A-3": ("pers1", None, "B1"),  # a known person without discipline stays without
        "A-4": (None, "Inconnue", "B1"),  # a blank address links to nobody
    }


def test_daily_events_and_registrations(daily, names):
    warehouse = daily[0].warehouse
    events = {r.id: (r.presentateur, r.nb_participants, str(r.session)) for r in warehouse.read_state("evenements").collect()}
    assert events == {"7": ("Org", 3, "2024-01-01"), "9": ("Ada", 0, "2024-05-01")}
    registrations = {r.id: (names[r.usager], r.discipline) for r in warehouse.read_state("inscriptions").collect()}
    assert registrations == {"1": ("etu2", "D3"), "2": (None, None), "3": (None, None)}


def test_daily_traffic(daily):
    got = {
        (str(r.journee), r.bibliotheque): (r.frequentation, r.occupation)
        for r in daily[0].warehouse.read("frequentation").collect()
    }
    assert got == {
        ("2024-01-10", "B1"): (12, 1),  # two codes of one library; samples summed before the division
        ("2024-01-10", "B2"): (2, -1),  # truncated towards zero
        ("2024-01-11", "B2"): (9, None),
    }


def test_daily_computers(daily, names):
    got = {
        (r.ordinateur, r.dateheure.hour): (names[r.usager], names[r.courriel], r.discipline, r.bibliotheque, r.lieu)
        for r in daily[0].warehouse.read("sessions_ordinateurs").collect()
    }
    assert got == {
        ("PC1", 8): ("etu1", "p1@example.org", "D1", "B1", "B1"),
        ("PC2", 8): ("invite", None, "Inconnue", None, "B2"),
        ("PC2", 10): ("pers1", "s4@example.org", "Inconnue", None, "B2"),
    }


def test_daily_loans(daily, names):
    run, results = daily
    got = {
        r.cb_document: (names[r.usager], r.bibliotheque_pret, r.bibliotheque_document, r.dateheure.hour)
        for r in run.warehouse.read("emprunts").collect()
    }
    outside = "Bibliothèque extérieure"
    assert got == {
        "d1": ("etu1", "B1", "B1", 8),  # delivered twice, kept once
        "d2": ("charge1", outside, outside, 9),
        "d5": ("etu2", "B1", "B1", 9),  # odd date: reported, still loaded
    }
    assert [(r.name, r.count) for r in results["loans"].gates if r.count] == [("loans: odd dates", 1)]


def test_second_run_of_a_day_changes_nothing(daily):
    run, _ = daily
    before = {name: content(run.warehouse, name) for name in FINAL}
    assert all(r.done for r in run_daily(run).values())
    assert {name: content(run.warehouse, name) for name in FINAL} == before


def test_deliveries_of_a_day_add_up(spark, tmp_path, lookups, salts, names):
    """A second, partial delivery of a day, the first once more, and a late day after a newer one."""
    inputs = landing.land_day(tmp_path / "one")
    run = Run(Warehouse(spark, str(tmp_path / "w")), inputs, lookups, salts, DAY)
    wanted = ["people", "bookings", "events", "registrations"]
    assert all(r.done for r in run_daily(run, wanted).values())
    extra = ("b9", "1DROI", "1", "x", "p9@example.org", "etu9")
    second = {
        "students": landing.write_students(tmp_path / "two" / "ac.txt", landing.STUDENTS[:1] + [extra]),
        "staff": landing.write_staff(tmp_path / "two" / "rh.txt", landing.STAFF[:1]),
        "bookings": landing.write_json(
            tmp_path / "two" / "b" / "page-1.json", [landing.booking(1, "p1@example.org"), landing.booking(99, "p9@example.org")]
        ),
        "events": landing.write_json(tmp_path / "two" / "e" / "1.json", {"events": [
            {"id": 20, "title": "Neuf", "start": "2024-01-10T10:00:00-05:00", "end": "2024-01-10T11:00:00-05:00",
             "owner": {"id": 1, "name": "Org"}, "presenter": "Ada"}]}),
        "registrations": landing.write_json(
            tmp_path / "two" / "r" / "event-20.json", [{"registrants": [{"booking_id": 55, "email": "p9@example.org"}]}]
        ),
    }

    def seen():
        w = run.warehouse
        return (
            sorted(names[r.usager] for r in w.read_state("_clientele_cumul").collect()),
            sorted(r.salle for r in w.read("reservations").collect()),
            sorted(r.id for r in w.read_state("evenements").collect()),
            sorted(r.id for r in w.read_state("inscriptions").collect()),
        )

    first = seen()
    assert all(r.done for r in run_daily(replace(run, inputs=second), wanted).values())
    both = (sorted(first[0] + ["etu9"]), ["A-1", "A-2", "A-3", "A-4", "A-99"], ["20", "7", "9"], ["1", "2", "3", "55"])
    assert seen() == both
    assert all(r.done for r in run_daily(run, wanted).values())
    assert seen() == both
    late = replace(run, inputs=second, day="2024-01-09")
    assert run_daily(late, ["people"])["people"].done
    days = {names[r.usager]: str(r.journee) for r in run.warehouse.read_state("_clientele_cumul").collect()}
    assert set(days.values()) == {DAY} and sorted(days) == both[0]


def test_equal_bookings_of_one_delivery_stay(spark, tmp_path, lookups, salts):
    twice = [landing.booking(1, "p1@example.org"), landing.booking(1, "p1@example.org")]
    other = [landing.booking(1, "p1@example.org") | {"fromDate": "2024-01-10T15:00:00-05:00"}]
    inputs = {"bookings": landing.write_json(tmp_path / "b" / "page-1.json", twice + other)}
    run = Run(Warehouse(spark, str(tmp_path / "w")), inputs, lookups, salts, DAY)
    for _ in range(2):
        assert run_daily(run)["bookings"].done
        assert run.warehouse.read("reservations").count() == 3


def test_states_are_read_from_one_version(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    for n in range(1, 5):
        warehouse.write_state("evenements", conform(spark.sql(f"SELECT '{n}' AS id"), "evenements"))
    state = warehouse.read_state("evenements")
    assert [r.id for r in state.collect()] == ["4"]
    assert all("version=4" in f for f in state.inputFiles())
    assert sorted(name for name, _ in warehouse.versions("evenements")) == ["version=3", "version=4"]
    (tmp_path / "evenements" / "version=9").mkdir()  # left by a run that died
    assert [r.id for r in warehouse.read_state("evenements").collect()] == ["4"]


def test_a_state_with_repeated_keys_is_not_published(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.write_state("evenements", conform(spark.sql("SELECT '1' AS id"), "evenements"))
    with pytest.raises(GateFailure):
        warehouse.write_state("evenements", conform(spark.sql("SELECT explode(array('2', '2')) AS id"), "evenements"))
    assert [r.id for r in warehouse.read_state("evenements").collect()] == ["1"]


def test_reports_are_whole_and_messages_name_nobody(spark, tmp_path, lookups, salts, caplog):
    many = [landing.booking(n, f"who{n}@example.org", place=f"Lieu {n}") for n in range(50)]
    repeated = landing.STUDENTS + [("b7", "1DROI", "1", "x", "", "etu1")]
    inputs = landing.land_day(tmp_path / "in") | {
        "bookings": landing.write_json(tmp_path / "b" / "page-1.json", many),
        "students": landing.write_students(tmp_path / "p" / "ac.txt", repeated),
    }
    run = Run(Warehouse(spark, str(tmp_path / "w")), inputs, lookups, salts, DAY)
    results = run_daily(run, ["bookings", "people"])
    assert not any(r.done for r in results.values())
    failed = next(g for g in results["bookings"].gates if g.count)
    assert failed.count == 50 and spark.read.csv(failed.report, sep="\t", header=True).count() == 50
    told = " ".join([r.error for r in results.values()] + [repr(r.gates) for r in results.values()] + caplog.messages)
    assert failed.report in told and "Lieu" not in told and "etu1" not in told


def test_nothing_raw_is_left_after_a_run(daily):
    run, _ = daily
    run_daily(run)
    root = run.warehouse.root
    import pathlib

    left = [p for p in pathlib.Path(root).rglob("*") if "_tmp_" in str(p)]
    assert left == []


def test_salts_are_not_printed(spark, salts):
    from lutrin.functions.privacy import PREFIX_CONF, SUFFIX_CONF, Salts
    from lutrin.session import build_session

    other = build_session(**{PREFIX_CONF: "pepper-a.b", SUFFIX_CONF: "tail\\Ex"}).newSession()
    other.conf.set("spark.sql.redaction.string.regex", spark.conf.get("spark.sql.redaction.string.regex"))
    df = other.sql("SELECT 'x' AS a").select(pseudonymize(F.col("a"), Salts.from_session(spark)))
    plan = df._jdf.queryExecution().toString()
    assert "pepper-a.b" not in plan
    for name in ("spark.sql.redaction.string.regex", PREFIX_CONF, SUFFIX_CONF):
        spark.conf.unset(name)


def test_a_repeated_lookup_key_stops(spark, tmp_path):
    paths = landing.write_lookups(tmp_path / "l")
    with open(paths["unites"], "a", encoding="utf8") as file:
        file.write("U1;Encore;D2\n")
    with pytest.raises(GateFailure, match="unites: key"):
        load_lookups(spark, paths)


def test_large_files_are_split(spark, tmp_path):
    line = "1,Salle B1,PC1,etu1,2024-01-10 08:00:00,2024-01-10 09:00:00,60\n"
    path = landing.write_text(tmp_path / "c.csv", "a,b,c,d,e,f,g\n" + line * 20000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        rows_ = load_staging(spark, "_tmp_sessions_ordinateurs", path)
        assert rows_.rdd.getNumPartitions() > 2 and rows_.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_desk_extract(spark, tmp_path):
    from lutrin.plans.desk import export_desk

    landing.write_json(tmp_path / "d" / "1.json", {"transactions": [{"transaction_id": "1", "owner": "a\"b"}]})
    export_desk(spark, str(tmp_path / "d"), str(tmp_path / "out"))
    read = spark.read.csv(str(tmp_path / "out"), header=True, escape='"')
    assert [(r.transaction_id, r.owner) for r in read.collect()] == [("1", 'a"b')]


def test_failed_gate_leaves_targets_alone_and_others_running(daily, tmp_path):
    run, _ = daily
    before = {name: content(run.warehouse, name) for name in FINAL}
    inputs = run.inputs | {
        "bookings": landing.write_json(
            tmp_path / "b" / "page-1.json", [landing.booking(9, "x", status="Nouveau", place="Ailleurs")]
        ),
        "entries": str(tmp_path / "missing.csv"),
    }
    results = run_daily(replace(run, inputs=inputs), ["bookings", "traffic", "computers"])
    assert {k: r.done for k, r in results.items()} == {"bookings": False, "traffic": False, "computers": True}
    assert {g.name for g in results["bookings"].gates if g.count} == {
        "bookings: unknown statuses", "bookings: unknown libraries",
    }
    assert {name: content(run.warehouse, name) for name in FINAL} == before


def test_later_run_refreshes_older_sessions(spark, tmp_path, lookups, salts, names):
    """A person unknown on the first day becomes known on the second."""
    inputs = landing.land_day(tmp_path / "one")
    run = Run(Warehouse(spark, str(tmp_path / "w")), inputs, lookups, salts, DAY)
    assert all(r.done for r in run_daily(run, ["people", "computers"]).values())
    invited = ("b9", "1DROI", "1", "x", "p9@example.org", "invite")
    second = {
        "students": landing.write_students(tmp_path / "two" / "ac.txt", landing.STUDENTS + [invited]),
        "staff": inputs["staff"],
        "computers": landing.write_text(
            tmp_path / "two" / "c.csv", "ID,S,P,L,D,F,T\n1,Salle B1,PC9,etu2,2024-01-11 08:00:00,2024-01-11 09:00:00,5\n"
        ),
    }
    results = run_daily(replace(run, inputs=second, day="2024-01-11"), ["people", "computers"])
    assert {k: r.error for k, r in results.items() if not r.done} == {}
    got = {
        (str(r.journee), names[r.usager]): (names[r.courriel], r.discipline)
        for r in run.warehouse.read("sessions_ordinateurs").collect()
    }
    assert got == {
        ("2024-01-10", "etu1"): ("p1@example.org", "D1"),
        ("2024-01-10", "invite"): ("p9@example.org", "D1"),
        ("2024-01-10", "pers1"): ("s4@example.org", "Inconnue"),
        ("2024-01-11", "etu2"): ("p2@example.org", "D3"),
    }


def test_refresh_reads_waiting_accounts_and_changed_persons(spark, tmp_path, lookups, salts, names, monkeypatch):
    """After the first run the history is not scanned; persons missed by a failed run still count."""
    inputs = landing.land_day(tmp_path / "one")
    run = Run(Warehouse(spark, str(tmp_path / "w")), inputs, lookups, salts, DAY)
    assert all(r.done for r in run_daily(run, ["people", "computers"]).values())
    warehouse = run.warehouse
    waiting = {(names[r.usager], str(r.journee)) for r in warehouse.read_state("_sessions_en_attente").collect()}
    assert waiting == {("invite", DAY), ("pers1", DAY)}
    assert warehouse.read_pinned("_clientele_cumul", "computers").count() == 10

    invited = ("b9", "1DROI", "1", "x", "p9@example.org", "invite")
    people_of = lambda day: {
        "students": landing.write_students(tmp_path / day / "ac.txt", landing.STUDENTS + [invited]), "staff": inputs["staff"],
    }
    assert run_daily(replace(run, inputs=people_of("11"), day="2024-01-11"), ["people"])["people"].done
    assert run_daily(replace(run, inputs=people_of("12"), day="2024-01-12"), ["people"])["people"].done
    assert run_daily(replace(run, inputs=people_of("13"), day="2024-01-13"), ["people"])["people"].done
    assert warehouse.read_pinned("_clientele_cumul", "computers").count() == 10  # kept until the next run

    real = Warehouse.read
    monkeypatch.setattr(Warehouse, "read", lambda self, name, extra="": (_ for _ in ()).throw(AssertionError("history")) if name == "sessions_ordinateurs" and not self.allowed else real(self, name, extra), raising=True)
    days_only = Warehouse.read_days

    def read_days(self, name, days, extra=""):
        self.allowed = True
        try:
            return days_only(self, name, days, extra)
        finally:
            self.allowed = False

    monkeypatch.setattr(Warehouse, "read_days", read_days)
    warehouse.allowed = False
    later = {"computers": landing.write_text(
        tmp_path / "13" / "c.csv", "ID,S,P,L,D,F,T\n1,Salle B1,PC9,etu2,2024-01-13 08:00:00,2024-01-13 09:00:00,5\n"
    )}
    result = run_daily(replace(run, inputs=later, day="2024-01-13"), ["computers"])["computers"]
    assert result.done, result.error
    monkeypatch.undo()
    got = {names[r.usager]: names[r.courriel] for r in warehouse.read("sessions_ordinateurs").collect()}
    assert got["invite"] == "p9@example.org"
    assert {names[r.usager] for r in warehouse.read_state("_sessions_en_attente").collect()} == {"pers1"}


def test_empty_snapshot_clears_its_day(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    row = conform(spark.sql("SELECT 'u' AS usager, date'2024-01-10' AS journee, true AS clientele"), "_clientele_cumul")
    for day in ("2024-01-10", "2024-01-11"):
        other = row.withColumn("journee", F.lit(day).cast("date"))
        warehouse.write_day("clientele", people.build_snapshot(other, day), day)
    warehouse.write_day("clientele", people.build_snapshot(row.filter("false"), "2024-01-10"), "2024-01-10")
    assert [str(r.journee) for r in warehouse.read("clientele").collect()] == ["2024-01-11"]


def test_only_touched_days_are_read_and_written(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    rows_ = conform(
        spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-01-09')) AS journee, 'B' AS bibliotheque"),
        "frequentation",
    )
    warehouse.write_days("frequentation", rows_)
    some = warehouse.read_days("frequentation", [date(2024, 1, 3), date(2024, 1, 4)])
    assert {f.split("journee=")[1][:10] for f in some.inputFiles()} == {"2024-01-03", "2024-01-04"}
    # The days being replaced are read by the job that replaces them.
    warehouse.write_days("frequentation", some.withColumn("frequentation", F.lit(5).cast("bigint")))
    got = {r.journee.day: r.frequentation for r in warehouse.read("frequentation").collect()}
    assert got == {d: (5 if d in (3, 4) else None) for d in range(1, 10)}


def test_whole_files_give_the_same_run(daily, spark, tmp_path):
    run, _ = daily
    other = replace(run, warehouse=Warehouse(spark, str(tmp_path)), multiline=True, snapshot=False)
    assert all(r.done for r in run_daily(other, ["people", "traffic", "computers", "loans"]).values())
    for name in ("frequentation", "sessions_ordinateurs", "emprunts"):
        assert content(other.warehouse, name) == content(run.warehouse, name)


def test_frames_as_inputs_give_the_same_run(daily, spark, tmp_path):
    run, _ = daily
    names = {"entries": "_tmp_frequentation", "occupancy": "_tmp_occupation", "computers": "_tmp_sessions_ordinateurs"}
    frames = {k: load_staging(spark, n, run.inputs[k]).toDF(*[f"c{i}" for i in range(len(TABLES[n].loaded))]) for k, n in names.items()}
    frames["loans"] = extract_loans(spark, run.inputs["loans"])
    other = replace(run, warehouse=Warehouse(spark, str(tmp_path)), inputs=run.inputs | frames, snapshot=False)
    results = run_daily(other, ["people", "traffic", "computers", "loans"])
    assert {k: r.error for k, r in results.items() if not r.done} == {}
    for name in ("frequentation", "sessions_ordinateurs", "emprunts"):
        assert content(other.warehouse, name) == content(run.warehouse, name)


def test_stale_files_stop_people(spark, tmp_path, lookups, salts):
    inputs = landing.land_day(tmp_path / "one")
    run = Run(Warehouse(spark, str(tmp_path / "w")), inputs, lookups, salts, DAY, fresh_on="2000-01-01")
    result = run_daily(run, ["people"])["people"]
    assert not result.done and result.gates[0].count == 2


# ---- nothing delivered


def test_empty_deliveries_leave_everything_as_it_is(spark, lookups, salts, daily):
    warehouse = daily[0].warehouse
    persons = warehouse.read_state("_clientele_cumul")
    nobody = empty_table(spark, "_clientele_cumul")

    def staged(name):
        return empty_table(spark, name)

    def same(build, name):
        run_gates(build.gates)
        assert rows(build.rows) == content(warehouse, name)

    for known in (persons, nobody):
        assert rows(bookings.build_bookings(staged("_tmp_reservations"), known, lookups, salts).checked()) == []
        same(
            loans.build_loans(
                staged("_tmp_emprunts"), known, lookups.synonymes, warehouse.read("emprunts"), "exemple", salts
            ),
            "emprunts",
        )
        same(
            trainings.build_registrations(
                staged("_tmp_inscriptions"), known, warehouse.read_state("inscriptions"), salts
            ),
            "inscriptions",
        )
        same(
            computers.build_computer_sessions(
                staged("_tmp_sessions_ordinateurs"), known, lookups.synonymes,
                warehouse.read("sessions_ordinateurs"), salts,
            ),
            "sessions_ordinateurs",
        )
    same(
        trainings.build_events(
            staged("_tmp_evenements"), staged("_tmp_inscriptions"), warehouse.read_state("evenements")
        ),
        "evenements",
    )
    same(
        traffic.build_traffic(
            staged("_tmp_frequentation"), staged("_tmp_occupation"), lookups.synonymes, warehouse.read("frequentation")
        ),
        "frequentation",
    )
    students, staff = staged("_tmp_etudiants"), staged("_tmp_personnel")
    _, dim = people.add_day(
        persons,
        people.build_students(students, lookups, salts).checked(),
        people.build_staff(staff, students, lookups, salts).checked(),
        "2024-02-01",
    )
    assert rows(dim) == rows(persons)


def test_facts_without_any_person(spark, lookups, salts, daily, names):
    """First run, before people are loaded: nobody is known, nothing is lost but loans."""
    nobody = empty_table(spark, "_clientele_cumul")
    pages, _ = read_bookings(spark, daily[0].inputs["bookings"])
    staging = to_table_types(pages, "_tmp_reservations")
    built = bookings.build_bookings(staging, nobody, lookups, salts).checked()
    assert {(r.salle, r.usager, r.discipline) for r in built.collect()} == {
        (f"A-{n}", None, "Inconnue") for n in (1, 2, 3, 4)
    }


# ---- backfill

DIRECTORY = {
    "20240103": (landing.STUDENTS[:3], landing.STAFF),
    "20240102": (landing.STUDENTS, landing.STAFF[:4]),
    "20240905": ([("b1", "2LANG", "1", "Latin", "p1@example.org", "etu1")], landing.STAFF[:1]),
    "20240910": ([("b1", "9LANG", "1", "Latin", "p1@example.org", "etu2")], landing.STAFF[:2]),
}


def test_backfill_equals_days_one_after_the_other(spark, tmp_path, lookups, salts):
    folder = tmp_path / "in"
    for stamp, (students, staff) in DIRECTORY.items():
        landing.write_students(folder / f"synchro_ac.TXT.{stamp}", students)
        landing.write_staff(folder / f"synchro_rh.txt.{stamp}", staff)
    landing.write_students(folder / "synchro_ac.TXT", landing.STUDENTS)
    landing.write_students(folder / "synchro_ac.TXT.20240915", landing.STUDENTS)
    landing.write_staff(folder / "synchro_rh.txt.20240920", landing.STAFF)
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    left_out = backfill.backfill_people(warehouse, str(folder), lookups, salts, snapshot=True)
    assert left_out == [
        (date(2024, 9, 9), "contrôles"), (date(2024, 9, 14), "sans personnel"), (date(2024, 9, 19), "sans étudiants"),
    ]
    stats = people.discipline_stats(warehouse.read("clientele"), lookups.disciplines)
    assert rows(warehouse.read("disciplines_stats")) == rows(stats) != []
    assert not (tmp_path / "w" / "_staging" / warehouse.run_id).exists()

    current = empty_table(spark, "_clientele_cumul")
    snapshots = []
    for stamp in ["20240102", "20240103", "20240905"]:
        day = f"{stamp[:4]}-{stamp[4:6]}-{int(stamp[6:]) - 1:02d}"
        students = stamp_day(read_students(spark, str(folder / f"synchro_ac.TXT.{stamp}")), day)
        staff = stamp_day(read_staff(spark, str(folder / f"synchro_rh.txt.{stamp}")), day)
        merged = people.merge_people(
            current,
            people.build_students(students, lookups, salts).checked(),
            people.build_staff(staff, students, lookups, salts).checked(),
        )
        snapshots += rows(people.build_snapshot(merged, day))
        current = spark.createDataFrame(people.latest_people(merged).collect(), current.schema)
    assert rows(warehouse.read_state("_clientele_cumul")) == rows(current)
    assert rows(warehouse.read("clientele")) == sorted(snapshots, key=lambda r: tuple(str(v) for v in r))


def test_loans_are_shuffled_once_to_be_ranked_and_met(spark, salts):
    """One shuffle of the staged rows and one of the current keys, and the same rows as one by one."""
    columns = "cb_document cote bibliotheque_pret cb_usager date bibliotheque_document institution_doc institution_usager"
    staged = [
        (doc, cote, "Droit", user, f"2024-01-0{day} 10:00:00", "Droit", "exemple", "exemple")
        for doc in ("d1", None) for cote in ("b", "a", None) for user in ("u1", "u2", "", None, "nobody") for day in (1, 2)
    ]
    staging = spark.createDataFrame(staged, ", ".join(f"{c} string" for c in columns.split()))
    persons = spark.createDataFrame([(date(2024, 1, 1), u) for u in ("u1", "u2")], "journee date, usager string")
    hidden = pseudonymize(F.col("usager"), salts)
    persons = persons.withColumn("codebarres", hidden).withColumn("courriel", hidden).withColumn("discipline", F.lit("D"))
    old = [(d, "u1", "ancien", "2024-01-01 10:00:00") for d in ("d1", "d1", "d2", None)]
    old = spark.createDataFrame(old, "cb_document string, usager string, cote string, dateheure string")
    old = old.withColumn("cb_usager", hidden).withColumn("journee", F.to_date("dateheure"))
    none = spark.createDataFrame([], "domaine string, rejeter string, accepter string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        built = loans.build_loans(staging, persons, none, conform(old, "emprunts"), "exemple", salts)
        plan = built.rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(cb_document") == 2
        got = rows(built.rows.select("cb_document", "cb_usager", F.dayofmonth("dateheure"), "cote"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    code = {u: spark.range(1).select(pseudonymize(F.lit(u), salts)).first()[0] for u in ("u1", "u2")}
    new = [("d1", "u1", 2), ("d1", "u2", 1), ("d1", "u2", 2), (None, "u1", 1), (None, "u1", 2), (None, "u2", 1), (None, "u2", 2)]
    expected = [("d1", code["u1"], 1, "ancien")] * 2 + [("d2", code["u1"], 1, "ancien"), (None, code["u1"], 1, "ancien")]
    expected += [(d, code[u], day, None) for d, u, day in new]
    assert got == sorted(expected, key=lambda r: tuple(str(v) for v in r))


def test_persons_are_reduced_before_they_are_merged(spark):
    """Only the latest row of a person goes through the merge; the result is that of the whole merge."""
    def people_of(seed, days, **values):
        df = spark.range(400).select(
            F.expr(f"date_add(date'2024-01-01', CAST(pmod(xxhash64(id, {seed}), {days}) AS INT))").alias("journee"),
            F.concat(F.lit("u"), F.expr(f"pmod(xxhash64(id, {seed} + 1), 60)").cast("string")).alias("usager"),
        ).distinct()
        return df.select("*", *[F.concat(F.lit(v), F.col("journee").cast("string")).alias(k) for k, v in values.items()])

    current = conform(people_of(1, 12, code_unite="z", fonction="old", session="kept"), "_clientele_cumul")
    students = people_of(3, 9, code_programme="x", fonction="new")
    staff = people_of(5, 9, code_unite="y").withColumn("usager", F.concat(F.lit("s"), "usager"))
    dim = people.update_person_dim(current, students, staff)
    assert rows(dim) == rows(people.latest_people(people.merge_people(current, students, staff)))
    # each of the three inputs is ranked, in part before its shuffle, and the merged rows once more
    again = people.update_person_dim(current, students, staff)  # a plan that has not run
    assert again._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 8
