"""Commits, buckets, and what is left of runs that die."""

import os
import subprocess
import sys
import threading

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lutrin.manifests import Manifests, packed, unpacked
from lutrin.operators.gates import GateFailure
from lutrin.operators.links import link, unique_persons
from lutrin.plans.people import write_people
from lutrin.schemas import LINKS, PEOPLE, conform
from lutrin.warehouse import BUCKETS, Warehouse, bucket_of

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03"]


def doors(spark, value, days=DAYS):
    table = spark.createDataFrame([(d, "B1", value) for d in days], "journee string, bibliotheque string, frequentation long")
    return conform(table, "frequentation")


def counts(warehouse):
    return {str(r.journee): r.frequentation for r in warehouse.read("frequentation").collect()}


def test_days_are_replaced_together(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    assert counts(warehouse) == {}
    warehouse.write_days("frequentation", doors(spark, 1))
    warehouse.write_days("frequentation", doors(spark, 2, DAYS[1:2]))
    assert counts(warehouse) == dict(zip(DAYS, (1, 2, 1)))
    assert [r.frequentation for r in warehouse.read_days("frequentation", [DAYS[1]]).collect()] == [2]
    listed = warehouse.read_days("frequentation", [DAYS[1]]).inputFiles()
    assert all("version=2" in f and DAYS[1] in f for f in listed)
    warehouse.write_days("frequentation", warehouse.read_days("frequentation", DAYS[:1]).withColumn("frequentation", F.lit(9).cast("long")))
    warehouse.write_day("frequentation", doors(spark, 0, []), DAYS[2])
    assert counts(warehouse) == {DAYS[0]: 9, DAYS[1]: 2}


def test_a_job_that_fails_between_days_leaves_the_old_state(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.write_days("frequentation", doors(spark, 1))
    late = F.when(F.col("journee") == F.lit(DAYS[2]).cast("date"), F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        warehouse.write_days("frequentation", doors(spark, 2).withColumn("frequentation", late.otherwise(F.lit(2).cast("long"))))
    assert counts(warehouse) == dict.fromkeys(DAYS, 1)
    warehouse.write_days("frequentation", doors(spark, 3))
    assert counts(warehouse) == dict.fromkeys(DAYS, 3)


def loans(spark, *rows_):
    table = spark.createDataFrame(rows_, "cb_document string, cb_usager string, dateheure string, journee string, cote string")
    return conform(table.withColumn("dateheure", F.col("dateheure").cast("timestamp")), "emprunts")


GOOD = ("d1", "u1", "2024-01-01 10:00:00", "2024-01-01", "c")


@pytest.mark.parametrize(
    "gate, bad",
    [
        ("emprunts: key", [("d2", "u1", "2024-01-02 10:00:00", "2024-01-02", "c")] * 2),
        ("emprunts: key", [("d2", None, "2024-01-02 10:00:00", "2024-01-02", "c")]),
        ("emprunts: day", [("d1", "u1", "2024-01-01 10:00:00", "2024-01-02", "c")]),  # the key of another day
        ("emprunts: day", [("d1", "u1", None, "2024-01-02", "c")]),
        ("emprunts: text length", [("d2", "u1", "2024-01-02 10:00:00", "2024-01-02", "c" * 256)]),
    ],
)
def test_days_that_break_the_contract_are_not_published(spark, tmp_path, gate, bad):
    warehouse = Warehouse(spark, str(tmp_path))
    assert all(not r.count for r in warehouse.write_days("emprunts", loans(spark, GOOD)))
    before = warehouse.last_commit()
    with pytest.raises(GateFailure, match=gate) as failure:
        warehouse.write_days("emprunts", loans(spark, GOOD[:4] + ("new",), *bad))
    failed = {r.name: r.report for r in failure.value.results if r.count}
    assert gate in failed and os.path.isdir(failed[gate])
    assert warehouse.last_commit() == before and [r.cote for r in warehouse.read("emprunts").collect()] == ["c"]


def test_the_gates_of_a_day_read_no_other_day(spark, tmp_path):
    """The files of the first day are spoiled: who reads them fails."""
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.write_days("emprunts", loans(spark, GOOD))
    (spoiled,) = warehouse.read("emprunts").inputFiles()
    with open(spoiled.removeprefix("file://"), "wb") as file:
        file.write(b"spoiled")
    warehouse.write_days("emprunts", loans(spark, ("d1", "u1", "2024-01-02 10:00:00", "2024-01-02", "c")))
    assert len(warehouse.read_days("emprunts", ["2024-01-02"]).collect()) == 1
    with pytest.raises(Exception):
        warehouse.read("emprunts").collect()


KILLED = """
import os, sys
sys.path[:0] = [{repo!r}, {repo!r} + "/tests"]
from lutrin.session import build_session
from lutrin.manifests import Manifests
from lutrin.warehouse import Warehouse
import lutrin.manifests as m
from test_warehouse import DAYS, doors

spark = build_session("killed", "local[2]", **{{"spark.sql.shuffle.partitions": "2"}})
warehouse = Warehouse(spark, {root!r})
warehouse.write_days("frequentation", doors(spark, 1))
moment = {moment!r}
real = m.Files.write
def write(self, path, text, replace=False):
    if moment == "before" and "_manifest" in path:
        os._exit(7)
    if moment == "within" and "_commits" in path:
        real(self, path, text[: len(text) // 2])
        os._exit(7)
    real(self, path, text, replace)
m.Files.write = write
warehouse.write_days("frequentation", doors(spark, 2))
"""


@pytest.mark.parametrize("moment", ["before", "within"])
def test_a_killed_driver_leaves_the_old_state(spark, tmp_path, moment):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = KILLED.format(repo=repo, root=str(tmp_path), moment=moment)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=180)
    assert done.returncode == 7, done.stderr[-2000:]
    warehouse = Warehouse(spark, str(tmp_path))
    assert counts(warehouse) == dict.fromkeys(DAYS, 1)
    warehouse.write_days("frequentation", doors(spark, 3, DAYS[:1]))
    assert counts(warehouse) == dict(zip(DAYS, (3, 1, 1)))


def test_several_tables_become_readable_together(spark, tmp_path):
    warehouse, other = Warehouse(spark, str(tmp_path)), Warehouse(spark, str(tmp_path))
    event = conform(spark.sql("SELECT '1' AS id"), "evenements")
    with warehouse.commit():
        warehouse.write_days("frequentation", doors(spark, 1))
        warehouse.write_state("evenements", event)
        assert counts(warehouse) == dict.fromkeys(DAYS, 1) and counts(other) == {} and not other.has_state("evenements")
    assert counts(other) == dict.fromkeys(DAYS, 1) and other.has_state("evenements")
    with pytest.raises(GateFailure), warehouse.commit():
        warehouse.write_days("frequentation", doors(spark, 2))
        warehouse.write_state("evenements", event.union(event))
    assert counts(warehouse) == dict.fromkeys(DAYS, 1)


def test_commits_of_threads_add_up(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    tasks = [threading.Thread(target=warehouse.write_days, args=("frequentation", doors(spark, 1)))]
    tasks += [threading.Thread(target=warehouse.write_state, args=(n, conform(spark.sql("SELECT '1' AS id"), n))) for n in ("evenements",)]
    for t in tasks:
        t.start()
    for t in tasks:
        t.join()
    assert counts(warehouse) == dict.fromkeys(DAYS, 1) and warehouse.has_state("evenements")


def test_only_named_files_stay(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    for value in range(5):
        warehouse.write_days("frequentation", doors(spark, value, DAYS if value == 0 else DAYS[:2]))
    left = sorted(str(p.relative_to(tmp_path / "frequentation")) for p in (tmp_path / "frequentation").glob("version=*/journee=*"))
    assert left == [
        f"version=1/journee={DAYS[2]}", f"version=4/journee={DAYS[0]}", f"version=4/journee={DAYS[1]}",
        f"version=5/journee={DAYS[0]}", f"version=5/journee={DAYS[1]}",
    ]
    assert counts(warehouse) == {DAYS[0]: 4, DAYS[1]: 4, DAYS[2]: 0}


def test_manifests_tell_whole_files():
    rows_ = {"journee=2024-01-01": 3, "*": 1}
    text = packed(rows_)
    assert unpacked(text) == {"journee=2024-01-01": "3", "*": "1"}
    assert unpacked(packed({})) == {}
    assert all(unpacked(text[:n]) is None for n in range(len(text)))
    assert unpacked(text.replace("3", "4")) is None


def test_an_empty_warehouse_has_no_commit(spark, tmp_path):
    assert Manifests(spark, str(tmp_path)).latest() == (0, {})


# ---- buckets


def persons(spark, numbers, day="2024-01-10", mail="u{}@example.org"):
    table = spark.createDataFrame([(day, f"u{n}", mail.format(n), f"b{n}", f"D{n % 3}") for n in numbers], "journee string, usager string, courriel string, codebarres string, discipline string")
    return conform(table, PEOPLE)


def files_of(warehouse, name):
    return set(warehouse.read_state(name).inputFiles())


def test_few_persons_rewrite_few_buckets(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), buckets=16)
    write_people(warehouse, warehouse.read_state(PEOPLE), persons(spark, range(200)))
    before = {name: files_of(warehouse, name) for name in (PEOPLE, *LINKS)}
    assert rows(warehouse.read_state(PEOPLE)) == rows(persons(spark, range(200)))
    one = persons(spark, [7], "2024-01-11", "new{}@example.org")
    touched = warehouse.buckets_of(PEOPLE, one.select("usager"))
    old = warehouse.read_buckets(PEOPLE, touched)
    write_people(warehouse, old, old.filter("usager <> 'u7'").unionByName(one), touched)
    want = persons(spark, [n for n in range(200) if n != 7]).unionByName(one)
    assert rows(warehouse.read_state(PEOPLE)) == rows(want)
    assert len(files_of(warehouse, PEOPLE) - before[PEOPLE]) == 1
    for name, key in LINKS.items():
        assert rows(warehouse.read_state(name)) == rows(conform(want, name))
        assert len(files_of(warehouse, name) - before[name]) <= 2  # the old key's bucket and the new one's
    assert warehouse.buckets(PEOPLE) == 16 == Warehouse(spark, str(tmp_path), buckets=3).buckets(PEOPLE)


def test_buckets_hold_their_keys(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), buckets=5)
    write_people(warehouse, warehouse.read_state(PEOPLE), persons(spark, range(50)))
    for name, key in {PEOPLE: "usager", **LINKS}.items():
        found = warehouse.read_state(name).withColumn("f", F.input_file_name()).select("f", bucket_of(F.col(key), 5).alias("n")).distinct().collect()
        assert all(f"seau={r.n}/" in r.f and f"_{r.n:05d}.c000" in r.f for r in found)
    assert warehouse.entries(PEOPLE)[BUCKETS] == 5


def test_a_person_without_a_key_is_in_no_copy(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    people = persons(spark, range(5)).withColumn("courriel", F.when(F.col("usager") != "u1", F.col("courriel")))
    write_people(warehouse, warehouse.read_state(PEOPLE), people)
    assert warehouse.read_state("_clientele_par_courriel").count() == 4
    assert warehouse.read_state("_clientele_par_codebarres").count() == 5
    write_people(warehouse, warehouse.read_state(PEOPLE), people.filter("usager = 'u1'"))
    assert warehouse.read_state("_clientele_par_courriel").count() == 0
    assert warehouse.read_state("_clientele_par_codebarres").count() == 1


@pytest.mark.parametrize("name, key", [(PEOPLE, "usager"), *LINKS.items()])
def test_links_do_not_shuffle_persons(spark, tmp_path, name, key):
    warehouse = Warehouse(spark, str(tmp_path), buckets=6)
    write_people(warehouse, warehouse.read_state(PEOPLE), persons(spark, range(300)))
    known = unique_persons(warehouse.read_state(name), key)
    facts = spark.range(1000).withColumn("who", F.concat(F.lit("u" if key == "usager" else "b"), F.col("id") % 400))
    if key == "courriel":
        facts = facts.withColumn("who", F.concat("who", F.lit("@example.org"))).withColumn("who", F.regexp_replace("who", "^b", "u"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot = spark.createDataFrame([], "who string")
        linked = link(facts, known, "who", key, {"usager": "usager", "discipline": "discipline"}, hot=hot)
        plan = linked._jdf.queryExecution().sparkPlan().toString()
        physical = linked._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        side = unique_persons(warehouse.read_state(name), key)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in side and "Bucketed: true" in side
        # shuffles: the facts by their key; nothing of the persons
        assert physical.count("Exchange hashpartitioning") == 1 and "hashpartitioning(_key" in physical
        got = linked.filter("usager IS NOT NULL").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == sum(1 for n in range(1000) if n % 400 < 300)
