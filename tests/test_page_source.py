"""The data source of landed answers, held against the plain reader and its gate."""

import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.files import PAGES, landed_pages
from conftest import rows
from lutrin.sources import json_pages
from lutrin.sources.page_source import Number, load_pages, shaped, text_of

RECORD = "id string, n long, x double, ok boolean, owner struct<id: string, name: string>, tags array<string>"


def land(folder, name, value):
    folder.mkdir(exist_ok=True, parents=True)
    (folder / name).write_text(json.dumps(value, ensure_ascii=False), encoding="utf8")


def record(i, **changes):
    return {
        "id": i, "n": i * 10**10, "x": i / 4, "ok": i % 2 == 0, "owner": {"id": i, "name": "É\n\"" + str(i)}, "tags": ["a", i, None], "extra": [1],
    } | changes


def both(spark, path, record=RECORD, wrapper=None):
    """Records by the source and by the plain reader."""
    columns = [f.name for f in T.StructType.fromDDL(record).fields] + ["dossier", "fichier"]
    return (
        rows(load_pages(spark, str(path), record, wrapper).select(columns)),
        rows(json_pages.read_pages(spark, str(path), record, wrapper).select(columns)),
    )


def test_same_records_as_the_plain_reader(spark, tmp_path):
    folder = tmp_path / "b"
    land(folder, "page-1.json", [record(1), record(2, id=None, owner=None, tags=None)])
    land(folder, "page-2.json", [record(3, id="é", n=None), {"id": 4}, {"id": 1.50, "owner": {"id": True}, "tags": []}])
    land(folder, "page-3.json", [])
    (folder / "page-4.json").write_text('{"id":{"a":[1,"x",2.50,null]},"n":5}')
    land(folder, "_left", [record(9)])
    with gzip.open(folder / "page-5.json.gz", "wt", encoding="utf8") as f:
        json.dump([record(6)], f)
    got, plain = both(spark, folder)
    assert got == plain and len(got) == 7


def test_wrapped_and_bare_answers(spark, tmp_path):
    folder = tmp_path / "e"
    land(folder, "1.json", {"events": [record(1), record(2)], "total": 2})
    land(folder, "2.json", [record(3)])
    land(folder, "3.json", {"events": []})
    land(folder, "4.json", {"events": None, "total": 0})
    land(folder, "5.json", record(4))
    got, plain = both(spark, folder, wrapper="events")
    assert got == plain and len(got) == 4


def test_pages_outside_a_range_are_not_opened(spark, tmp_path):
    folder = tmp_path / "b"
    for page in range(1, 7):
        land(folder, f"page-{page}.json", [record(page)])
    for name in ("page-7.json", "notes.json"):
        (folder / name).write_text("cut off")
    some = load_pages(spark, str(folder), RECORD, task_bytes=1, first=3, last=5)
    assert some.rdd.getNumPartitions() == 3 and sorted(r.id for r in some.collect()) == ["3", "4", "5"]
    assert load_pages(spark, str(folder), RECORD, last=2).count() == 2 and load_pages(spark, str(folder), RECORD, first=99).count() == 0
    with pytest.raises(Exception, match="MALFORMED answer in .*page-7.json"):
        load_pages(spark, str(folder), RECORD, first=6).count()


def test_a_condition_of_one_query_does_not_stay_for_the_next(spark, tmp_path):
    for page in range(1, 5):
        land(tmp_path / "b", f"page-{page}.json", [record(page)])
    pages = load_pages(spark, str(tmp_path / "b"), RECORD)
    assert pages.where("page = 3").count() == 1 and pages.count() == 4
    assert pages.join(pages.where("page = 3").select("id"), "id", "left_anti").count() == 3


def test_files_are_read_together(spark, tmp_path):
    for page in range(1, 41):
        land(tmp_path / "b", f"page-{page}.json", [record(page)])
    assert load_pages(spark, str(tmp_path / "b"), RECORD).rdd.getNumPartitions() == 1
    some = load_pages(spark, str(tmp_path / "b"), RECORD, task_bytes=1000)
    assert 2 <= some.rdd.getNumPartitions() < 40 and some.count() == 40


@pytest.mark.parametrize(
    "pages",
    [
        {"a/page-1": 2, "a/page-2": 2, "a/page-4": 1},
        {"a/page-1": 2, "a/page-2": 0, "a/page-3": 1},
        {"a/page-2": 1},
        {"a/page-1": 2, "a/page-2": 0},
        {"a/page-1": 1, "b/page-1": 2, "b/page-2": 1},
        {"a/page-1": 1, "a/page-2": 1, "b/page-1": 1, "b/page-2": 1},
        {"a/page-1": 2, "a/x-page-1": 2, "a/page-2": 1},
        {"a/page-1": 2, "a/notes": 1},
        {"a/notes": 1, "a/other": 0},
    ],
)
def test_lost_pages_stop_exactly_where_the_gate_does(spark, tmp_path, pages):
    for name, n in pages.items():
        folder, file = name.split("/")
        land(tmp_path / "in" / folder, f"{file}.json", [record(i) for i in range(n)])
    _, gate = json_pages.read_bookings(spark, f"{tmp_path}/in/*", page_size=2)
    if gate.violations.count():
        with pytest.raises(Exception, match="LostPages"):
            load_pages(spark, str(tmp_path / "in"), RECORD, page_size=2).count()
    else:
        assert load_pages(spark, str(tmp_path / "in"), RECORD, page_size=2).count() == sum(pages.values())
    assert load_pages(spark, str(tmp_path / "in"), RECORD).count() == sum(pages.values())  # not judged


def test_wrong_types_clashes_and_empty_folders(spark, tmp_path):
    land(tmp_path / "b", "page-1.json", [record(1, n="secret")])
    with pytest.raises(Exception, match="MALFORMED") as stopped:
        load_pages(spark, str(tmp_path / "b"), RECORD).count()
    assert "secret" not in str(stopped.value)
    with pytest.raises(Exception, match="taken"):
        load_pages(spark, str(tmp_path / "b"), "page string")
    (tmp_path / "none").mkdir()
    assert load_pages(spark, str(tmp_path / "none"), RECORD, page_size=2).count() == 0
    with pytest.raises(Exception, match="FileNotFound"):
        load_pages(spark, str(tmp_path / "missing"), RECORD).count()


def test_values():
    assert text_of({"a": [Number("1.50"), "x", None, True]}) == '{"a":[1.50,"x",null,true]}'
    assert shaped(Number("7"), T.LongType()) == 7 and shaped(Number("7"), T.StringType()) == "7"
    with pytest.raises(ValueError):
        shaped(Number("7.5"), T.LongType())


def test_landed_pages_share_files(spark):
    """Files grow with the pages they hold, not one for each page, and every record is read back."""
    turns = spark.range(0, 6 * PAGES, 1, 3).selectExpr("id div 2 AS conv_id", "id AS turn")
    path = landed_pages(spark, turns, F.struct(F.col("turn").cast("string").alias("id"), "conv_id"))
    files = list(Path(path).glob("part-*.txt"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert 3 <= len(files) <= 3 + tasks
    assert sum(len(json.loads(f.read_text())) for f in files) == 3 * PAGES
    for found in (
        json_pages.read_pages(spark, f"{path}/*.txt", "id string, conv_id long", "events"),
        load_pages(spark, path, "id string, conv_id long", "events", page_pattern=r"part-(\d+)"),
    ):
        assert rows(found.select("conv_id", "id")) == rows(turns.selectExpr("conv_id", "CAST(turn AS STRING)"))
