"""Delimited text with line breaks in quotes, cut into many splits."""

import gzip
import random

import pytest

from conftest import rows
from lutrin.sources import quoted
from lutrin.sources.delimited import load_staging, read_delimited, write_delimited

COLUMNS = ["a", "b", "c"]


@pytest.fixture
def small_splits(spark):
    """Splits of some hundred bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "400", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def field(rng):
    kind = rng.random()
    if kind < 0.3:
        return "".join(rng.choice("xyz é") for _ in range(rng.randint(0, 8))).strip()
    if kind < 0.4:
        return '"' + "\n" * rng.randint(1, 60) + '"'
    inner = "".join(rng.choice(['""', "\n", "\r\n", ";", "word ", "ü", " "]) for _ in range(rng.randint(0, 12)))
    return f'"{inner}"'


def text_of(seed, n=300, end="\n"):
    rng = random.Random(seed)
    return "x;y;z" + end + "".join(";".join([str(i), field(rng), field(rng)]) + end for i in range(n))


def whole(spark, path):
    return rows(read_delimited(spark, path, COLUMNS, multiline=True))


@pytest.mark.parametrize("seed, end", [(1, "\n"), (2, "\n"), (3, "\r\n"), (4, "\n")])
def test_many_tasks_read_what_the_whole_file_reader_reads(spark, tmp_path, small_splits, seed, end):
    path = tmp_path / "x.csv"
    path.write_bytes(text_of(seed, end=end).encode())
    lines = quoted.split_lines(spark, str(path))
    assert lines.rdd.getNumPartitions() > 10
    got = rows(read_delimited(spark, str(path), COLUMNS, multiline="split"))
    want = whole(spark, str(path))
    if end == "\r\n":  # the whole-file reader turns breaks inside quotes into the line end it has detected
        got, want = (sorted(tuple(x.replace("\r\n", "\n") for x in r) for r in rs) for rs in (got, want))
    assert len(got) == 300 and got == want


def test_a_record_over_many_splits(spark, tmp_path, small_splits):
    path = tmp_path / "x.csv"
    long = "\n".join(f"line {i}" for i in range(2000))
    path.write_text(f'h;h;h\n1;"{long}";x\n2;y;"{long}"\n3;z;z\n')
    got = {r.a: (r.b, r.c) for r in read_delimited(spark, str(path), COLUMNS, multiline="split").collect()}
    assert got == {"1": (long, "x"), "2": ("y", long), "3": ("z", "z")}


def test_the_header_may_have_breaks_and_span_splits(spark, tmp_path, small_splits):
    path = tmp_path / "x.csv"
    path.write_text('﻿"h' + "\n" * 900 + '";h;h\n1;2;3\n')
    assert rows(read_delimited(spark, str(path), COLUMNS, multiline="split")) == [("1", "2", "3")]
    assert len(rows(read_delimited(spark, str(path), COLUMNS, multiline="split", header=False))) == 2


def test_several_files_and_a_packed_one(spark, tmp_path, small_splits):
    for i in range(4):
        (tmp_path / f"{i}.csv").write_text(text_of(i + 10, 40), newline="")
    (tmp_path / "4.csv.gz").write_bytes(gzip.compress(text_of(20, 40).encode()))
    (tmp_path / "5.csv").write_text("x;y;z\n")
    (tmp_path / "6.csv").write_text("")
    got = rows(read_delimited(spark, str(tmp_path), COLUMNS, multiline="split"))
    assert len(got) == 200 and got == whole(spark, str(tmp_path))


def test_lines_and_splits_joined_by_a_shuffle(spark, tmp_path, small_splits, monkeypatch):
    path = tmp_path / "x.csv"
    path.write_text(text_of(5), newline="")
    monkeypatch.setattr(quoted, "BROADCAST_FILES", 0)
    assert rows(read_delimited(spark, str(path), COLUMNS, multiline="split")) == whole(spark, str(path))


def test_a_quote_that_is_never_closed_stops(spark, tmp_path, small_splits):
    path = tmp_path / "x.csv"
    path.write_text('h;h;h\n1;2;3\n4;"5;6\n7;8;9\n')
    with pytest.raises(Exception, match="never closed"):
        read_delimited(spark, str(path), COLUMNS, multiline="split").collect()
    loose = read_delimited(spark, str(path), COLUMNS, multiline="split", strict=False)
    assert rows(loose)[0][:2] == ("1", "2") and loose.count() == 2


@pytest.mark.parametrize("row", ["1;2", "1;2;3;4", 'a "b;c;d\n1;"2;3'])
def test_wrong_records_stop(spark, tmp_path, row):
    path = tmp_path / "x.csv"
    path.write_text("h;h;h\n" + row + "\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|never closed"):
        read_delimited(spark, str(path), COLUMNS, multiline="split").collect()


def test_blank_records_are_left_out(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("h;h;h\n\n1;2;3\n  \n\r\n;;\n")
    assert rows(read_delimited(spark, str(path), COLUMNS, multiline="split")) == [("", "", ""), ("1", "2", "3")]


def test_staging_keeps_the_order_of_the_file(spark, tmp_path, small_splits):
    path = tmp_path / "staff.csv"
    path.write_text("h,h,h,h,h,h,h\n" + "".join(f'u,"d\n{i}",P,m,b,f,login{i}\n' for i in range(200)))
    df = load_staging(spark, "_tmp_personnel", str(path), "2024-01-01", multiline="split")
    assert [r.Login for r in df.orderBy("id").collect()] == [f"login{i}" for i in range(200)]


def test_written_text_reads_back(spark, tmp_path, small_splits):
    given = [("1", 'say "hi"\n\n', ""), ("2", "\r\n;", "é\n"), ("3", "", "x")]
    df = spark.createDataFrame(given, "a string, b string, c string")
    write_delimited(df, str(tmp_path / "out"), sep=";")
    assert rows(read_delimited(spark, str(tmp_path / "out"), COLUMNS, multiline="split")) == sorted(given)
