import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lutrin.functions.dates import (
    date_chunks,
    day_in_name,
    is_iso_instant,
    normalize_date,
    parse_instant,
    term_start,
)
from lutrin.functions.people import programme_of, staff_audience, staff_function, student_level
from lutrin.functions.privacy import Salts, pseudonymize
from lutrin.functions.text import blank_to_null, report_line, strip


def one(spark, data, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(data, schema).select(*columns).collect()]


def test_term_boundaries(spark):
    days = ["2024-01-01", "2024-04-30", "2024-05-01", "2024-08-31", "2024-09-01", "2024-12-31"]
    got = one(
        spark, [(date.fromisoformat(d),) for d in days] + [(None,)], "d date", term_start(F.col("d"))
    )
    assert [g[0] and g[0].isoformat() for g in got] == [
        "2024-01-01", "2024-01-01", "2024-05-01", "2024-05-01", "2024-09-01", "2024-09-01", None,
    ]


def test_pseudonym_of_missing_equals_blank(spark):
    got = one(
        spark, [(None,), ("",), ("aé",)], "x string", pseudonymize(F.col("x"), Salts("p", "s"))
    )
    expected = ["\\x" + hashlib.sha256(t.encode()).hexdigest() for t in ("ps", "ps", "paés")]
    assert [g[0] for g in got] == expected


def test_salts_come_from_the_session_and_do_not_show(spark):
    with pytest.raises(Exception):
        Salts.from_session(spark)
    spark.conf.set("spark.lutrin.secret.prefix", "before")
    spark.conf.set("spark.lutrin.secret.suffix", "after")
    salts = Salts.from_session(spark)
    assert (salts.prefix, salts.suffix) == ("before", "after")
    assert "before" not in repr(salts)
    spark.conf.unset("spark.lutrin.secret.prefix")


def test_normalize_date(spark):
    cases = {
        "2024-01-02 03:04:05": "2024-01-02 03:04:05",
        "2/1/2024 3:04:05": "2024-01-02 03:04:05",
        "02/01/2024 03:04:05": "2024-01-02 03:04:05",
        "10/03/2024 02:30:00": "2024-03-10 02:30:00",
        "2024-01-02 03:04:05.123": "2024-01-02 03:04:05.123",
        "31/02/2024 00:00:00": None,
        "2024-01-02": None,
        "n/a": None,
        "": None,
        None: None,
    }
    got = one(spark, [(c,) for c in cases], "d string", normalize_date(F.col("d")))
    assert [g[0] for g in got] == list(cases.values())


def test_normalize_date_ignores_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Toronto")
    try:
        got = one(spark, [("10/03/2024 02:30:00",)], "d string", normalize_date(F.col("d")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [("2024-03-10 02:30:00",)]


def test_parse_instant_ignores_the_tail(spark):
    got = one(
        spark,
        [("2024-01-02 03:04:05.123",), ("2024-13-02 03:04:05",), (None,)],
        "d string",
        parse_instant(F.col("d")),
        is_iso_instant(F.col("d")),
    )
    assert got == [(datetime(2024, 1, 2, 3, 4, 5), False), (None, True), (None, None)]


def test_date_chunks_cover_without_overlap(spark):
    bounds = spark.createDataFrame(
        [(1, date(2024, 1, 1), date(2024, 1, 25)), (2, date(2024, 1, 1), date(2024, 1, 1)),
         (3, date(2024, 1, 2), date(2024, 1, 1)), (4, date(2024, 1, 1), date(2024, 1, 20))],
        "n int, start date, end date",
    )
    got = rows(date_chunks(bounds, 10).select("n", F.day("debut"), F.day("fin")))
    assert got == sorted([(1, 1, 10), (1, 11, 20), (1, 21, 25), (2, 1, 1), (4, 1, 10), (4, 11, 20)], key=str)


def test_day_in_name(spark):
    got = one(
        spark,
        [("synchro_ac.TXT.20240102",), ("synchro_ac.TXT",), ("a20240301b20250101",), ("x20241301",)],
        "n string",
        day_in_name(F.col("n")),
    )
    assert [g[0] for g in got] == [date(2024, 1, 1), None, date(2024, 2, 29), None]


def test_strip_knows_all_blanks(spark):
    got = one(
        spark, [("  \tab c 　\x1c",), (" ",), ("é",)], "x string", strip(F.col("x"))
    )
    assert [g[0] for g in got] == ["ab c", "", "é"]


def test_blank_and_report(spark):
    got = one(
        spark, [("", 1), (None, None)], "x string, n int",
        blank_to_null(F.col("x")), report_line(["x", "n"]),
    )
    assert got == [(None, "\t1"), (None, "None\tNone")]


def test_levels_and_programme(spark):
    codes = ["1ABCD", "2X", "3", "4", "6M", "CERT", "9ABC", "", None]
    got = one(
        spark, [(c,) for c in codes], "c string", student_level(F.col("c")), programme_of(F.col("c"))
    )
    assert [g[0] for g in got] == [
        "Étudiant - 1er cycle", "Étudiant - 2e cycle", "Étudiant - 3e cycle", "Postdoctorat",
        "Étudiant - Médecine 3e cycle", "Étudiant - Certificat", None, None, None,
    ]
    assert [g[1] for g in got] == ["ABCD", "X", "", "", "M", "ERT", "ABC", "", None]


def test_staff_rules(spark):
    cases = [
        ("P", "Prof", "Personnel", False),
        ("T", None, "Personnel", False),
        ("C", "Chargé(e) de cours", "Chargé de cours", True),
        ("C", "Chargé de cours", "Chargé de cours", False),
        ("C", None, "Chargé de cours", False),
        ("R", "Chercheur invité", "Professeur", True),
        ("R", "Enseignant", "Professeur", True),
        ("R", "Professeur titulaire", "Professeur", True),
        ("R", "Professeur de clinique", "Professeur", False),
        ("R", "Bibliothécaire", "Professeur", False),
        ("R", None, "Professeur", False),
        ("Z", "Prof", None, None),
    ]
    got = one(
        spark, [c[:2] for c in cases], "s string, f string",
        staff_function(F.col("s")), staff_audience(F.col("s"), F.col("f")),
    )
    assert got == [c[2:] for c in cases]
