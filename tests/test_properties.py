"""Operators against plain Python models, on random data; one Spark job per property."""

import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from lutrin.functions.dates import date_chunks, normalize_date, term_start
from lutrin.operators import aggregates as A
from lutrin.operators import links, lookups, merge


def cases(n=40, seed=7):
    return [random.Random(seed + i) for i in range(n)]


def test_upsert_against_a_dictionary(spark):
    target, source, expected = [], [], {}
    for case, rng in enumerate(cases()):
        old = {k: (rng.choice("ab"), rng.choice("cd"), rng.choice([None, "e"])) for k in rng.sample(range(9), 4)}
        new = {k: (rng.choice([None, "A"]), rng.choice("CD"), rng.choice([None, "E"])) for k in rng.sample(range(9), 4)}
        target += [(case, k, *v) for k, v in old.items()]
        source += [(case, k, *v) for k, v in new.items()]
        for k in old.keys() | new.keys():
            if k not in new:
                expected[case, k] = old[k]
            else:
                fill = new[k][2] if new[k][2] is not None or k not in old else old[k][2]
                expected[case, k] = (new[k][0], None, fill)
    schema = "c int, k int, u string, r string, f string"
    merged = merge.upsert(
        spark.createDataFrame(target, schema), spark.createDataFrame(source, schema), ["c", "k"],
        update=["u"], reset=["r"], fill=["f"],
    )
    assert {(x.c, x.k): (x.u, x.r, x.f) for x in merged.collect()} == expected


def test_latest_by_against_sorting(spark):
    data = [
        (case, rng.randrange(4), rng.randrange(3), i)
        for case, rng in enumerate(cases()) for i in range(12)
    ]
    got = merge.latest_by(
        spark.createDataFrame(data, "c int, k int, d int, i int"), ["c", "k"], [F.desc("d"), F.asc("i")]
    )
    expected = {}
    for row in sorted(data, key=lambda r: (-r[2], r[3])):
        expected.setdefault(row[:2], row)
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected.values())


def test_insert_new_against_a_dictionary(spark):
    target, source, expected = [], [], {}
    for case, rng in enumerate(cases()):
        have = {k: "old" for k in rng.sample(range(8), 3)}
        target += [(case, k, v) for k, v in have.items()]
        for k in [rng.randrange(8) for _ in range(6)]:
            v = rng.choice("abc")
            source.append((case, k, v))
            if have.get(k) != "old":
                have[k] = min(have.get(k, v), v)
        expected |= {(case, k): v for k, v in have.items()}
    schema = "c int, k int, v string"
    got = merge.insert_new(
        spark.createDataFrame(target, schema), spark.createDataFrame(source, schema), ["c", "k"], [F.asc("v")]
    )
    assert {(r.c, r.k): r.v for r in got.collect()} == expected


def test_link_against_a_dictionary(spark):
    rng = random.Random(3)
    people = {f"p{i}": rng.choice([None, "D1", "D2"]) for i in range(60)}
    facts = [
        (i, rng.choice(["p0", "p0", "p1", "", None, f"p{rng.randrange(90)}"])) for i in range(3000)
    ]
    got = links.link(
        spark.createDataFrame(facts, "i int, mail string"),
        spark.createDataFrame(list(people.items()), "mail_key string, d string"),
        "mail", "mail_key", {"d": "d", "mail_key": "who"},
    )
    expected = {i: (m if m in people else None, people.get(m)) for i, m in facts}
    rows = got.collect()
    assert len(rows) == len(facts) and {r.i: (r.who, r.d) for r in rows} == expected


def test_lookup_chain_against_a_loop(spark):
    tables, data = [defaultdict(set) for _ in range(3)], []
    rng = random.Random(5)
    for table in tables:
        for _ in range(6):
            table[rng.choice("abcdef")].add(rng.choice(["x", "y", "z", None]))
    data = [(i, rng.choice(["a", "b", "c", "d", "e", "f", "g", None])) for i in range(300)]

    def smallest(values):
        return min((v for v in values if v is not None), default=None)

    def expected(key):
        for table in tables:
            if smallest(table.get(key, [])) is not None:
                return smallest(table[key])
        return None

    frames = [
        spark.createDataFrame([(k, v) for k, vs in t.items() for v in vs], "k string, v string") for t in tables
    ]
    got = lookups.lookup_chain(
        spark.createDataFrame(data, "i int, key string"), [(f, [("key", "k")], "v") for f in frames], "out"
    )
    assert {r.i: r.out for r in got.collect()} == {i: expected(k) for i, k in data}


def test_chunks_cover_each_day_once(spark):
    data = []
    for case, rng in enumerate(cases()):
        start = date(2020, 1, 1) + timedelta(days=rng.randrange(2000))
        data.append((case, start, start + timedelta(days=rng.randrange(60))))
    bounds = spark.createDataFrame(data, "c int, start date, end date")
    for days in (1, 7, 10):
        seen = defaultdict(list)
        for r in date_chunks(bounds, days).collect():
            assert (r.fin - r.debut).days < days
            seen[r.c] += [r.debut + timedelta(days=i) for i in range((r.fin - r.debut).days + 1)]
        for case, start, end in data:
            assert sorted(seen[case]) == [start + timedelta(days=i) for i in range((end - start).days + 1)]


def test_terms_against_months(spark):
    days = [date(2023, 1, 1) + timedelta(days=i) for i in range(730)]
    got = spark.createDataFrame([(d,) for d in days], "d date").select("d", term_start(F.col("d")).alias("t"))
    for r in got.collect():
        assert r.t == date(r.d.year, 9 if r.d.month >= 9 else 5 if r.d.month >= 5 else 1, 1)


def test_day_first_dates_against_python(spark):
    data = []
    for i in range(800):
        rng = random.Random(i)
        data.append((rng.randrange(1, 33), rng.randrange(1, 14), rng.randrange(1900, 2100), rng.randrange(25), rng.randrange(61), rng.randrange(60)))

    def text(d, m, y, h, mi, s, pad):
        return f"{d:{pad}}/{m:{pad}}/{y} {h:{pad}}:{mi:{pad}}:{s:{pad}}"

    def expected(d, m, y, h, mi, s):
        try:
            from datetime import datetime

            return datetime(y, m, d, h, mi, s).strftime("%Y-%m-%d %H:%M:%S")
        except ValueError:
            return None

    frame = spark.createDataFrame(
        [(i, text(*v, pad), expected(*v)) for i, v in enumerate(data) for pad in ("", "02")], "i int, t string, e string"
    )
    assert frame.filter(~normalize_date(F.col("t")).eqNullSafe(F.col("e"))).collect() == []


def test_statistics_add_up_to_the_population(spark):
    """Over the librarians of a discipline, shares of its people add up to its people."""
    rng = random.Random(11)
    listed = [(f"D{d}", f"L{d}-{n}", "B", "S") for d in range(7) for n in range(rng.randrange(1, 8))]
    disciplines = A.split_factor(
        spark.createDataFrame(listed, "discipline string, bibliothecaire string, bibliotheque string, secteur string")
    )
    people = [(f"u{i}", f"D{rng.randrange(7)}", "Étudiant", rng.choice("abc"), "t") for i in range(2000)]
    frame = spark.createDataFrame(people, "usager string, discipline string, fonction string, niveau string, session string")
    totals = defaultdict(Decimal)
    for r in A.weighted_population(frame, disciplines, "Personnel").collect():
        totals[r.discipline, r.niveau] += r.nb_personnes
    counted = defaultdict(int)
    for p in people:
        counted[p[1], p[3]] += 1
    assert totals.keys() == counted.keys()
    assert all(abs(totals[k] - counted[k]) < Decimal("1e-16") for k in totals)
