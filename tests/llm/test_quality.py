"""Quality scores: held-out accuracy, folds that are never learned from, parts against plain versions."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lutrin.llm import quality as q
from tests.llm.helpers import docs_of


def describe(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["doc_id", "text"])
    rows = [r for out in q.describe([batch]) for r in out.column(1).to_pylist()]
    return [dict(zip(q.STATISTICS, r)) for r in rows]


def plain(text):
    """Some of the statistics, the long way."""
    data = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    lines = re.findall(rb"[^\n\r]+", data)
    low = [w.lower() for w in words]
    n, k = max(len(data), 1), max(len(words), 1)
    share = {b: data.count(bytes([b])) / n for b in set(data)}
    return {
        "bytes": math.log1p(len(data)),
        "words": math.log1p(len(words)),
        "lines": math.log1p(len(lines)),
        "upper": sum(65 <= b < 91 for b in data) / n,
        "beyond": sum(b > 127 for b in data) / n,
        "long_words": sum(len(w) > 16 for w in words) / k,
        "distinct_words": len(set(low)) / k,
        "commonest": max(map(low.count, low), default=0) / k,
        "repeated_next": sum(a == b for a, b in zip(low, low[1:])) / max(len(words) - 1, 1),
        "distinct_pairs": len(set(zip(low, low[1:]))) / max(len(words) - 1, 1),
        "entropy": -sum(p * math.log2(p) for p in share.values()),
        "distinct_lines": len(set(lines)) / max(len(lines), 1),
        "full_lines": sum(line[-1:] in b".,;:!?'\"()-" for line in lines) / max(len(lines), 1),
        "marked_ends": sum(w[-1:] in b".,;:!?'\"()-" for w in words) / k,
        "symbol_ends": sum(chr(w[-1]) in "#$%&*+/<=>@[\\]^_`{|}~" for w in words) / k,
    }


TEXTS = ["", None, " ", "\n\n", "one", "One two two.", "A b\nA b\n\nc! d!!", "é ü 漢字 word", "x" * 40, "THE END IS | NEAR | $$$ &&&", "a b " * 500, "a", "\x00\x01 z"]


def test_statistics_equal_plain_ones():
    for text, own in zip(TEXTS, describe(TEXTS)):
        for name, want in plain(text).items():
            assert own[name] == pytest.approx(want, abs=1e-9), (text, name)
        assert all(map(math.isfinite, own.values()))


def test_a_text_is_described_alone():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab .\nÄ!|") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    together = describe(texts)
    for text, own in zip(texts, together):
        assert own == pytest.approx(describe([text])[0], abs=1e-9)


def test_very_long_text():
    assert describe(["x", "wort " * 600_000, "y"])[1]["words"] == pytest.approx(math.log1p(600_000))


def test_isotonic_is_the_best_rising_fit():
    rng = np.random.default_rng(0)
    for _ in range(30):
        bins = [(k, int(rng.integers(1, 5)), 0) for k in sorted(rng.choice(40, 8, replace=False).tolist())]
        bins = [(k, n, int(rng.integers(0, n + 1))) for k, n, _ in bins]
        middle, share = q.isotonic(bins)
        assert (np.diff(share) >= 0).all() and (np.diff(middle) > 0).all()
        at = q.LOW + (q.HIGH - q.LOW) * (np.array([b[0] for b in bins]) + 0.5) / q.BINS
        got = np.interp(at, middle, share)
        n, good = np.array([b[1] for b in bins]), np.array([b[2] for b in bins])
        # min-max formula of isotonic regression
        want = [max(min(good[a : b + 1].sum() / n[a : b + 1].sum() for b in range(i, len(bins))) for a in range(i + 1)) for i in range(len(bins))]
        assert got == pytest.approx(want)


def test_features_approximate_the_gaussian_kernel():
    kernel = q.Kernel(np.zeros(len(q.STATISTICS)), np.ones(len(q.STATISTICS)))
    x = np.random.default_rng(1).normal(size=(20, len(q.STATISTICS)))
    z = kernel(x)[:, :-1]
    distance = ((x[:, None] - x[None]) ** 2).sum(2)
    want = np.exp(-distance / (2 * q.WIDTH**2 * len(q.STATISTICS)))
    assert np.abs(z @ z.T - want).max() < 0.25 and np.abs(z @ z.T - want).mean() < 0.06


def test_ridge_solves_its_equations():
    rng = np.random.default_rng(2)
    z = np.concatenate([rng.normal(size=(50, 5)), np.ones((50, 1))], 1)
    y = rng.normal(size=50)
    got = q.ridge(np.concatenate([z.T @ z, (z.T @ y)[:, None]], 1))
    assert ((z @ got - y) ** 2).sum() <= ((z @ np.linalg.lstsq(z, y, rcond=None)[0] - y) ** 2).sum() + 1e-3


def score(docs, labels, **options):
    return {r.doc_id: r for r in q.quality_scores(docs, labels, **options).collect()}


def test_held_out_rows_are_judged_right_and_never_learned(spark):
    path = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    found = score(docs, labels)
    held = {k for k, r in found.items() if r.held_out}
    assert held == {k for k in found if zlib.crc32(str(k).encode()) % 5 == 0}
    known = {r.doc_id: r.quality for r in labels.collect()}
    right = [found[k].predicted == known[k] for k in held & set(known)]
    assert len(right) > 40 and np.mean(right) > 0.95
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in found.values())
    turned = labels.withColumn("quality", F.when(q.fold_of("doc_id") == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.col("doc_id"))
    again = score(other, turned)
    assert all(abs(again[k].score - r.score) < 1e-9 for k, r in found.items())


def test_odd_tables(spark):
    texts = [(1, "Good prose, with words. And more."), (1, None), (None, "x"), (2, ""), (3, "BAD!! BAD!!"), (4, "Good prose, with words. And more.")]
    docs = docs_of(spark, texts, clashes=True).withColumn("good", F.lit("x")).withColumn("fold", F.lit("x")).withColumn("features", F.lit("x"))
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (3, 0, 0), (3, 0, 1), (4, None, 0), (None, 1, 1), (9, 1, 0)], "doc_id long, quality int, toxic int")
    rows = q.quality_scores(docs, labels).collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 for r in rows)
    assert {r.held_out for r in rows if r.doc_id is None} == {True}
    prose = [r.score for r in rows if r.doc_id == 4]
    assert any(abs(r.score - prose[0]) < 1e-12 for r in rows if r.doc_id == 1)  # equal texts
    one = q.quality_scores(docs, labels.where("quality = 0")).collect()
    assert {round(r.score, 6) for r in one} == {0.0}
    none = q.quality_scores(docs, labels.where("false")).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)}
    assert q.quality_scores(docs.where("false"), labels).collect() == []
