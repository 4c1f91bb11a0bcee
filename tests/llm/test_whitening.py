"""Whitening against exact brute force."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import types as T

from lutrin.llm.whitening import BLOCK, planes, scatter, whiten

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


def table(spark, vectors, clashes=False):
    df = spark.createDataFrame([(i if not isinstance(v, tuple) else v[0], v[1] if isinstance(v, tuple) else v, 0) for i, v in enumerate(vectors)], SCHEMA)
    if clashes:
        for name in ("x", "n", "i", "j", "dim", "component", "size", "total", "deviation", "whitened"):
            df = df.selectExpr("*", f"'x' AS {name}")
    return df.repartition(3)


def integers(vectors):
    out = []
    for v in vectors:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            out.append([math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v])
    return out


def brute(x):
    """Exact covariance and deviations, in fractions."""
    n, d = len(x), len(x[0])
    s = [sum(row[k] for row in x) for k in range(d)]
    v = [[sum(Fraction(n * r[i] - s[i], n) * Fraction(n * r[j] - s[j], n) for r in x) / n for j in range(d)] for i in range(d)]
    return s, np.array([[float(c) for c in row] for row in v]), [sum((n * r[k] - s[k]) ** 2 for k in range(d)) for r in x]


def random_vectors(n, d, seed=0, scale=1.0):
    rng = np.random.default_rng(seed)
    return [[float(c) for c in row] for row in (rng.normal(size=(n, d)) * scale * np.arange(1, d + 1)).astype(np.float32)]


@pytest.mark.parametrize("scale", [1.0, 1e-2, 1e3])
def test_equals_exact_brute_force(spark, scale):
    vectors = random_vectors(300, 6, scale=scale)
    x = integers(vectors)
    s, covariance, deviation = brute(x)
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(-values)
    rows = whiten(table(spark, vectors, clashes=True), components=4).collect()
    kept = [k for k in order[:4] if values[k] > 1e-12 * values.max()]
    assert len(rows) == 300 * len(kept)
    centred = np.array([[float(Fraction(300 * a - b, 300)) for a, b in zip(row, s)] for row in x])
    for place, k in enumerate(kept, 1):
        own = {r.vec_id: r for r in rows if r.component == place}
        want = centred @ axes[:, k] / math.sqrt(values[k])
        got = np.array([own[i].whitened for i in range(300)])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-6 * max(1, np.abs(want).max())
        assert [own[i].deviation for i in range(300)] == deviation
        assert {r.n for r in own.values()} == {300}
        assert abs(own[0].explained - values[k] / values.sum()) < 1e-9
        assert own[0].identity_error < 1e-6


def test_scatter_is_exact():
    rng = np.random.default_rng(1)
    import pyarrow as pa

    for high in (2, 200, 1 << 50):
        x = rng.integers(-high, high, (BLOCK + 77, 5))
        low = [int(v) for v in x.min(0)]
        bits = [int(h - v).bit_length() for h, v in zip(x.max(0), low)]
        batch = pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.int64()))], ["x"])
        out = pa.Table.from_batches(list(scatter(low, bits)([batch])))
        for i, j, total in zip(*(c.to_pylist() for c in out.columns)):
            assert int(total) == sum((int(a) - low[i]) * (int(b) - low[j]) for a, b in zip(x[:, i], x[:, j]))


def test_planes_hold_every_bit():
    x = np.array([[5, -3], [0, 4], [7, 4]])
    own = planes(x, [0, -3], [3, 3])
    assert own[:, 0].tolist() == [0b101, 0b100, 0b101, 0b110, 0b110, 0b110]


def test_rows_that_are_dropped_and_carried(spark):
    good = random_vectors(40, 3)
    odd = [None, [1.0, None, 2.0], [1.0, float("nan"), 2.0], [float("inf"), 0.0, 0.0], [3e38, 0.0, 0.0], []]
    vectors = good + odd + [(None, good[0]), (7, good[0])]
    rows = whiten(table(spark, vectors), components=3).collect()
    ids = [r.vec_id for r in rows if r.component == 1]
    assert sorted(i for i in ids if i is not None) == sorted([*range(40), 7]) and ids.count(None) == 1
    assert {r.n for r in rows} == {42}
    _, _, deviation = brute(integers(good + [good[0], good[0]]))
    assert {r.deviation for r in rows if r.vec_id is None} == {deviation[0]}


def test_sizes_are_fitted_alone(spark):
    first, second = random_vectors(30, 2), random_vectors(50, 3, seed=3)
    rows = whiten(table(spark, first + second)).collect()
    assert {r.n for r in rows if r.vec_id < 30} == {30} and {r.n for r in rows if r.vec_id >= 30} == {50}
    assert len(rows) == 30 * 2 + 50 * 3


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None, None], [[], []]])
def test_without_variance_there_are_no_rows(spark, vectors):
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA)
    assert whiten(df).collect() == []


def test_large_deviations_are_exact_or_stop(spark):
    vectors = [[0.0, 1.0]] * 10 + [[1e9, 0.0]]
    x = integers(vectors)
    _, _, deviation = brute(x)
    if max(deviation) >= 1 << 63:
        with pytest.raises(Exception, match="[Oo]verflow|too large|out of"):
            whiten(table(spark, vectors)).collect()
    rows = whiten(table(spark, [[0.0, 1.0]] * 10 + [[1e6, 0.0]])).collect()
    _, _, deviation = brute(integers([[0.0, 1.0]] * 10 + [[1e6, 0.0]]))
    assert {r.vec_id: r.deviation for r in rows if r.component == 1} == dict(enumerate(deviation))
