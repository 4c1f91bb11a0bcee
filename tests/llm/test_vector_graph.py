import numpy as np
import pytest
from pyspark.sql import functions as F

from lutrin.llm import vector_graph as vg
from lutrin.llm.vector_graph import link_vectors

from helpers import groups


def frame(spark, vectors, ids=None):
    rows = [(i if ids is None else ids[i], None if v is None else [None if x is None else float(x) for x in v], "x") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, vector string").selectExpr("*", "'x' AS node", "1 AS shard").repartition(3)


def brute(vectors, threshold=0.95):
    with np.errstate(invalid="ignore", divide="ignore"):
        x = np.array(vectors, np.float32).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    return near.sum(1), groups(len(x), list(zip(*np.nonzero(near))))


def families(seed, n=600, dim=24, group=80):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x[:group] = x[0] + 0.12 * rng.normal(size=(group, dim))
    for i in range(group, group + 60, 2):
        x[i + 1] = x[i] + 0.1 * rng.normal(size=dim)
    x[n - 5 :] = 3 * x[n - 6]
    return x[rng.permutation(n)]


def check(spark, vectors):
    rows = {r.vec_id: r for r in link_vectors(frame(spark, vectors)).collect()}
    links, least = brute(vectors)
    found = np.array([rows[i].n_links for i in range(len(vectors))])
    assert (found <= links).all() and found.sum() >= 0.9 * links.sum()
    assert np.mean([rows[i].component_id == least[i] for i in range(len(vectors))]) > 0.98
    assert all(rows[i].kept == (rows[i].component_id == i) for i in rows)
    assert rows[0].recall >= 0.9


def test_against_all_pairs(spark):
    check(spark, families(1))


def test_overlapping_shards_and_split_shards(spark, monkeypatch):
    monkeypatch.setattr(vg, "PER_PIVOT", 60)
    check(spark, families(2))
    monkeypatch.setattr(vg, "PER_PIVOT", 800)
    monkeypatch.setattr(vg, "BLOCK", 100)
    check(spark, families(3))


def test_small_families_beside_a_large_one(spark, monkeypatch):
    """Pairs just within the range are found, and counted from both ends, beside a family of a third of the rows."""
    monkeypatch.setattr(vg, "BLOCK", 1000)
    rng = np.random.default_rng(5)
    center = rng.normal(size=64)
    large = center + 0.01 * rng.normal(size=(1500, 64))
    first = rng.normal(size=(1500, 64))
    first /= np.linalg.norm(first, axis=1, keepdims=True)
    away = rng.normal(size=first.shape)
    away -= (away * first).sum(1, keepdims=True) * first
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    vectors = np.concatenate([large, first, 0.951 * first + np.sqrt(1 - 0.951**2) * away])
    rows = {r.vec_id: r for r in link_vectors(frame(spark, vectors)).collect()}
    links, least = brute(vectors)
    assert [rows[i].n_links for i in rows] == [links[i] for i in rows]
    assert [rows[i].component_id for i in rows] == [least[i] for i in rows]


def test_a_missed_target_stops(spark, monkeypatch):
    monkeypatch.setattr(vg, "PER_PIVOT", 20)
    monkeypatch.setattr(vg, "OVERLAP", 1)
    monkeypatch.setattr(vg, "ATTEMPTS", 1)
    with pytest.raises(RuntimeError, match="of a vector's links"):
        link_vectors(frame(spark, families(4, n=900, dim=4, group=300))).collect()


def test_columns_that_clash(spark):
    df = frame(spark, families(6, n=100, group=10))
    for name in "vector node shard block part asked copies component neighbours id n row truth recall".split():
        df = df.withColumn(name, F.lit("x"))
    assert link_vectors(df).count() == 100


def test_vectors_that_link_with_nothing(spark):
    good = [1.0, 2.0, 3.0]
    vectors = [good, None, [], [0.0] * 3, [1.0, None, 3.0], [1.0, float("nan"), 3.0], [float("inf"), 2.0, 3.0], good, [2.0, 4.0, 6.0], [1.0, 2.0], [1e-30] * 3]
    rows = sorted(link_vectors(frame(spark, vectors)).collect(), key=lambda r: r.vec_id)
    assert [r.n_links for r in rows] == [2, 0, 0, 0, 0, 0, 0, 2, 2, 0, 0]
    assert [r.component_id for r in rows] == [0, 1, 2, 3, 4, 5, 6, 0, 0, 9, 10]
    assert [r.kept for r in rows] == [True] * 7 + [False] * 2 + [True] * 2


def test_ids_and_empty_table(spark):
    rows = link_vectors(frame(spark, [[1, 0], [1, 0], [1, 0.01], [0, 1]], [None, 5, 3, 3])).collect()
    got = sorted((r.vec_id or -1, r.n_links, -1 if r.component_id is None else r.component_id, r.kept) for r in rows)
    assert got == [(-1, 2, -1, True), (3, 0, 3, True), (3, 2, 3, True), (5, 2, 3, False)]
    assert link_vectors(frame(spark, [[1, 0]]).where("false")).count() == 0
    assert link_vectors(frame(spark, [None, [0, 0]])).count() == 2


def test_pruning_keeps_the_nearest_and_hides_what_lies_behind():
    x = np.array([[1, 0], [0.99, 0.1], [0.98, 0.15], [0, 1]], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = vg.pruned(x, np.array([[1, 2, 3, -1]] + [[-1] * 4] * 3), 3)
    assert out[0].tolist() == [1, 3, -1]


@pytest.mark.parametrize("n", [1, 2, 3, 40])
def test_graph_of_few_vectors(n):
    x = np.random.default_rng(n).normal(size=(n, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    row, found = vg.search(x, vg.graph(x, 1, 0.99)[0], x, np.arange(n), 0.99, 8)
    assert sorted(zip(row.tolist(), found.tolist())) == [(i, i) for i in range(n)]


def test_chained_rows_are_reached():
    """Many rows with one nearest vector: all of them are found from any of them."""
    rng = np.random.default_rng(1)
    center = rng.normal(size=32)
    x = np.concatenate([center[None, :], center + 0.15 * rng.normal(size=(400, 32)), rng.normal(size=(300, 32))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    row, found = vg.search(x, vg.graph(x, 1, 0.95)[0], x, np.arange(len(x)), 0.95, 24)
    assert len(row) >= 0.99 * (x @ x.T >= 0.95).sum()


def test_forest_joins_what_the_pairs_join():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 300, 200), rng.integers(0, 300, 200)
    x, y = vg.forest(a, b)
    assert groups(300, zip(a, b)) == groups(300, zip(x, y)) and len(x) < 300
