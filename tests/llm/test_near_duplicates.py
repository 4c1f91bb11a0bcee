import random

import numpy as np
import pyarrow as pa
import pytest

from lutrin.llm import near_duplicates as nd
from lutrin.llm.near_duplicates import near_duplicates

from helpers import docs_of, near_groups, shingles

WORDS = [f"w{i}" for i in range(400)]


def copies(seed, groups=6, each=9):
    """Texts in families: copies with more and more changes."""
    rng = random.Random(seed)
    texts = []
    for _ in range(groups):
        words = [rng.choice(WORDS) for _ in range(rng.randint(5, 60))]
        for _ in range(each):
            own = list(words)
            for _ in range(rng.randint(0, max(1, len(own) // 6))):
                own[rng.randrange(len(own))] = rng.choice(WORDS)
            texts.append(" ".join(own).title() if rng.random() < 0.3 else "  ".join(own))
    return texts


@pytest.mark.parametrize("words, seed", [(2, 1), (5, 2), (2, 3)])
def test_equals_brute_force(spark, words, seed):
    texts = copies(seed) + ["", None, " \t", "one", "ONE", "one two", "one two", "Été été", "long " * 5000]
    rows = near_duplicates(docs_of(spark, texts, clashes=True), words=words, percent=80).collect()
    sizes, least = near_groups(texts, words, 80)
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows) == [
        (i, sizes[i], least[i], least[i] == i) for i in range(len(texts))
    ]


def test_split_buckets_and_groups_give_the_same(spark, monkeypatch):
    for name, value in (("BLOCK", 4), ("BLOCK_MEMBERS", 2), ("SALT_TEXTS", 3)):
        monkeypatch.setattr(nd, name, value)
    texts = copies(4, groups=3, each=30)
    rows = near_duplicates(docs_of(spark, texts), words=2).collect()
    _, least = near_groups(texts, 2, 80)
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(least))


def test_null_and_repeated_ids(spark):
    text = "a b c d e f g h"
    rows = near_duplicates(docs_of(spark, [(None, text), (9, text), (9, text), (4, text), (4, "quite other words here")]), words=2).collect()
    got = sorted((r.doc_id or -1, -1 if r.component_id is None else r.component_id, r.kept) for r in rows)
    assert got == [(-1, -1, True), (4, 4, True), (4, 4, True), (9, 4, False), (9, 4, False)]


def test_empty_table(spark):
    rows = near_duplicates(docs_of(spark, ["a"]).where("false"))
    assert rows.count() == 0 and rows.columns == ["doc_id", "n_shingles", "component_id", "kept", "text_md5"]


def test_no_repeats_at_all(spark):
    rows = near_duplicates(docs_of(spark, ["a b c", "d e f", "g"]), words=2).collect()
    assert all(r.kept and r.component_id == r.doc_id for r in rows)


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(0, 2**63, 900, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:800], rng.integers(0, 2**63, 100, dtype=np.uint64)]))
    one, two, both = nd.sketches([a, b, np.union1d(a, b)])
    assert (np.maximum(one, two) == both).all()
    sketch = np.stack([one, two])
    ok, equal = nd.plausible(sketch, np.array([len(a), len(b)]), np.array([0]), np.array([1]), 0.8)
    assert ok[0] and abs(equal[0] / nd.REGISTERS - 0.8) < 0.2
    other = nd.sketches([rng.integers(0, 2**63, 900, dtype=np.uint64)])
    ok, _ = nd.plausible(np.concatenate([sketch[:1], other]), np.array([900, 900]), np.array([0]), np.array([1]), 0.8)
    assert not ok[0]


def test_shingles_tell_sequences_apart():
    texts = ["a b", "a", "a b c", "b a", "A  b", None, "a b a b"]
    for words in (2, 3, 5):
        got = [frozenset(s.tolist()) for s in nd.shingle_sets(pa.array(texts), words)]
        want = [shingles(t, words) for t in texts]
        for i in range(len(texts)):
            for j in range(len(texts)):
                assert len(got[i] & got[j]) == len(want[i] & want[j])
