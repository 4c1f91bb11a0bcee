import random

from pyspark.sql import Row

from lutrin.llm import decontamination
from lutrin.llm.decontamination import decontaminate

from helpers import contaminated, docs_of

WORDS = "the of and ontion erst thly ble in a to été 2x".split()


def items_of(spark, items):
    rows = [Row(item_id=k, text=t) for k, t in items]
    return spark.createDataFrame(rows, "item_id long, text string")


def sample(seed, n=60):
    rng = random.Random(seed)
    prose = lambda k: " ".join(rng.choice(WORDS) for _ in range(k))
    items = [prose(rng.choice([3, 9, 10, 14, 25])) for _ in range(12)] + ["", None, "the of and", "?!"]
    texts = []
    for _ in range(n):
        part = rng.choice(items) or ""
        words = part.split()
        cut = words[rng.randint(0, 2) :] if len(words) > 4 else words
        texts.append(" ".join([prose(rng.randint(0, 30)), " ".join(cut).upper().replace(" ", ", "), prose(rng.randint(0, 30))]))
    return texts + ["", None, "the", items[0], "of " * 3000], items


def compare(spark, texts, items):
    found = decontaminate(docs_of(spark, texts, clashes=True), items_of(spark, list(enumerate(items)))).collect()
    got = {r.doc_id: (r.n_words, list(r.hit_words), set(map(int, r.item_ids))) for r in found}
    assert got == dict(enumerate(contaminated(texts, items)))
    assert all(list(r.item_ids) == sorted(r.item_ids) for r in found)


def test_equals_brute_force(spark):
    compare(spark, *sample(1))


def test_small_blocks_and_steps_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 200)
    compare(spark, *sample(2))


def test_proximity(spark):
    docs = docs_of(spark, ["one two x three four", "one two three four", "four three two one", "one two y y y y three four"])
    items = items_of(spark, [(1, "one two three four")])
    exact = decontaminate(docs, items, window=4).where("size(hit_words) > 0").collect()
    near = decontaminate(docs, items, window=4, slop=1).where("size(hit_words) > 0").collect()
    assert [r.doc_id for r in exact] == [1] and sorted(r.doc_id for r in near) == [0, 1]


def test_ids(spark):
    items = items_of(spark, [(None, "a b c"), (5, "a b c"), (5, "d e f"), (10, "d e f")])
    rows = decontaminate(docs_of(spark, [(None, "x a b c d e f"), (3, "a b"), (3, "a b c")]), items).collect()
    got = sorted((r.doc_id or -1, len(r.hit_words), list(r.item_ids)) for r in rows)
    assert got == [(-1, 6, ["10", "5", "null"]), (3, 0, []), (3, 3, ["5", "null"])]


def test_empty_tables(spark):
    items = items_of(spark, [(1, "a b")])
    assert decontaminate(docs_of(spark, ["a"]).where("false"), items).count() == 0
    rows = decontaminate(docs_of(spark, ["a b"]), items.where("false")).collect()
    assert [(r.n_words, list(r.hit_words), list(r.item_ids)) for r in rows] == [(2, [], [])]
