import random

import numpy as np
import pytest

from lutrin.llm import long_repeats
from lutrin.llm.long_repeats import blocks_of, remove_repeats

from helpers import docs_of, repeated_spans


def texts_with_repeats(seed, n=40):
    rng = random.Random(seed)
    noise = lambda k: "".join(rng.choice("abcdé ") for _ in range(k))
    passages = [noise(rng.randint(30, 120)) for _ in range(5)]
    texts = []
    for _ in range(n):
        part = rng.choice(passages)
        a, b = sorted((rng.randint(0, len(part)), rng.randint(0, len(part))))
        texts.append(noise(rng.randint(0, 60)) + part[a:b] + noise(rng.randint(0, 60)) + rng.choice(passages + [""] * 5))
    return texts + ["", None, "a" * 39, "a" * 40, "a" * 41, "ab" * 60, texts[0], texts[0], texts[1], "é" * 30]


def compare(spark, texts, length, gram, **options):
    rows = remove_repeats(docs_of(spark, texts, **options), length=length, gram=gram).collect()
    got = {r.doc_id: (r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in rows}
    want = {}
    for i, spans in enumerate(repeated_spans(texts, length)):
        data = (texts[i] or "").encode()
        kept = b"".join(data[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(data)]))
        want[i] = (len(data), spans, kept)
    assert got == want


@pytest.mark.parametrize("seed, length, gram", [(1, 40, 8), (2, 40, 20), (3, 25, 24)])
def test_equals_brute_force(spark, seed, length, gram):
    compare(spark, texts_with_repeats(seed), length, gram, clashes=True)


def test_more_partitions_than_blocks_give_the_same(spark):
    """Contents and grams are cut by partition ends everywhere."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        compare(spark, texts_with_repeats(4, 25), 40, 8)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_grams_with_many_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(long_repeats, "BLOCKS", 3)
    compare(spark, texts_with_repeats(5), 40, 8)


def test_few_windows_at_a_time_give_the_same(monkeypatch):
    import pyarrow as pa

    rng = random.Random(1)
    texts = [bytes(rng.choice(b"ab") for _ in range(30)) for _ in range(40)]
    batch = pa.RecordBatch.from_pydict(
        {
            "gram": pa.array(sorted(rng.randrange(6) for _ in texts), pa.int64()),
            "text": pa.array(texts, pa.binary()),
            "first": pa.array([0] * 40, pa.int64()),
            "before": pa.array([5] * 40, pa.int32()),
            "windows": pa.array([25] * 40, pa.int32()),
            "content": pa.array(texts, pa.binary()),
        }
    )
    found = []
    for size in (1 << 21, 60, 1):
        monkeypatch.setattr(long_repeats, "WINDOWS", size)
        out = long_repeats.compare(6)([batch])
        found.append(sorted(tuple(r.values()) for b in out for r in b.to_pylist()))
    assert found[0] and found[0] == found[1] == found[2]


def test_slices_of_long_texts_keep_every_window(monkeypatch):
    data = np.frombuffer(bytes(random.Random(1).choice(b"abc") for _ in range(5000)), np.uint8)
    for size in (1 << 21, 700, 64):
        monkeypatch.setattr(long_repeats, "SLICE", size)
        with np.errstate(over="ignore"):
            grams, _, anchor, first, last = blocks_of(data, 50, 10)
        windows = [w for a, b in zip(first, last) for w in range(a, b + 1)]
        assert windows == list(range(len(data) - 49))
        assert (anchor >= first).all() and (anchor <= first + 40).all()


def test_equal_windows_have_equal_anchors():
    rng = random.Random(3)
    shared = bytes(rng.choice(b"abcd ") for _ in range(300))
    places = []
    for pad in (b"", b"x" * 37, b"yz" * 100):
        data = np.frombuffer(pad + shared + b"tail" * 30, np.uint8)
        with np.errstate(over="ignore"):
            _, _, anchor, first, last = blocks_of(data, 60, 12)
        places.append([int(a) - w for a, x, y in zip(anchor, first, last) for w in range(x, y + 1)][len(pad) : len(pad) + 241])
    assert places[0] == places[1] == places[2]


def test_ids_and_empty_table(spark):
    text = "x" * 30 + "y" * 30
    rows = remove_repeats(docs_of(spark, [(None, text), (1, text), (1, "z")]), length=40, gram=8).collect()
    assert sorted((r.doc_id or -1, r.n_bytes, bytes(r.kept)) for r in rows) == [(-1, 60, b""), (1, 1, b"z"), (1, 60, b"")]
    assert remove_repeats(docs_of(spark, ["a"]).where("false")).count() == 0
    with pytest.raises(ValueError):
        remove_repeats(docs_of(spark, ["a"]), length=40, gram=40)
