import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lutrin.llm.packing import cut, encoder, pack, plan, places, sequences

from helpers import docs_of

PATH = public_tokenizers.path("byte_bpe_50k.json")
OWN = Tokenizer.from_file(PATH)
FAST = encoder(PATH)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200))
def test_ids_are_those_of_the_tokenizer(text):
    assert list(FAST(text)) == OWN.encode(text, add_special_tokens=False).ids


def test_ids_of_added_tokens_and_other_files():
    text = "a <|endoftext|> b"
    assert list(FAST(text)) == OWN.encode(text, add_special_tokens=False).ids
    path = public_tokenizers.path("word_bpe_49k.json")
    assert list(encoder(path)("Some words")) == Tokenizer.from_file(path).encode("Some words", add_special_tokens=False).ids


def test_cut_leaves_the_remainder_first():
    assert cut(10, 4) == [0, 2, 6, 10]
    assert cut(8, 4) == [0, 4, 8]
    assert cut(3, 4) == [0, 3]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=30))
def test_plan_holds_every_length_once(histogram):
    groups = plan(histogram, 64)
    held = {}
    for n, content in groups:
        assert n > 0 and sum(length * k for length, k in content) <= 64
        for length, k in content:
            held[length] = held.get(length, 0) + n * k
    assert held == histogram
    sequences_, least = sum(n for n, _ in groups), -(-sum(k * n for k, n in histogram.items()) // 64)
    assert least <= sequences_ <= max(2 * least, 1)
    for length, (first, _, _, _) in places(groups, 64).items():
        assert first[0] == 0 and (np.diff(first) > 0).all() and first[-1] < histogram[length]


def test_plan_is_close_to_the_least():
    rng = np.random.default_rng(5)
    lengths = np.minimum(2048, rng.lognormal(6.5, 1, 50_000).astype(int) + 1)
    histogram = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True))}
    assert sum(n for n, _ in plan(histogram, 2048)) <= 1.005 * (lengths.sum() / 2048)


def check(rows, texts, capacity):
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    assert len(pieces) == len(texts)
    by_sequence = {}
    for i, text in enumerate(texts):
        ids = [*OWN.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted(pieces[i], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert all(r.length == capacity for r in own[1:])
        at = 0
        for r in own:
            part = np.array(ids[at : at + r.length], "<u4")
            assert (r.start, r.length, r.ids_crc32) == (at, len(part), zlib.crc32(part.tobytes()))
            at += r.length
            by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert at == len(ids)
    for slots in by_sequence.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= capacity
    return by_sequence


def test_pack_on_odd_texts(spark):
    rng = random.Random(1)
    texts = ["", None, "a", "a", "word " * 500, "é中\U0001f600 \x00", " ", "same text here"] + [
        " ".join(rng.choice(["alpha", "beta", "of", "the", "ontion"]) for _ in range(rng.randint(1, 60))) for _ in range(150)
    ]
    packed = pack(docs_of(spark, texts, clashes=True), PATH, 64, with_ids=True).cache()
    by_sequence = check(packed.collect(), texts, 64)
    whole = sequences(packed).collect()
    assert {r.sequence_id: r.length for r in whole} == {s: sum(n for _, n in v) for s, v in by_sequence.items()}
    assert all(len(r.ids) == r.length for r in whole)


def test_pack_of_null_and_repeated_ids_and_no_rows(spark):
    rows = pack(docs_of(spark, [(None, "a"), (7, "b c"), (7, "b c")]), PATH, 16).collect()
    assert sorted((r.doc_id or 0, r.length) for r in rows) == [(0, 2), (7, 3), (7, 3)]
    empty = pack(docs_of(spark, ["x"]).where("false"), PATH)
    assert empty.count() == 0 and empty.columns[-2:] == ["sequence_id", "offset"]


@pytest.mark.parametrize("parts", [1, 5])
def test_pack_does_not_depend_on_partitions(spark, parts):
    texts = [f"number {i % 17} and " + "x " * (i % 23) for i in range(200)]
    packed = pack(docs_of(spark, texts).repartition(parts), PATH, 32)
    by_sequence = check(packed.collect(), texts, 32)
    total = sum(n for slots in by_sequence.values() for _, n in slots)
    assert len(by_sequence) <= 1.02 * total / 32 + 1
