import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lutrin.llm import byte_words as bw

from helpers import lower

PATTERNS = [
    (bw.BLANK_SEPARATED, r"[^\x20\x09-\x0D]+"),
    (bw.ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
]
texts = st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("aB9é ß\t\n.-_ 中\x00"), max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(texts, st.integers(1, 40))
def test_words_are_those_of_the_pattern(values, size):
    for table, pattern in PATTERNS:
        got = []
        for _, data, offsets in bw.chunks(pa.array(values, pa.string()), size):
            low = bw.lower(data)
            starts, ends, first = bw.bounds(low, offsets, table)
            for a, b in zip(first[:-1], first[1:]):
                got.append([low[s:e].tobytes().decode() for s, e in zip(starts[a:b], ends[a:b])])
        assert got == [re.findall(pattern, lower(v)) for v in values]


@settings(max_examples=100, deadline=None)
@given(texts)
def test_hashes_tell_words_apart(values):
    hash_of, word_of = {}, {}
    for _, data, offsets in bw.chunks(pa.array(values, pa.large_string())):
        low = bw.lower(data)
        starts, ends, _ = bw.bounds(low, offsets, bw.BLANK_SEPARATED)
        for s, e, h in zip(starts, ends, bw.hashes(low, starts, ends)):
            word = low[s:e].tobytes()
            assert hash_of.setdefault(word, h) == h and word_of.setdefault(h, word) == word


def test_sliced_arrays_and_long_texts():
    array = pa.array(["drop", "x" * 100, None, "Ab cd"]).slice(1)
    seen = [(row, len(data), list(offsets)) for row, data, offsets in bw.chunks(array, 50)]
    assert seen == [(0, 100, [0, 100]), (1, 5, [0, 0, 5])]
    h = bw.hashes(np.frombuffer(b"abab", np.uint8), np.array([0, 2]), np.array([2, 4]))
    assert h[0] == h[1]
