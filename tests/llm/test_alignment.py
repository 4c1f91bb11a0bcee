"""Token alignment against brute force with the tokenizers themselves."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lutrin.llm.alignment import align_tokens, byte_level, frame, least_frequent, overlaps, piece_level
from lutrin.llm.packing import byte_of_symbol
from tests.llm.helpers import docs_of

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    "The quick brown fox jumps over the lazy dog.",
    "The quick brown fox jumps over the lazy dog.",
    "  two  blanks\n\nand\tlines \r\n",
    "Größe, naïve ünïcode – “quotes” … 漢字かな 😀👩‍👩‍👧 العربية",
    "",
    None,
    " ",
    "▁ is not a space",
    "a ▁b",
    "<|endoftext|> is text here, <s> and </s> and <unk> and <0x41> too",
    "ﬁne ligature ½ ①",
    "x\x00y\x01z",
    "word " * 3000,
    "1234567890" * 20,
    "é é   　 ​",
]


def brute(texts):
    a, b = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    a.encode_special_tokens = True
    symbols = byte_of_symbol()
    out, counts = [], {}
    for text in texts:
        text = text or ""
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        bytes_a = [bytes(symbols[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
        want = (" " + text).encode()
        if not text or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            out.append((0, 0, [], []))
            continue
        ends_a, ends_b, at = [], [], 0
        for p in bytes_a:
            ends_a.append(at := at + len(p))
        at = 0
        for p in bytes_b:
            ends_b.append(at := at + len(p))
        links = [(ids_a[ends_a.index(e)], ids_b[ends_b.index(e)]) for e in sorted(set(ends_a) & set(ends_b))]
        groups, low = [], 0
        for e in sorted(set(ends_a) & set(ends_b)):
            groups.append(",".join(str(i) for i, x in zip(ids_a, ends_a) if low < x <= e) + "|" + ",".join(str(i) for i, x in zip(ids_b, ends_b) if low < x <= e))
            low = e
        out.append((len(ids_a), len(ids_b), groups, links))
        for link in links:
            counts[link] = counts.get(link, 0) + 1
    top = {}
    for (_, y), n in counts.items():
        top[y] = max(top.get(y, 0), n)
    return [
        (
            n_a,
            n_b,
            len(groups),
            len(links),
            sum(counts[x] == top[x[1]] for x in links),
            sum(counts[x] for x in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "",
        )
        for n_a, n_b, groups, links in out
    ]


def found(df):
    return {r.doc_id: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("most", [1_000_000, 40, 0])
def test_equals_brute_force(spark, most):
    short = [t for t in TEXTS if not t or len(t) < 500]
    want = brute(short)
    got = found(align_tokens(docs_of(spark, short, clashes=True), BYTE, PIECE, most=most))
    assert [got[i] for i in range(len(short))] == want


def test_long_text_and_repeated_rows(spark):
    got = align_tokens(docs_of(spark, [(1, TEXTS[12]), (1, TEXTS[12]), (None, TEXTS[0])]), BYTE, PIECE).collect()
    assert len(got) == 3 and {r.doc_id for r in got} == {1, None}
    one, other = (r for r in got if r.doc_id == 1)
    assert one == other and one.n_groups == one.n_links > 2000 and one.count_sum > 2 * 2900**2


def test_empty_table(spark):
    assert align_tokens(docs_of(spark, ["x"]).where("false"), BYTE, PIECE).collect() == []


def test_real_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if len(r.text or "") < 2500]
    want = brute([t for _, t in texts])
    got = found(align_tokens(docs.where("text IS NULL OR length(text) < 2500"), BYTE, PIECE))
    assert got == {k: w for (k, _), w in zip(texts, want)}


def test_overlaps_are_all_pairs_that_share_a_byte():
    rng = random.Random(1)
    import numpy as np

    sizes = np.arange(1, 6)
    for _ in range(50):
        docs_a, docs_b = [], []
        for _ in range(4):
            n = rng.randint(0, 12)
            for docs in (docs_a, docs_b):
                left, ids = n, []
                while left:
                    size = rng.randint(1, min(5, left))
                    ids.append(size - 1)
                    left -= size
                docs.append(ids)
        a, b = frame(docs_a, sizes), frame(docs_b, sizes)
        got = sorted(zip(*(x.tolist() for x in overlaps(a, b))))
        assert got == [(i, j) for i, x in enumerate(a.itertuples()) for j, y in enumerate(b.itertuples()) if x.start < y.end and y.start < x.end]


def test_bytes_of_ids():
    assert piece_level(PIECE)[1][3 + 0x41] == b"A"
    encode, pieces = byte_level(BYTE)
    assert b"".join(pieces[i] for i in encode([" ü<|endoftext|>"])[0]) == " ü<|endoftext|>".encode()


def test_frequent_pairs_are_bounded(spark):
    counts = spark.createDataFrame([(i, n) for i, n in enumerate([1, 1, 1, 2, 3, 4, 9])], "pair long, n long")
    assert [least_frequent(counts, m) for m in (7, 6, 4, 3, 2, 1)] == [1, 2, 2, 4, 4, 8]
    assert least_frequent(counts, 0) > 9
