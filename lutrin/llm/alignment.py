"""Alignment of the tokens of two tokenizers.

Both tokenizers cut the same bytes. In a task every token becomes its byte range in a batch of
texts. Two `merge_asof` joins, keyed by document, look up for each token start the other
side's token that covers it; together they give every pair of ranges that overlap. Pairs that
end together are links, and their ends cut a document into groups.

How often a pair of ids is linked in the corpus is added up by Spark. The frequent pairs, as
many as a bounded table takes, are then looked up in the tasks; the rare ones, none of which
is a hot key, are joined.
"""

import hashlib
import json

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from lutrin.llm.common import Scratch, is_empty
from lutrin.llm.packing import byte_of_symbol, rank_encoder

#: Bytes of text whose tokens are joined at a time; a longer text comes alone.
CHUNK_BYTES = 1 << 20
#: Pairs of ids with their counts that a task holds: looked up in, or added up before they are written.
FREQUENT, PENDING = 1_000_000, 1_000_000
#: Ids of the second tokenizer are below this.
SIDE = 1 << 31


def byte_level(path):
    """(encode, bytes of each id) of a byte-level BPE file whose special tokens are plain text."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab = spec["model"]["vocab"] | {token["content"]: token["id"] for token in spec.get("added_tokens", [])}
    symbols = byte_of_symbol()
    pieces = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        pieces[i] = bytes(symbols[c] for c in token) if all(c in symbols for c in token) else token.encode()
    fast = rank_encoder(path)
    if fast:
        return lambda texts: [fast(text) for text in texts], pieces
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    return lambda texts: [e.ids for e in own.encode_batch(texts, add_special_tokens=False)], pieces


def piece_level(path):
    """(encode, bytes of each id) of a sentence piece model."""
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = []
    for i in range(own.get_piece_size()):
        piece = own.id_to_piece(i)
        pieces.append(bytes([int(piece[3:5], 16)]) if own.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(texts):
        return own.encode(texts, num_threads=1)

    return encode, pieces


_tokenizers = {}


def tokenizer(kind, path):
    """A tokenizer, read once in a worker process."""
    if (kind, path) not in _tokenizers:
        encode, pieces = {"byte": byte_level, "piece": piece_level}[kind](path)
        _tokenizers[kind, path] = encode, pieces, np.array([len(p) for p in pieces], np.int64)
    return _tokenizers[kind, path]


def frame(ids, sizes):
    """Tokens of a chunk of documents: doc, id, and their byte range in the chunk, in order."""
    flat = np.concatenate([np.asarray(x, np.int64) for x in ids]) if ids else np.zeros(0, np.int64)
    ends = np.cumsum(sizes[flat])
    doc = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    return pd.DataFrame({"doc": doc, "id": flat, "start": ends - sizes[flat], "end": ends})


def overlaps(a, b):
    """Every pair (row of a, row of b) whose byte ranges overlap, by two joins; both frames are sorted by start."""

    def covered(left, right):
        columns = right[["start", "doc"]].assign(other=np.arange(len(right)))
        found = pd.merge_asof(left[["start", "doc"]], columns, on="start", by="doc")["other"]
        return found.to_numpy(np.int64)

    first, second = np.arange(len(a)), covered(a, b)  # the token of b that covers the start of each of a
    third, fourth = covered(b, a), np.arange(len(b))
    later = b["start"].to_numpy() != a["start"].to_numpy()[third]  # pairs that start together came first
    return np.concatenate([first, third[later]]), np.concatenate([second, fourth[later]])


def group_text(a, b, end_a, end_b, tables):
    """`a1,a2|b1;...` of all tokens of a chunk, as a list of strings in order, and the number of tokens before each A token.

    `end_a` and `end_b` mark the last token of a group on each side; both have as many groups.
    """
    group_a = np.cumsum(end_a) - end_a
    group_b = np.cumsum(end_b) - end_b
    before = np.concatenate([[0], np.flatnonzero(end_b) + 1])[group_a]  # tokens of b in the groups before
    until = (np.flatnonzero(end_a) + 1)[group_b]  # tokens of a up to the end of the group
    out = np.empty(len(a) + len(b), object)
    for table, ids, last, place in ((tables[0], a, end_a, np.arange(len(a)) + before), (tables[1], b, end_b, np.arange(len(b)) + until)):
        out[place] = np.where(last, table[1][ids], table[0][ids])
    return out


def id_texts(n, close):
    """Decimal ids followed by a comma, and by what closes the side of a group."""
    return np.array([f"{i}," for i in range(n)], object), np.array([f"{i}{close}" for i in range(n)], object)


def aligned(ids_a, ids_b, sizes_a, sizes_b, tables):
    """For a chunk of documents: numbers of groups and links, digests, and (doc, pair, n) of the links."""
    a, b = frame(ids_a, sizes_a), frame(ids_b, sizes_b)
    row_a, row_b = overlaps(a, b)
    together = a["end"].to_numpy()[row_a] == b["end"].to_numpy()[row_b]
    row_a, row_b = row_a[together], row_b[together]
    order = np.argsort(row_a, kind="stable")
    row_a, row_b = row_a[order], row_b[order]
    end_a, end_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    end_a[row_a] = end_b[row_b] = True
    docs = len(ids_a)
    own = a["doc"].to_numpy()
    groups = np.bincount(own[end_a], minlength=docs)
    links = np.bincount(own[row_a], minlength=docs)
    strings = group_text(a["id"].to_numpy(), b["id"].to_numpy(), end_a, end_b, tables)
    ends = np.cumsum([len(x) + len(y) for x, y in zip(ids_a, ids_b)])
    digests, begin = [], 0
    for end in ends:
        digests.append(hashlib.sha256("".join(strings[begin:end])[:-1].encode()).hexdigest() if end > begin else "")
        begin = end
    pair = a["id"].to_numpy()[row_a] * SIDE + b["id"].to_numpy()[row_b]
    doc = own[row_a]
    order = np.lexsort((pair, doc))
    pair, doc = pair[order], doc[order]
    new = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])])) if len(pair) else np.zeros(0, np.int64)
    counts = np.diff(np.append(new, len(pair)))
    return groups, links, digests, doc[new], pair[new], counts


class Sums:
    """Counts of pairs, added up in a task."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, pair, n):
        self.parts.append((pair, n))
        self.size += len(pair)

    def taken(self):
        pair, n = (np.concatenate([p[k] for p in self.parts] or [np.zeros(0, np.int64)]) for k in (0, 1))
        self.parts, self.size = [], 0
        pair, at = np.unique(pair, return_inverse=True)
        return pair, np.bincount(at, n, len(pair)).astype(np.int64)

    def shrink(self):
        self.add(*self.taken())


FIELDS = ["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "counts", "pair", "n"]


def align(byte_path, piece_path):
    """Rows of documents, and rows (pair, n) of the links that were added up."""

    def sums_batch(sums, key_type):
        pair, n = sums.taken()
        columns = [pa.nulls(len(pair), t) for t in (key_type, *types[:-2])]
        return pa.RecordBatch.from_arrays([*columns, pa.array(pair), pa.array(n)], FIELDS)

    types = [pa.int64()] * 5 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.int64()]

    def run(batches):
        encode_a, bytes_a, sizes_a = tokenizer("byte", byte_path)
        encode_b, bytes_b, sizes_b = tokenizer("piece", piece_path)
        tables = id_texts(len(bytes_a), "|"), id_texts(len(bytes_b), ";")
        row = TaskContext.get().partitionId() << 40
        sums, key_type = Sums(), None
        for batch in batches:
            key_type = batch.schema.field(0).type
            for first, texts in chunked(batch.column(1)):
                ids_a, ids_b = encode_a([" " + t for t in texts]), encode_b(texts)
                for i, text in enumerate(texts):
                    want = b" " + text.encode()
                    if not text or b"".join([bytes_a[k] for k in ids_a[i]]) != want or b"".join([bytes_b[k] for k in ids_b[i]]) != want:
                        ids_a[i], ids_b[i] = [], []
                groups, links, digests, doc, pair, n = aligned(ids_a, ids_b, sizes_a, sizes_b, tables)
                ends = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
                sums.add(pair, n)
                if sums.size > PENDING:
                    sums.shrink()
                    if sums.size > PENDING // 2:
                        yield sums_batch(sums, key_type)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.array(np.arange(row, row + len(texts))),
                        pa.array([len(x) for x in ids_a], pa.int64()),
                        pa.array([len(x) for x in ids_b], pa.int64()),
                        pa.array(groups, pa.int64()),
                        pa.array(links, pa.int64()),
                        pa.array(digests, pa.string()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(pair)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(n.astype(np.int32))),
                        pa.nulls(len(texts), pa.int64()),
                        pa.nulls(len(texts), pa.int64()),
                    ],
                    FIELDS,
                )
                row += len(texts)
        if sums.size:
            yield sums_batch(sums, key_type)

    return run


def chunked(column, size=CHUNK_BYTES):
    """(first row, texts) of runs of whole texts of about `size` characters; a null text is empty."""
    first, held, total = 0, [], 0
    for i, value in enumerate(column):
        text = value.as_py() or ""
        if held and total + len(text) > size:
            yield first, held
            first, held, total = i, [], 0
        held.append(text)
        total += len(text)
    if held:
        yield first, held


def score(frequent, kept):
    """The first `kept` columns, then n_best and count_sum of the frequent pairs, and the pairs that are left with their counts."""

    def run(batches):
        known, total, best = frequent.value
        for batch in batches:
            lists, counts = batch.column(kept), batch.column(kept + 1)
            pair = lists.flatten().to_numpy()
            n = counts.flatten().to_numpy().astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy().astype(np.int64))])
            at = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
            found = known[at] == pair if len(known) else np.zeros(len(pair), bool)
            sums = np.zeros((2, len(pair) + 1), np.int64)
            if len(known):
                np.cumsum(np.where(found & best[at], n, 0), out=sums[0, 1:])
                np.cumsum(np.where(found, n * total[at], 0), out=sums[1, 1:])
            left = np.concatenate([[0], np.cumsum(~found)])[ends].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:kept],
                    pa.array(sums[0][ends[1:]] - sums[0][ends[:-1]]),
                    pa.array(sums[1][ends[1:]] - sums[1][ends[:-1]]),
                    pa.ListArray.from_arrays(pa.array(left), pa.array(pair[~found])),
                    pa.ListArray.from_arrays(pa.array(left), pa.array(n[~found])),
                ],
                [*batch.schema.names[:kept], "n_best", "count_sum", "pairs", "counts"],
            )

    return run


def pair_counts(scratch, rows):
    """(pair, n, best) of all linked pairs of ids: how often, and whether no other pair of its B id is as frequent or more."""
    counts = rows.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = scratch.save(counts.withColumn("b", F.pmod("pair", F.lit(SIDE))), "counts")
    top = counts.groupBy("b").agg(F.max("n").alias("top"))
    return scratch.save(counts.join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best")), "pairs")


def least_frequent(counts, most):
    """The smallest power of two so that at most `most` pairs are linked as often or more; 1: all pairs."""
    size = F.floor(F.log2("n")).cast("int")
    found = {r.size: r.n for r in counts.groupBy(size.alias("size")).agg(F.count("*").alias("n")).collect()}  # at most 63 rows
    least, held = 63, 0
    while least > 0 and held + found.get(least - 1, 0) <= most:
        least -= 1
        held += found.get(least, 0)
    return 1 << least


def align_tokens(docs, byte_path, piece_path, doc_id="doc_id", text="text", most=FREQUENT):
    """Align the tokens that two tokenizers cut each text into.

    One row per row of `docs`: doc_id, n_a, n_b (tokens), n_groups (parts between byte offsets
    where tokens of both sides end), n_links (pairs of tokens that end together), n_best (links
    whose pair of ids is the one most often linked, in the corpus, for its B id, ties
    included), count_sum (over links, how often their pair is linked in the corpus),
    groups_sha256 (of `a1,a2|b1;a3|b2`, ids in order). A is the byte-level file, given a space
    and the text; B the sentence piece model. Null and empty texts, and texts whose bytes are
    not those of both sides' tokens, have no tokens: zeros, and an empty digest. Repeated rows
    count each in the corpus; a null or repeated doc_id is carried as it is. A text of any
    length is aligned whole, by itself. Further columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "alignment")
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    schema += "pairs array<bigint>, counts array<int>, pair long, n long"
    rows = scratch.save(docs.mapInArrow(align(byte_path, piece_path), schema), "rows")
    counts = pair_counts(scratch, rows)
    least = least_frequent(counts, most)
    table = counts.where(F.col("n") >= least).orderBy("pair").toArrow()  # at most `most` rows
    frequent = spark.sparkContext.broadcast(tuple(table.column(k).to_numpy() for k in ("pair", "n", "best")))
    names = ["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = f"doc_id {key}, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    schema += "n_best long, count_sum long, pairs array<bigint>, counts array<bigint>"
    scored = rows.where("row IS NOT NULL").select(*names, "pairs", "counts").mapInArrow(score(frequent, len(names)), schema)
    if least > 1 and not is_empty(counts.where(F.col("n") < least)):
        scored = scratch.save(scored, "scored")
        rare = scored.select("row", F.explode(F.arrays_zip("pairs", "counts")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("k"))
        rare = rare.join(counts.where(F.col("n") < least), "pair").groupBy("row")
        rare = rare.agg(F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("more_best"), F.sum(F.col("k") * F.col("n")).alias("more_sum"))
        scored = scored.join(rare, "row", "left")
        scored = scored.withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
        scored = scored.withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0)))
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
