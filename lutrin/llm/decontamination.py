"""Benchmark decontamination with a distributed positional inverted index.

The index is cut by documents: a segment holds some MB of text, and for each of its words
the sorted positions. A search takes the test items in blocks of bounded size and runs each
block against all segments; a segment starts from its own rarest term of every window,
intersects the lists of the other terms, shifted by their place in the window, in order of
rarity, and so finds exact phrases (slop 0) or terms near their places (slop above 0).
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from lutrin.llm import byte_words as bw
from lutrin.llm.common import Scratch

SEGMENT_BYTES = 1 << 23
#: Bytes of test items that are searched at a time.
BLOCK_BYTES = 1 << 23
#: Candidates of one step of an intersection.
STEP = 1 << 21


def segments(batches):
    """Rows (segment, doc_ids, n_words, terms, term_first, positions) from batches of (doc_id, text)."""
    task = TaskContext.get().partitionId()
    number = 0
    held, keys, size = [], [], 0
    for batch in batches:
        ids = batch.column(0)
        for row, data, offsets in bw.chunks(batch.column(1)):
            words, first = bw.word_hashes(data, offsets, bw.ALPHANUMERIC)
            held.append((words, np.diff(first)))
            keys.append(ids.slice(row, len(offsets) - 1))
            size += len(data) + 64 * len(offsets)
            if size >= SEGMENT_BYTES:
                yield segment((task << 32) + number, held, keys)
                number, held, keys, size = number + 1, [], [], 0
    if keys:
        yield segment((task << 32) + number, held, keys)


def segment(number, held, keys):
    words = np.concatenate([w for w, _ in held])
    order = np.argsort(words, kind="stable")
    words = words[order]
    first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])) if len(words) else np.zeros(0, int)
    ids = pa.concat_arrays(keys)
    n_words = pa.array(np.concatenate([n for _, n in held]), pa.int64())
    rows = pa.array([0, len(ids)], pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()),
            pa.ListArray.from_arrays(rows, ids),
            pa.ListArray.from_arrays(rows, n_words),
            pa.array([words[first].tobytes()], pa.binary()),
            pa.array([first.astype("<u4").tobytes()], pa.binary()),
            pa.array([order.astype("<u4").tobytes()], pa.binary()),
        ],
        ["segment", "doc_ids", "n_words", "terms", "term_first", "positions"],
    )


def build_index(scratch, docs, doc_id="doc_id", text="text"):
    """The index of all documents as a written table of segments."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"segment long, doc_ids array<{key}>, n_words array<bigint>, terms binary, term_first binary, positions binary"
    return scratch.save(docs.mapInArrow(segments, schema), "index", compression="zstd")


def indexed_documents(index):
    """(segment, place, doc_id, n_words) of every indexed row."""
    both = F.arrays_zip(F.col("doc_ids").alias("doc_id"), F.col("n_words").alias("n_words"))
    return index.select("segment", F.posexplode(both).alias("place", "doc")).select(
        "segment", "place", F.col("doc.doc_id").alias("doc_id"), F.col("doc.n_words").alias("n_words")
    )


def windows(items, size):
    """The windows of (item_id, text) rows: term numbers (-1 beyond a short item), terms, names."""
    names = [str(k) if k is not None else "null" for k, _ in items]
    rows, owner, terms = [], [], []
    texts = pa.array([t or "" for _, t in items], pa.large_string())
    for row, data, offsets in bw.chunks(texts):
        words, first = bw.word_hashes(data, offsets, bw.ALPHANUMERIC)
        for i in range(len(offsets) - 1):
            own = words[first[i] : first[i + 1]]
            if len(own):
                n = min(size, len(own))
                view = np.lib.stride_tricks.sliding_window_view(own, n)
                block = np.zeros((len(view), size), np.uint64)
                block[:, :n] = view
                rows.append(block)
                terms.append(np.full(len(view), n))
                owner.append(np.full(len(view), row + i))
    if not rows:
        return None
    rows, n, owner = np.concatenate(rows), np.concatenate(terms), np.concatenate(owner)
    vocabulary, number = np.unique(rows, return_inverse=True)
    number = number.reshape(rows.shape).astype(np.int32)
    number[np.arange(size)[None, :] >= n[:, None]] = -1
    return {"words": number, "n": n, "item": owner, "vocabulary": vocabulary, "names": names}


def find(block, slop, terms, term_first, positions, n_words):
    """Occurrences in one segment: (first word, window), the first word counted over the segment."""
    total = len(positions)
    vocabulary = block["vocabulary"]
    at = np.minimum(np.searchsorted(terms, vocabulary), max(len(terms) - 1, 0))
    known = terms[at] == vocabulary if len(terms) else np.zeros(len(vocabulary), bool)
    ends = np.append(term_first[1:], total)
    begin = np.where(known, term_first[at], 0) if len(terms) else np.zeros(len(vocabulary), np.int64)
    df = np.where(known, ends[at] - begin, 0) if len(terms) else begin
    df_of = np.append(df, np.int64(1) << 40)  # -1: beyond a short item
    each = df_of[block["words"]]
    live = np.flatnonzero(each.min(1) > 0)
    if not len(live) or not total:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(each[live], 1, kind="stable")  # places in the window, rarest term first
    words = block["words"][live]
    # one sorted list of (term, position) for all terms of the block
    lists = [positions[b : b + n] for b, n in zip(begin[known], df[known])]
    spot = np.repeat(np.flatnonzero(known).astype(np.int64), df[known]) * total + np.concatenate(lists)
    base = np.concatenate([[0], np.cumsum(df * known)])
    doc_end = np.cumsum(n_words)
    anchor = order[:, 0]
    term = words[np.arange(len(live)), anchor]
    n = df[term]
    found = []
    cuts = np.searchsorted(np.cumsum(n), np.arange(STEP, n.sum() + STEP, STEP), side="left") + 1
    low = 0
    for high in np.unique(np.minimum(cuts, len(live))):
        w = np.repeat(np.arange(low, high), n[low:high])
        shift = np.arange(len(w)) - np.repeat(np.cumsum(n[low:high]) - n[low:high], n[low:high])
        place = spot[base[term[w]] + shift] - term[w] * np.int64(total)
        low = high
        doc = np.searchsorted(doc_end, place, side="right")
        first, last = doc_end[doc] - n_words[doc], doc_end[doc] - 1
        start = place - anchor[w]
        for k in range(1, order.shape[1]):
            if not len(w):
                break
            offset = order[w, k]
            own = words[w, offset].astype(np.int64)
            need = np.flatnonzero(own >= 0)
            expected = start[need] + offset[need]
            lo, hi = np.maximum(expected - slop, first[need]), np.minimum(expected + slop, last[need])
            j = np.minimum(np.searchsorted(spot, own[need] * total + lo), len(spot) - 1)
            hit = (spot[j] >= own[need] * total + lo) & (spot[j] <= own[need] * total + hi)
            keep = np.ones(len(w), bool)
            keep[need] = hit & (lo <= hi)
            w, start, first, last = w[keep], start[keep], first[keep], last[keep]
        found.append((start, live[w]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def search_segments(block, slop):
    def run(batches):
        own = block.value
        names = np.array(own["names"], object)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                n_words = np.array(row["n_words"].values.to_numpy(zero_copy_only=False), np.int64)
                read = lambda name, kind: np.frombuffer(row[name].as_buffer(), kind)
                start, window = find(
                    own, slop, read("terms", "<u8"), read("term_first", "<u4").astype(np.int64),
                    read("positions", "<u4").astype(np.int64), n_words,
                )
                if not len(start):
                    continue
                end = np.cumsum(n_words)
                doc = np.searchsorted(end, np.clip(start + own["n"][window] // 2, 0, end[-1] - 1), side="right")
                low = np.maximum(start, end[doc] - n_words[doc])
                high = np.minimum(start + own["n"][window], end[doc])
                edges = np.zeros(end[-1] + 1, np.int32)
                np.add.at(edges, low, 1)
                np.add.at(edges, high, -1)
                hit = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
                of = np.searchsorted(end, hit, side="right")
                pair = np.unique(np.stack([doc, own["item"][window]], 1), axis=0)
                docs = np.unique(of)
                words = np.split(hit - (end - n_words)[of], np.searchsorted(of, docs)[1:])
                items = np.split(names[pair[:, 1]], np.searchsorted(pair[:, 0], docs)[1:])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["segment"].as_py()] * len(docs), pa.int64()),
                        pa.array(docs, pa.int32()),
                        pa.array(words, pa.list_(pa.int32())),
                        pa.array([list(x) for x in items], pa.list_(pa.string())),
                    ],
                    ["segment", "place", "words", "items"],
                )

    return run


def blocks(items, size, bytes_at_a_time):
    """Windows of the test items, in blocks of bounded size."""
    held, n = [], 0
    for row in items.toLocalIterator():
        held.append(tuple(row))
        n += len(row[1] or "") + 64
        if n >= bytes_at_a_time:
            yield windows(held, size)
            held, n = [], 0
    if held:
        yield windows(held, size)


def search(scratch, index, items, item_id="item_id", text="text", window=10, slop=0):
    """Hits of the test items in the index: (segment, place, words, items) for rows with any."""
    spark = index.sparkSession
    schema = "segment long, place int, words array<int>, items array<string>"
    found = []
    items = items.select(F.col(item_id), F.col(text))
    for block in blocks(items, window, BLOCK_BYTES):
        if block:
            sent = spark.sparkContext.broadcast(block)  # one block, bounded by BLOCK_BYTES
            rows = index.select("segment", "n_words", "terms", "term_first", "positions").mapInArrow(search_segments(sent, slop), schema)
            found.append(scratch.save(rows, "hits"))
            sent.destroy()
    if not found:
        return spark.createDataFrame([], schema)
    if len(found) == 1:
        return found[0]
    rows = found[0]
    for more in found[1:]:
        rows = rows.union(more)
    merged = (F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("words", "items"))
    return rows.groupBy("segment", "place").agg(*merged)


def decontaminate(docs, items, doc_id="doc_id", text="text", item_id="item_id", item_text="text", window=10, slop=0):
    """Which words of which documents occur in test items.

    A window is `window` consecutive words of an item, or all words of a shorter one; with
    `slop` each further term may lie that many words from its place. One row per row of
    `docs`: doc_id, n_words, hit_words (places of words inside an occurrence, ascending),
    item_ids (distinct, sorted as strings). Null and empty texts have no words and no hits,
    items without words have no windows; an item without an id counts as "null", rows that
    repeat an item_id count as one item, rows that repeat a doc_id are judged each on their
    own; further columns are ignored; an empty table of documents gives no rows, one of
    items no hits. A text longer than a segment is a segment of its own.
    """
    scratch = Scratch(docs.sparkSession, "decontamination")
    index = build_index(scratch, docs, doc_id, text)
    hits = search(scratch, index, items, item_id, item_text, window, slop)
    empty = F.array().cast("array<int>"), F.array().cast("array<string>")
    return (
        indexed_documents(index)
        .join(hits, ["segment", "place"], "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("words", empty[0]).alias("hit_words"),
            F.coalesce(F.array_sort(F.array_distinct("items")), empty[1]).alias("item_ids"),
        )
    )
