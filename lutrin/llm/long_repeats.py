"""Removal of long repeated byte strings by sorting sampled suffixes.

A byte goes if it lies in a string of LENGTH bytes that also starts anywhere else. Sorting
every suffix of the corpus would move many times its size, so only a sample of the suffixes
is sorted: of every window of LENGTH bytes the one at its anchor, the place in the window
whose gram of GRAM bytes has the least hash. Equal windows have equal anchors, so nothing
is lost. Consecutive windows with one anchor form a block, and

1. blocks are sorted by gram and content, by Spark's external sort; equal neighbours are
   repeats, all their windows at once;
2. what is decided for the sampled suffixes is carried over to the suffixes next to them:
   blocks of the same gram but other content, such as those at the ends of a repeat, are
   compared window by window, by the hash of each window.

Texts are told by their hash, so equal texts are described, fetched and cut once.
"""

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import functions as F

from lutrin.llm import byte_words as bw
from lutrin.llm.common import Scratch, is_empty
from lutrin.llm.runs import changes, whole_runs

LENGTH, GRAM = 400, 96
#: Windows that are described at a time; a longer text is taken in slices.
SLICE = 1 << 21
#: Blocks of one gram that are compared in one task, and windows that are sorted at a time.
BLOCKS, WINDOWS = 1 << 14, 1 << 21
_LOW = np.uint64((1 << 22) - 1)


def prefix_sums(data):
    powers, inverse = bw._powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[1:], out=sums[1:])
    return sums, inverse


def blocks_of(data, length, gram):
    """Blocks of one text: gram hash, content hash, anchor, first and last window."""
    found = []
    for begin in range(0, max(0, len(data) - length + 1), SLICE):
        part = data[begin : begin + SLICE + length - 1]
        sums, inverse = prefix_sums(part)
        grams = bw.mix((sums[gram:] - sums[:-gram]) * inverse[: len(part) - gram + 1])
        key = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
        width = length - gram + 1
        windows = len(part) - length + 1
        # least key of each window, from prefix and suffix minima of stretches of one width
        padded = np.full(-(-len(key) // width) * width, ~np.uint64(0))
        padded[: len(key)] = key
        padded = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(padded, 1).ravel()
        behind = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
        anchor = (np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows]) & _LOW).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1])
        last = np.append(first[1:], windows) - 1
        anchor = anchor[first]
        content = bw.mix((sums[last + length] - sums[first]) * inverse[first])
        content = bw.mix(content ^ ((anchor - first).astype(np.uint64) << np.uint64(32)) ^ (last - first).astype(np.uint64))
        found.append((grams[anchor], content, anchor + begin, first + begin, last + begin))
    return [np.concatenate(x) for x in zip(*found)] if found else None


def texts_of(column):
    """Bytes of every text of an Arrow column, null as empty, without copies."""
    for _, data, offsets in bw.chunks(column):
        for a, b in zip(offsets[:-1], offsets[1:]):
            yield data[a:b]


def key_of(data):
    return hashlib.md5(data).digest()


BLOCK_ROWS = "gram long, content long, row long, text binary, first long, before int, windows int"


def describe(length, gram):
    """Rows of blocks: `before` bytes from the first window to the anchor, number of windows."""

    def run(batches):
        with np.errstate(over="ignore"):
            for batch in batches:
                held, n = [], 0
                for row, data in zip(batch.column(0).to_numpy(), texts_of(batch.column(1))):
                    found = blocks_of(data, length, gram)
                    if found:
                        held.append((row, key_of(data.tobytes()), found))
                        n += len(found[0])
                    if n > 65536:
                        yield block_rows(held)
                        held, n = [], 0
                if held:
                    yield block_rows(held)

    return run


def block_rows(held):
    grams, content, anchor, first, last = (np.concatenate(x) for x in zip(*(f for _, _, f in held)))
    sizes = [len(f[0]) for _, _, f in held]
    texts = pa.array([k for _, k, _ in held], pa.binary())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(grams.view(np.int64)),
            pa.array(content.view(np.int64)),
            pa.array(np.repeat([r for r, _, _ in held], sizes)),
            texts.take(pa.array(np.repeat(np.arange(len(held)), sizes))),
            pa.array(first),
            pa.array((anchor - first).astype(np.int32)),
            pa.array((last - first + 1).astype(np.int32)),
        ],
        ["gram", "content", "row", "text", "first", "before", "windows"],
    )


DECIDED_ROWS = "gram long, text binary, first long, before int, windows int, repeated boolean"


def decide(batches):
    """Repeated blocks, and one of each content that shares its gram with others; input sorted.

    A content of which this partition holds a single row at one of its ends may go on in
    the next partition. It is not called repeated but left to the comparison of windows, as
    are all contents of a gram at the ends.
    """

    def ends(batches):
        held = None
        for batch in whole_runs(batches, ["gram"]):
            if held is not None:
                yield held, False
            held = batch
        if held is not None:
            yield held, True

    opening = True
    for batch, closing in ends(batches):
        n = batch.num_rows
        gram_first = changes(batch, ["gram"])
        gram_of = np.repeat(np.arange(len(gram_first)), np.diff(np.append(gram_first, n)))
        first = changes(batch, ["gram", "content"])
        size = np.diff(np.append(first, n))
        contents = np.bincount(gram_of[first], minlength=len(gram_first))
        shared = contents > 1
        if opening:
            shared[0] = True
        if closing:
            shared[-1] = True
        opening = False
        names = ["gram", "text", "first", "before", "windows"]
        repeated = np.flatnonzero(np.repeat(size > 1, size))
        yield rows_of(batch, repeated, names, True)
        yield rows_of(batch, first[shared[gram_of[first]]], names, False)


def rows_of(batch, at, names, repeated):
    taken = batch.select(names).take(pa.array(at))
    return pa.RecordBatch.from_arrays([*taken.columns, pa.array(np.full(len(at), repeated))], [*names, "repeated"])


def packed_texts(docs):
    """Distinct texts (text: hash, packed: compressed bytes)."""

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            held, size = [], 0
            for data in texts_of(batch.column(0)):
                data = data.tobytes()
                held.append((key_of(data), squeeze.compress(data)))
                size += len(data)
                if size > 1 << 22:
                    yield pair_rows(held)
                    held, size = [], 0
            if held:
                yield pair_rows(held)

    def pair_rows(held):
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in held], pa.binary()), pa.array([v for _, v in held], pa.binary())], ["text", "packed"]
        )

    packed = docs.select("value").mapInArrow(run, "text binary, packed binary")
    return packed.groupBy("text").agg(F.first("packed").alias("packed"))


def unpack(value):
    return zstandard.ZstdDecompressor().decompress(value)


def fetch(length):
    """Bytes of the blocks that are to be compared."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                data = unpack(batch.column(1)[i].as_py())
                places = batch.column(2)[i].values
                gram, first, before, windows = (places.field(k) for k in range(4))
                begin, count = first.to_numpy(), windows.to_numpy()
                content = [data[a : a + n + length - 1] for a, n in zip(begin, count)]
                yield pa.RecordBatch.from_arrays(
                    [gram, pa.array([batch.column(0)[i].as_py()] * len(gram), pa.binary()), first, before, windows, pa.array(content, pa.binary())],
                    ["gram", "text", "first", "before", "windows", "content"],
                )

    return run


def compare(length):
    """(text, first, last): stretches of repeated windows among the blocks of one gram; input sorted by gram."""

    def run(batches):
        with np.errstate(over="ignore"):
            for batch in whole_runs(batches, ["gram"]):
                windows = batch.column("windows").to_numpy()
                last = np.append(changes(batch, ["gram"])[1:], batch.num_rows)
                total = np.cumsum(windows)[last - 1]
                begin = 0
                while begin < batch.num_rows:  # some million windows at a time, whole grams
                    i = int(np.searchsorted(last, begin, side="right"))
                    done = total[i - 1] if i else 0
                    j = max(i, int(np.searchsorted(total, done + WINDOWS, side="right")) - 1)
                    end = int(last[j])
                    yield compared(batch.slice(begin, end - begin))
                    begin = end

    def compared(batch):
        owner, place, high, low = windows_of(batch, length)
        gram = batch.column("gram").to_numpy()[owner]
        order = np.lexsort((low, high, gram))
        one, two = order[1:], order[:-1]
        same = (high[one] == high[two]) & (low[one] == low[two]) & (gram[one] == gram[two])
        repeated = np.zeros(len(owner), bool)
        repeated[one[same]] = True
        repeated[two[same]] = True
        hit = np.flatnonzero(repeated)
        new = np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (owner[hit][1:] != owner[hit][:-1])]) if len(hit) else np.zeros(0, bool)
        a = hit[new]
        b = hit[np.append(np.flatnonzero(new)[1:], len(hit)) - 1] if len(hit) else hit
        first = batch.column("first").to_numpy()
        return pa.RecordBatch.from_arrays(
            [batch.column("text").take(pa.array(owner[a])), pa.array(first[owner[a]] + place[a]), pa.array(first[owner[b]] + place[b])],
            ["text", "first", "last"],
        )

    return run


def windows_of(batch, length):
    """Block, place in the block and two hashes of every window; the second knows the place of the anchor."""
    windows, before = (batch.column(k).to_numpy() for k in ("windows", "before"))
    content = batch.column("content")
    halves = [hashes(content[i].as_buffer(), length, int(n)) for i, n in enumerate(windows)]
    owner = np.repeat(np.arange(len(windows)), windows)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    high, low = (np.concatenate([h[k] for h in halves]) for k in (0, 1))
    return owner, place, high, bw.mix(low ^ (before[owner] - place).astype(np.uint64))


def list_windows(length):
    """(text, first, high, low) of every window, for grams with too many blocks to meet in one task."""

    def run(batches):
        with np.errstate(over="ignore"):
            for whole in batches:
                for begin in range(0, whole.num_rows, 512):
                    batch = whole.slice(begin, 512)
                    owner, place, high, low = windows_of(batch, length)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("text").take(pa.array(owner)),
                            pa.array(batch.column("first").to_numpy()[owner] + place),
                            pa.array(high.view(np.int64)),
                            pa.array(low.view(np.int64)),
                        ],
                        ["text", "first", "high", "low"],
                    )

    return run


def hashes(content, length, windows):
    """Two hashes of every window of a block."""
    data = np.frombuffer(content, np.uint8)
    out = []
    for salted in (data, data ^ np.uint8(0xA5)):
        sums, inverse = prefix_sums(salted)
        out.append(bw.mix((sums[length : length + windows] - sums[:windows]) * inverse[:windows]))
    return out[0], bw.mix(out[1] ^ np.uint64(0x5851F42D4C957F2D))


#: Bytes of texts that a batch of results holds, about.
RESULT_BYTES = 4 << 20


def cut(length):
    """What is left of each text: (text, n_bytes, removed spans, kept bytes)."""

    def result(keys, sizes, spans, kept):
        spans = pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), spans, pa.array(kept, pa.binary())], ["text", "n_bytes", "spans", "kept"]
        )

    def run(batches):
        for batch in batches:
            out, held = ([], [], [], []), 0
            for i in range(batch.num_rows):
                data = unpack(batch.column(1)[i].as_py())
                found = batch.column(2)[i]
                spans = []
                if found.is_valid and len(found.values):
                    a, b = (found.values.field(k).to_numpy() for k in (0, 1))
                    order = np.argsort(a, kind="stable")
                    a, b = a[order], np.maximum.accumulate(b[order]) + length
                    new = np.concatenate([[True], a[1:] > b[:-1]])
                    last = np.append(np.flatnonzero(new)[1:], len(a)) - 1
                    spans = [(int(x), int(y)) for x, y in zip(a[new], b[last])]
                kept, at = [], 0
                for x, y in spans:
                    kept.append(data[at:x])
                    at = y
                kept.append(data[at:])
                row = batch.column(0)[i].as_py(), len(data), [{"start": x, "end": y} for x, y in spans], b"".join(kept)
                for column, value in zip(out, row):
                    column.append(value)
                held += len(data)
                if held > RESULT_BYTES:
                    yield result(*out)
                    out, held = ([], [], [], []), 0
            yield result(*out)

    return run


def remove_repeats(docs, doc_id="doc_id", text="text", length=LENGTH, gram=GRAM, columns=None):
    """Cut every byte that a repeated string of `length` bytes covers.

    One row per row of `docs`: doc_id, n_bytes, spans (maximal removed runs, start and end in
    bytes) and kept (the remaining bytes), or what `columns` makes of n_bytes, spans and kept.
    Repeats are judged on the input, across all texts and within one, and may overlap;
    strings never cross texts. Null and empty texts have no bytes; texts shorter than
    `length` stay; rows that repeat a text are repeats of each other; null and repeated
    doc_ids are carried as they are; further columns are ignored; an empty table gives no
    rows. A text of any length is taken whole, in slices.
    """
    if not 0 < gram < length:
        raise ValueError("the gram must be shorter than the strings")
    spark = docs.sparkSession
    scratch = Scratch(spark, "long-repeats")
    value = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), value.alias("value"))
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "value")
    blocks = numbered.mapInArrow(describe(length, gram), BLOCK_ROWS)
    # the row number spreads a content with many rows; it is no part of any result
    order = ["gram", "content", "row", "first"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    decided = blocks.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(decide, DECIDED_ROWS)
    decided = scratch.save(decided, "decided")
    places = decided.where("NOT repeated").groupBy("text").agg(F.collect_list(F.struct("gram", "first", "before", "windows")).alias("places"))
    fetched = packed_texts(rows).join(places, "text").select("text", "packed", "places")
    fetched = fetched.mapInArrow(fetch(length), "gram long, text binary, first long, before int, windows int, content binary")
    fetched = scratch.save(fetched, "compared", compression="zstd")
    large = scratch.save(decided.where("NOT repeated").groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > BLOCKS).select("gram"), "large")
    covered = decided.where("repeated").select("text", "first", (F.col("first") + F.col("windows") - 1).alias("last"))
    usual = fetched
    if not is_empty(large):  # a gram in very many contents: its windows are dealt out one by one
        usual = fetched.join(large, "gram", "left_anti")
        each = fetched.join(large, "gram", "left_semi").select("text", "first", "before", "windows", "content")
        each = scratch.save(each.mapInArrow(list_windows(length), "text binary, first long, high long, low long"), "windows")
        twice = each.groupBy("high", "low").agg(F.count("*").alias("n")).where("n > 1").select("high", "low")
        covered = covered.union(each.join(twice, ["high", "low"]).select("text", "first", F.col("first").alias("last")))
    usual = usual.select("gram", "text", "first", "before", "windows", "content")
    usual = usual.repartition("gram").sortWithinPartitions("gram", "text", "first")
    covered = covered.union(usual.mapInArrow(compare(length), "text binary, first long, last long"))
    covered = covered.distinct().groupBy("text").agg(F.collect_list(F.struct("first", "last")).alias("covered"))
    cleaned = packed_texts(rows).join(covered, "text", "left").select("text", "packed", "covered")
    cleaned = cleaned.mapInArrow(cut(length), "text binary, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    cleaned = cleaned.select("text", *(columns or ["n_bytes", "spans", "kept"]))
    named = rows.select("doc_id", F.unhex(F.md5(F.encode("value", "UTF-8"))).alias("text"))
    return named.join(cleaned, "text").drop("text")
