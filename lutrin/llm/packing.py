"""Best-fit packing of documents into sequences, planned on the histogram of lengths.

The plan works on counts per length, of which there are at most `capacity`, so it does not
grow with the data: patterns of two or three lengths that fill a sequence are enumerated,
non-negative least squares fit how often each is used, the counts are rounded down, and
what is left is packed best-fit decreasing. Spark turns the plan into places: pieces are
numbered within their length from counts per task, without gathering a length in one task.
"""

import bisect
import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from lutrin.llm.common import Scratch

#: Pretokenisation of the byte-level vocabulary. Fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Bound on the patterns that are fitted; a parameter of the plan, not of the data.
MAX_PATTERNS = 60_000
FIT_STEPS = 300


def byte_of_symbol():
    """The byte that each symbol of a byte-level vocabulary stands for."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def rank_encoder(path):
    """A function from text to ids by the rank encoder, or None where the file is not of its kind.

    A byte-level BPE file whose ids are its merge ranks is run by the rank encoder, which is
    several times faster than the tokenizer and gives the same ids. Added tokens are plain text.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    added = [token["content"] for token in spec.get("added_tokens", [])]
    vocab = {token: i for token, i in model.get("vocab", {}).items() if token not in added}
    merges = [m if isinstance(m, str) else " ".join(m) for m in model.get("merges", [])]
    by_rank = (
        model.get("type") == "BPE"
        and pre == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": pre.get("trim_offsets"), "use_regex": True}
        and not any(spec.get(x) for x in ("normalizer", "truncation", "padding"))
        and not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback"))
        and len(vocab) == len(merges) + 256
        and all(vocab.get(m.replace(" ", "", 1)) == 256 + i for i, m in enumerate(merges))
    )
    if not by_rank:
        return None
    import tiktoken

    symbols = byte_of_symbol()
    ranks = {bytes(symbols[c] for c in token): i for token, i in vocab.items()}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def added_tokens(path):
    with open(path, encoding="utf-8") as file:
        return [token["content"] for token in json.load(file).get("added_tokens", [])]


_encoders = {}


def encoder(path):
    """A function from text to ids, equal to the tokenizer file's own ids without special tokens.

    It is made once in a worker process, which serves many tasks. The tokenizer itself, which
    takes another 30 MB, is only read for texts that contain the spelling of an added token, and
    for files that the rank encoder can't run.
    """
    if path in _encoders:
        return _encoders[path]
    fast, added, own = rank_encoder(path), added_tokens(path), []

    def plain(text):
        if not own:
            from tokenizers import Tokenizer

            own.append(Tokenizer.from_file(path))
        return own[0].encode(text, add_special_tokens=False).ids

    def encode(text):
        if not fast or any(token in text for token in added):
            return plain(text)
        return fast(text)

    _encoders[path] = encode
    return encode


def cut(n, capacity):
    """Bounds of the pieces of n tokens: full ones, but for a first that takes the remainder."""
    head = n % capacity
    bounds = [*range(head, n + 1, capacity)]
    return bounds if head == 0 else [0, *bounds]


def tokenise(tokenizer_path, capacity, end_id, with_ids):
    def run(batches):
        encode = encoder(tokenizer_path)
        task = TaskContext.get().partitionId()
        seen = {}
        for batch in batches:
            out = {name: [] for name in ("doc_id", "piece", "start", "length", "crc", "rank", "ids")}
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encode(text.as_py() or ""), end_id], "<u4")
                bounds = cut(len(ids), capacity)
                for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    rank = seen[b - a] = seen.get(b - a, -1) + 1
                    out["doc_id"].append(key)
                    out["piece"].append(piece)
                    out["start"].append(a)
                    out["length"].append(b - a)
                    out["crc"].append(zlib.crc32(ids[a:b].tobytes()))
                    out["rank"].append(rank)
                    if with_ids:
                        out["ids"].append(ids[a:b])
            n = len(out["piece"])
            columns = [
                pa.array(out["doc_id"], batch.schema.field(0).type),
                pa.array(out["piece"], pa.int32()),
                pa.array(out["start"], pa.int64()),
                pa.array(out["length"], pa.int64()),
                pa.array(out["crc"], pa.int64()),
                pa.array([task] * n, pa.int32()),
                pa.array(out["rank"], pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"]
            if with_ids:
                columns.append(pa.array(out["ids"], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def patterns(lengths, capacity, most=MAX_PATTERNS):
    """Rows of up to three lengths (0: none) that fill a sequence, the fullest first.

    The waste that is allowed grows until there are enough patterns; triples are thinned
    evenly where there would be too many.
    """
    present = np.zeros(capacity + 1, bool)
    present[lengths] = True
    lengths = np.sort(np.asarray(lengths))
    found, total = [np.array([[capacity, 0, 0]])] if present[capacity] else [], 0
    short = lengths[lengths < capacity]
    for waste in range(0, max(1, capacity // 64)):
        goal = capacity - waste
        a = short[short <= goal // 2]
        pairs = a[present[goal - a]] if len(a) else a
        if len(pairs):
            found.append(np.stack([goal - pairs, pairs, np.zeros_like(pairs)], 1))
        a, b = np.meshgrid(short[short <= goal // 3], short, indexing="ij")
        c = goal - a - b
        ok = (b >= a) & (c >= b)
        ok[ok] = present[c[ok]]
        triples = np.stack([c[ok], b[ok], a[ok]], 1)
        if len(triples) > most // 2:
            triples = triples[np.linspace(0, len(triples) - 1, most // 2).astype(int)]
        found.append(triples.reshape(-1, 3))
        total = sum(map(len, found))
        if total >= 4 * len(lengths) or total >= most:
            break
    return np.concatenate(found)[:most].astype(np.int64) if found else np.zeros((0, 3), np.int64)


def fit(rows, counts, steps=FIT_STEPS):
    """Non-negative least squares by multiplicative updates: repeats of `rows` whose lengths add up to `counts`."""
    size = len(counts)

    def lengths_of(x):
        return np.bincount(rows.ravel(), np.repeat(x, 3), size) * (np.arange(size) > 0)

    def patterns_of(y):
        y = y.copy()
        y[0] = 0
        return y[rows].sum(1)

    goal = patterns_of(counts)
    x = np.full(len(rows), counts.sum() / max(1, 3 * len(rows)))
    for _ in range(steps):
        x *= goal / np.maximum(patterns_of(lengths_of(x)), 1e-12)
    return x


def plan(histogram, capacity):
    """Groups (number of sequences, ((length, documents), ...)) that hold all of `histogram`."""
    counts = np.zeros(capacity + 1)
    for length, n in histogram.items():
        counts[length] = n
    left = counts.astype(np.int64)
    open_groups = {}  # free space -> [(sequences, content)]
    closed = []

    def put(n, content, free):
        if free:
            open_groups.setdefault(free, []).append((n, content))
        else:
            closed.append((n, content))

    rows = patterns(np.flatnonzero(left), capacity)
    if len(rows):
        x = fit(rows, counts)
        keep = np.argsort(-x, kind="stable")[: 2 * len(histogram)]  # a basic solution needs no more
        rows = rows[keep]
        x = fit(rows, counts)
        for i in np.argsort(-x, kind="stable"):
            row = [int(v) for v in rows[i] if v]
            need = {v: row.count(v) for v in row}
            n = min([int(x[i] + 1e-9), *(int(left[v]) // k for v, k in need.items())])
            if n > 0:
                for v, k in need.items():
                    left[v] -= n * k
                put(n, tuple(need.items()), capacity - sum(row))
    spaces = sorted(open_groups)
    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            at = bisect.bisect_left(spaces, length)
            if at == len(spaces):
                have, content, free = 1 << 62, (), capacity
            else:
                free = spaces[at]
                have, content = open_groups[free].pop()
                if not open_groups[free]:
                    del open_groups[free]
                    spaces.pop(at)
            each = free // length
            full = min(have, n // each)
            parts = [(full, each)]
            if full < have and full * each < n:
                parts.append((1, n - full * each))  # the last sequence takes what is left
            used = 0
            for m, k in parts:
                if m:
                    used += m
                    n -= m * k
                    rest = free - k * length
                    if rest and rest not in open_groups:
                        bisect.insort(spaces, rest)
                    put(m, (*content, (length, k)), rest)
            if content and used < have:
                if free not in open_groups:
                    bisect.insort(spaces, free)
                put(have - used, content, free)
    return closed + [g for groups in open_groups.values() for g in groups]


def places(groups, capacity):
    """For each length the arrays (first rank, first sequence, offset, documents in a sequence)."""
    slots = [[] for _ in range(capacity + 1)]
    taken = [0] * (capacity + 1)
    base = 0
    for n, content in groups:
        offset = 0
        for length, k in content:
            slots[length].append((taken[length], base, offset, k))
            taken[length] += n * k
            offset += length * k
        base += n
    return {length: np.array(rows, np.int64).T for length, rows in enumerate(slots) if rows}


def place(slots):
    def run(batches):
        by_length = slots.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for value in np.unique(length):
                at = np.flatnonzero(length == value)
                first, base, start, k = by_length[int(value)]
                slot = np.searchsorted(first, rank[at], side="right") - 1
                within = rank[at] - first[slot]
                sequence[at] = base[slot] + within // k[slot]
                offset[at] = start[slot] + within % k[slot] * value
            kept = [i for i, name in enumerate(batch.schema.names) if name != "rank"]
            columns = [batch.column(i) for i in kept] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [batch.schema.names[i] for i in kept] + ["sequence_id", "offset"])

    return run


def pack(docs, tokenizer_path, capacity=2048, end_id=0, doc_id="doc_id", text="text", with_ids=False):
    """Pack all documents into sequences of at most `capacity` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and the
    ids if `with_ids`. Only documents longer than a sequence are cut; all their pieces are
    full but the first. Every row of `docs` is packed: a null or empty text is the end token
    alone, a null or repeated doc_id is carried as it is, equal lengths are taken in the
    order of tasks and rows, further columns are ignored, an empty table gives no rows. A
    text of any length is encoded whole, by itself.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, piece int, start long, length long, ids_crc32 long, task int, rank long"
    schema += ", ids array<bigint>" if with_ids else ""
    pieces = scratch.save(docs.mapInArrow(tokenise(tokenizer_path, capacity, end_id, with_ids), schema), "pieces")
    counts = scratch.save(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    slots = spark.sparkContext.broadcast(places(plan(histogram, capacity), capacity))  # bounded by the capacity
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["task", "length"]).withColumn("rank", F.col("rank") + F.col("base")).drop("task", "base")
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []), "rank"]
    schema = f"doc_id {key}, piece int, start long, length long, ids_crc32 long"
    schema += (", ids array<bigint>" if with_ids else "") + ", sequence_id long, offset long"
    return ranked.select(*names).mapInArrow(place(slots), schema)


def sequences(packed):
    """The token sequences of `pack(..., with_ids=True)`: sequence_id, length, ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids")
    )
