"""MinHash near-dedup with SetSketch registers.

Every text becomes the set of its word shingles, every set a sketch of exponentially spaced,
truncated minima (registers; sketches of two sets merge by their maximum). Texts with equal
sets form a class, and only classes are compared. Classes that agree on a band of registers
meet in a bucket. Within buckets a joint likelihood of the registers drops pairs that are far
below the threshold; the others are confirmed on the full sets.

Buckets do not list all their pairs. A first round compares every class with one leader, in the
largest of its buckets; a second one, in every bucket, the leader of the heaviest component with
one class of each other component. What is then still in different components is related, class
by class, to the larger components of its buckets in which a partner is plausible, and each class
is confirmed against all members of these at once, so that no link between components is left
untested.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lutrin.llm import byte_words as bw
from lutrin.llm.common import Scratch, components, is_empty
from lutrin.llm.runs import changes, fixed_binary, whole_runs

REGISTERS = 128
BAND = 4
#: Base of the register scale, and the scale of its largest step (registers of one element stay positive).
BASE, SCALE = 1.02, 20.0
#: A pair is dropped only where the threshold is so many standard deviations less likely than the best estimate.
DEVIATIONS = 5.0
#: Rows of a bucket that are compared at a time; larger buckets are split into pairs of blocks.
BLOCK = 4096
#: Members of a group, and their shingles, that are held at a time; related texts that meet them in one part.
BLOCK_MEMBERS, BLOCK_SHINGLES, SALT_TEXTS = 2048, 2_000_000, 4096

_FACTORS = bw.mix(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_MASKS = bw.mix(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def shingle_sets(texts, words):
    """Sorted distinct shingles of every text, as 64-bit hashes."""
    step = np.uint64(0x9E3779B97F4A7C15)
    for _, data, offsets in bw.chunks(texts):
        h, first = bw.word_hashes(data, offsets, bw.BLANK_SEPARATED)
        rolled = h
        for k in range(1, words):
            rolled = bw.mix(rolled[: max(0, len(h) - k)] * step + h[k:])
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= words:
                yield np.unique(rolled[a : b - words + 1])
            elif b > a:  # the whole sequence, told apart by its length
                whole = h[a]
                for k in range(a + 1, b):
                    whole = bw.mix(whole * step + h[k])
                yield np.array([bw.mix(whole ^ np.uint64(b - a))], np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def sketches(sets):
    """Registers of each non-empty set: a matrix of 16-bit numbers."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets)])[:-1]
    out = np.empty((len(sets), REGISTERS), np.int16)
    for j in range(REGISTERS):
        least = np.minimum.reduceat((flat ^ _MASKS[j]) * _FACTORS[j], starts)
        exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64)
        out[:, j] = np.clip(np.floor(1 - np.log(exponential / SCALE) / np.log(BASE)), 0, 32767)
    return out


def describe(words):
    """Per document: doc_id, text_md5, n_shingles, node (hash of the set, null if empty), sketch."""

    def run(batches):
        with np.errstate(over="ignore"):
            for batch in batches:
                texts = batch.column(1)
                at = 0
                while at < batch.num_rows:  # a few hundred texts at a time bound the memory
                    part = texts.slice(at, 512)
                    sets = list(shingle_sets(part, words))
                    full = [i for i, s in enumerate(sets) if len(s)]
                    registers = sketches([sets[i] for i in full]) if full else None
                    node, sketch = [None] * len(sets), [None] * len(sets)
                    for row, i in enumerate(full):
                        node[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                        sketch[i] = registers[row].tobytes()
                    md5 = [hashlib.md5((t.as_py() or "").encode()).digest() for t in part]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(at, 512),
                            pa.array(md5, pa.binary()),
                            pa.array([len(s) for s in sets], pa.int64()),
                            pa.array(node, pa.binary()),
                            pa.array(sketch, pa.binary()),
                        ],
                        ["doc_id", "text_md5", "n_shingles", "node", "sketch"],
                    )
                    at += 512

    return run


def band_keys(registers):
    """The bucket of every band of each row."""
    values = np.ascontiguousarray(registers).view(np.uint64 if BAND == 4 else f"V{2 * BAND}")
    with np.errstate(over="ignore"):
        salt = bw.mix(np.arange(1, values.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return bw.mix(bw.mix(values) ^ salt[None, :]).view(np.int64)


def bands(batches):
    """(bucket, node) for every band of a sketch."""
    for batch in batches:
        keys = band_keys(fixed_binary(batch.column(1), np.int16, REGISTERS))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.ravel()), batch.column(0).take(pa.array(np.repeat(np.arange(len(keys)), keys.shape[1])))],
            ["bucket", "node"],
        )


def shared(batches):
    """Rows of buckets with two rows or more; input sorted by bucket."""
    pending, last = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        if pending is not None:
            batch = pa.Table.from_batches([pending, batch]).combine_chunks().to_batches()[0]
        bucket = batch.column(0).to_numpy()
        same = bucket[1:] == bucket[:-1]
        keep = np.concatenate([[last is not None and bucket[0] == last], same])
        keep[:-1] |= same
        last = bucket[-1] if keep[-1] else None
        pending = None if keep[-1] else batch.slice(batch.num_rows - 1)
        yield batch.take(pa.array(np.flatnonzero(keep)))


def log_likelihood(j, u, v, more, less, equal):
    """Joint log-likelihood of register comparisons at similarity j, for relative sizes u and v."""
    p = lambda x: -np.log(1 - np.clip(x, 1e-9, 1) * (BASE - 1) / BASE) / np.log(BASE)
    up, down = p(u - v * j), p(v - u * j)
    return more * np.log(up) + less * np.log(down) + equal * np.log(np.clip(1 - up - down, 1e-9, 1))


def plausible(sketch, size, i, j, threshold):
    """Which pairs of rows may reach the threshold, judged on sketches and set sizes; and their equal registers."""
    small, large = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
    equal = np.zeros(len(i), np.int64)
    ok = small >= threshold * large - 1e-9
    for part in np.array_split(np.flatnonzero(ok), len(i) // 65536 + 1):
        equal[part] = (sketch[i[part]] == sketch[j[part]]).sum(1)
    floor = threshold * REGISTERS - DEVIATIONS * np.sqrt(threshold * (1 - threshold) * REGISTERS)
    ok &= equal >= floor
    at = np.flatnonzero(ok)
    if len(at):
        a, b, e = i[at], j[at], equal[at]
        more = (sketch[a] > sketch[b]).sum(1)
        less = REGISTERS - more - e
        u = size[a] / (size[a] + size[b])
        v = 1 - u
        top = np.minimum(u / v, v / u)
        best = np.full(len(at), -np.inf)
        estimate = np.zeros(len(at))
        for step in np.linspace(0, 1, 41):
            now = log_likelihood(top * step, u, v, more, less, e)
            estimate = np.where(now > best, top * step, estimate)
            best = np.maximum(best, now)
        there = log_likelihood(np.minimum(threshold, top), u, v, more, less, e)
        ok[at] = (estimate >= threshold) | (2 * (best - there) <= DEVIATIONS**2)
    return ok, equal


def leaders(sketch, first, last):
    """Of the rows first..last the one that agrees most with the most common registers."""
    own = np.sort(sketch[first:last], axis=0)
    middle = own[(last - first) // 2]  # lies in any majority
    return first + int(np.argmax((sketch[first:last] == middle).sum(1)))


def delegates(sketch, size, component, weight, a, b, threshold):
    """Pairs (leader, row) of the rows a..b: the leader of the heaviest component with the most similar row of each other."""
    heaviest = np.lexsort((component[a:b], weight[a:b]))[-1] + a
    own = component[a:b] == component[heaviest]
    if own.all():
        return []
    inside = np.flatnonzero(own) + a
    lead = inside[leaders(sketch[inside], 0, len(inside))] if len(inside) > 2 else inside[0]
    others = np.flatnonzero(~own) + a
    ok, equal = plausible(sketch, size, np.full(len(others), lead), others, threshold)
    others, equal = others[ok], equal[ok]
    order = np.lexsort((-equal, component[others]))
    others = others[order]
    others = others[np.unique(component[others], return_index=True)[1]] if len(others) else others
    return [(np.full(len(others), lead), others)]


STAR, DELEGATES, ALL = "star", "delegates", "all"


def propose(threshold, round_):
    """Relations (c, x): texts x that may be linked to the group c. Input sorted by bucket and block.

    In the rounds STAR and DELEGATES the group is the leader of the bucket, in the round ALL a
    component: each row is related to the larger components of which its bucket has a plausible
    partner.
    """

    def run(batches):
        for batch in whole_runs(batches, ["bucket", "block"]):
            node = batch.column("node")
            sketch = fixed_binary(batch.column("sketch"), np.int16, REGISTERS)
            size, bucket = batch.column("n_shingles").to_numpy(), batch.column("bucket").to_numpy()
            labels = batch.column("component").dictionary_encode()
            component, weight = labels.indices.to_numpy(), batch.column("weight").to_numpy()
            first = changes(batch, ["bucket", "block"])
            last = np.append(first[1:], batch.num_rows)
            pairs = []
            for a, b in zip(first, last):
                if round_ == DELEGATES:
                    pairs += delegates(sketch, size, component, weight, a, b, threshold)
                elif round_ == STAR:
                    if b - a < 2:
                        continue
                    lead = a if b - a == 2 else leaders(sketch, a, b)
                    rest = np.delete(np.arange(a, b), lead - a)
                    pairs.append((np.full(len(rest), lead), rest))
                else:
                    pairs += between(sketch, size, component, weight, a, b, threshold, bucket[a])
            c, x = (np.concatenate([p[k] for p in pairs]) if pairs else np.zeros(0, np.int64) for k in (0, 1))
            if round_ == STAR:
                ok, _ = plausible(sketch, size, c, x, threshold)
                c, x = c[ok], x[ok]
            if round_ != ALL:
                group = node.take(pa.array(c))
            else:
                c, x = np.unique(np.stack([component[c], x]), axis=1) if len(c) else (c, x)
                group = labels.dictionary.take(pa.array(c))
            yield pa.RecordBatch.from_arrays([group, node.take(pa.array(x))], ["c", "x"])

    return run


def first_band(sketch, i, j):
    """The first band in which the rows of each pair agree."""
    same = (sketch[i] == sketch[j]).reshape(len(i), REGISTERS // BAND, BAND).all(2)
    return same.argmax(1)


def between(sketch, size, component, weight, a, b, threshold, bucket):
    """Pairs (row of a larger component, row) of the rows a..b, one for each row and plausible component.

    Rows that agree in several bands meet in as many buckets; the first of these tells of them.
    """
    labels, own = np.unique(component[a:b], return_inverse=True)
    if len(labels) == 1:
        return []
    heavy = np.zeros(len(labels), np.int64)
    heavy[own] = weight[a:b]
    rank = np.empty(len(labels), np.int64)
    rank[np.lexsort((labels, heavy))] = np.arange(len(labels))
    rank = rank[own]
    order = np.argsort(rank, kind="stable")  # lighter components first
    rank = rank[order]
    band = int(np.flatnonzero(band_keys(sketch[a : a + 1])[0] == bucket)[0])
    out = []
    for at in range(len(order)):
        begin = int(np.searchsorted(rank, rank[at], side="right"))
        if begin == len(order):
            break
        others = order[begin:] + a
        me = np.full(len(others), order[at] + a)
        ok, _ = plausible(sketch, size, me, others, threshold)
        ok[ok] = first_band(sketch, me[ok], others[ok]) == band
        _, one = np.unique(rank[begin:][ok], return_index=True)
        found = others[ok][one]
        out.append((found, me[: len(found)]))
    return out


def confirm(words, percent):
    """(a, b): links of texts x to a member of their group, decided on full sets.

    Input sorted by group, block and salt, with the members first; these are held as one
    sorted list of (shingle, member), the others pass by.
    """

    def run(batches):
        key, members, flat, owner = None, [], None, None
        with np.errstate(over="ignore"):
            for batch in batches:
                keys = list(zip(*(batch.column(k).to_pylist() for k in ("c", "block", "salt"))))
                node, member = batch.column("node").to_pylist(), batch.column("member").to_pylist()
                out = [], []
                for row, own in enumerate(shingle_sets(batch.column("text"), words)):
                    if keys[row] != key:
                        key, members, flat = keys[row], [], None
                    if member[row]:
                        members.append((node[row], own))
                        continue
                    if not members:
                        continue
                    if flat is None:
                        sizes = np.array([len(s) for _, s in members])
                        flat = np.concatenate([s for _, s in members])
                        owner = np.repeat(np.arange(len(members)), sizes)
                        order = np.argsort(flat, kind="stable")
                        flat, owner = flat[order], owner[order]
                    low = np.searchsorted(flat, own, side="left")
                    n = np.searchsorted(flat, own, side="right") - low
                    at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    both = np.bincount(owner[at], minlength=len(members))
                    linked = np.flatnonzero(100 * both >= percent * (sizes + len(own) - both))
                    linked = [k for k in linked[:2] if members[k][0] != node[row]]
                    if linked:  # one link joins the text to the group
                        out[0].append(members[linked[0]][0])
                        out[1].append(node[row])
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary())], ["a", "b"])

    return run


def split_large(members):
    """Add a block column: 0, or for buckets over BLOCK rows one copy for each pair of blocks."""
    large = members.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    if is_empty(large):
        return members.withColumn("block", F.lit(0).cast("long"))
    n = F.coalesce(F.ceil(F.col("n") / BLOCK), F.lit(1)).cast("long")
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    every = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda k: F.least(k, F.col("own")) * F.col("blocks") + F.greatest(k, F.col("own")),
    )
    return (
        members.join(large, "bucket", "left")
        .withColumn("blocks", n)
        .withColumn("own", own)
        .withColumn("block", F.explode(every))
        .drop("n", "blocks", "own")
    )


def largest_buckets(members):
    """Every class in the largest of its buckets alone; of equally large ones in that with the highest number."""
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n"))
    best = members.join(sizes, "bucket").groupBy("node").agg(F.max(F.struct("n", "bucket")).alias("best"))
    return best.select(F.col("best.bucket").alias("bucket"), "node")


def near_duplicates(docs, doc_id="doc_id", text="text", words=5, percent=80):
    """Link documents whose shingle sets have 100 * intersection >= percent * union.

    One row per row of `docs`: doc_id, n_shingles, component_id (the smallest doc_id that
    links reach, itself included), kept (doc_id = component_id), text_md5 (binary). Words are runs without
    blanks, A-Z lower-cased; a text with fewer than `words` words is one shingle. Null, empty
    and blank texts have no shingles and link with nothing. Rows that repeat a doc_id share a
    component only by their texts and ids; a row with a null doc_id links with nothing, has a
    null component and is kept. Further columns are ignored; an empty table gives no rows.
    Texts of any length are taken whole.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-duplicates")
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, text_md5 binary, n_shingles long, node binary, sketch binary"
    rows = scratch.save(docs.mapInArrow(describe(words), schema), "described")
    classes = rows.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(
        F.min(F.struct("doc_id", "text_md5")).alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")
    )
    classes = scratch.save(classes, "classes")
    members = classes.select("node", "sketch").mapInArrow(bands, "bucket long, node binary")
    members = members.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(shared, "bucket long, node binary")
    members = scratch.save(members, "members")
    edges = _edges(scratch, docs, classes, members, words, percent)
    found = components(scratch, edges)
    ids = classes.select("node", F.col("rep.doc_id").alias("id")).join(found, "node", "left")
    ids = ids.withColumn("component", F.coalesce("component", "node"))
    least = ids.groupBy("component").agg(F.min("id").alias("component_id"))
    ids = ids.join(least, "component").select("node", "component_id")
    return rows.join(ids, "node", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"),
        "text_md5",
    )


def _parts(spark):
    """Partitions of comparisons, which cost time rather than bytes: not to be merged by their size."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _edges(scratch, docs, classes, members, words, percent):
    """Confirmed links between classes: enough of them to join every component."""
    needed = members.select("node").distinct().join(classes.select("node", "rep"), "node")
    needed = needed.select("node", F.col("rep.doc_id").alias("doc_id"), F.col("rep.text_md5").alias("text_md5"))
    whole = F.coalesce("text", F.lit(""))
    texts = docs.withColumn("text", whole).join(needed, "doc_id").where(F.unhex(F.md5(F.encode("text", "UTF-8"))) == F.col("text_md5"))
    texts = scratch.save(texts.select("node", "text"), "texts", compression="zstd")
    if texts.count() > needed.count():  # rows that are repeated as a whole
        texts = scratch.save(texts.dropDuplicates(["node"]), "texts", compression="zstd")
    sketched = classes.select("node", "n_shingles", "sketch")

    def proposals(rows, round_):
        kept = scratch.save(rows, "open")
        rows = split_large(kept).join(sketched, "node")
        rows = rows.repartition(_parts(scratch.spark), "bucket", "block").sortWithinPartitions("bucket", "block", "node")
        rows = rows.select("bucket", "block", "node", "component", "weight", "n_shingles", "sketch")
        found = scratch.save(rows.mapInArrow(propose(percent / 100, round_), "c binary, x binary").distinct(), "relations")
        scratch.drop(kept)
        return found

    def still_open(found):
        """Members of buckets that hold several components, with theirs and how heavy it is."""
        weights = scratch.save(found.groupBy("component").agg(F.count("*").alias("weight")), "weights")
        rows = members.join(found.join(weights, "component"), "node", "left").withColumn("component", F.coalesce("component", "node"))
        rows = rows.withColumn("weight", F.coalesce("weight", F.lit(1).cast("long")))
        several = rows.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        return rows.join(several.where("low <> high").select("bucket"), "bucket")

    def confirmed(relations, found=None):
        groups = relations.select("c").distinct()
        if found is None:
            groups = groups.withColumn("node", F.col("c"))
        else:
            groups = groups.join(found.select(F.col("component").alias("c"), "node"), "c", "left").withColumn("node", F.coalesce("node", "c"))
        return _confirmed(scratch, relations, groups, classes, texts, words, percent)

    single = largest_buckets(members).withColumn("component", F.col("node")).withColumn("weight", F.lit(1).cast("long"))
    links = confirmed(proposals(single, STAR))
    links = links.union(confirmed(proposals(still_open(components(scratch, links)), DELEGATES)))
    found = components(scratch, links)
    return links.union(confirmed(proposals(still_open(found), ALL), found))


def _confirmed(scratch, relations, groups, classes, texts, words, percent):
    """Links (a, b) between a group's members and the texts that are related to it.

    The members of a group come in blocks of bounded size, the texts of a block in salted
    parts, so that neither a large group nor one with many related texts meets in one task.
    """
    groups = groups.join(classes.select("node", "n_shingles"), "node")
    shape = groups.groupBy("c").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_MEMBERS), F.ceil(F.col("size") / BLOCK_SHINGLES)).cast("long")
    shape = shape.select("c", blocks.alias("blocks"))
    shape = shape.join(relations.groupBy("c").agg(F.ceil(F.count("*") / SALT_TEXTS).cast("long").alias("salts")), "c")
    shape = scratch.save(shape, "shape")

    def numbers(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    members = groups.join(shape, "c").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))).withColumn("salt", numbers("salts"))
    related = relations.join(shape, "c").withColumn("salt", F.pmod(F.xxhash64("x"), F.col("salts"))).withColumn("block", numbers("blocks"))
    members = members.select("c", "block", "salt", "node", F.lit(True).alias("member"))
    related = related.select("c", "block", "salt", F.col("x").alias("node"), F.lit(False).alias("member"))
    placed = scratch.save(members.union(related), "placed")
    rows = placed.join(texts, "node").select("c", "block", "salt", "member", "node", "text")
    rows = rows.repartition(_parts(scratch.spark), "c", "block", "salt").sortWithinPartitions("c", "block", "salt", F.desc("member"))
    links = scratch.save(rows.mapInArrow(confirm(words, percent), "a binary, b binary"), "links")
    scratch.drop(placed, shape, relations)  # superseded
    return links
