"""Near-duplicate vectors by search in a robust-pruned flat graph.

Vectors go to the shards of their nearest pivots, several each, so that shards overlap. In
every shard a graph is built: near and random neighbours, pruned so that no neighbour lies
behind another (robust pruning), with links back. The lists that a vector gets in its shards
are united. Every vector is then searched once, in its first shard: greedily from the shard's
medoid and from its own place, then outward over everything within the range. What the search
finds, and near candidates that are within the range in any shard, are verified in double
precision and join components. As links never leave a component, the links of a vector are then
counted exactly among its component, so that both ends of a link count it. A sample of vectors
is compared with all others to measure the recall, a vector at a time, so that large families
don't hide small ones; below the target everything is repeated with more overlap and wider
search, and if that does not help the job stops.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lutrin.llm.common import Scratch, components
from lutrin.llm.runs import fixed_binary, whole_runs

#: Vectors per pivot, and the bound on pivots, which are sent to all tasks.
PER_PIVOT, MAX_PIVOTS = 800, 20_000
#: Shards that a vector belongs to, neighbours kept, beam of the search.
OVERLAP, DEGREE, BEAM = 4, 24, 24
#: Random neighbours that stay whatever hides them, so that a dense family has ways out.
LONG = 4
#: Near and random candidates of a list before it is pruned, and how much nearer a neighbour must be to hide another.
NEAR, RANDOM, ALPHA = 40, 12, 1.2
#: Vectors of a shard that one task holds, and searches at a time; larger shards are split.
BLOCK, QUERIES = 6000, 1024
#: Components up to this size are counted together with others.
SMALL = 500
#: Vectors compared with all others, and the share of a vector's links that must be found on average: of all, and of those with few.
AUDIT, TARGET, ATTEMPTS, FEW = 1000, 0.95, 3, 20
#: The range is searched through neighbours that are this much farther.
SLACK = 0.02


def unit_vectors(batches):
    """(id, vector): unit vectors as bytes of doubles; null for vectors that link with nothing."""
    for batch in batches:
        out = []
        for value in batch.column(1):
            vector = None
            if value.is_valid and len(value.values) and not value.values.null_count:
                raw = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(raw).all() and (top := np.abs(raw).max()) > 0:
                    raw = raw / top  # no overflow or underflow of the norm
                    vector = (raw / np.sqrt((raw * raw).sum()) + 0.0).tobytes()
            out.append(vector)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["vec_id", "vector"])


def matrix(column):
    """Vectors of equal size as a matrix."""
    return fixed_binary(column, np.float64, len(column[0].as_buffer()) // 8) if len(column) else np.zeros((0, 1))


def assign(pivots, overlap):
    """(shard, node, vector, home): a vector with each of its nearest pivots, home for the first."""

    def run(batches):
        own = pivots.value
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = matrix(batch.column(1))
            k = min(overlap, len(own))
            near = np.concatenate([np.argsort(-(part @ own.T), 1, kind="stable")[:, :k] for part in np.array_split(vectors, len(vectors) // 512 + 1)])
            at = pa.array(np.repeat(np.arange(len(vectors)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(near.ravel().astype(np.int64)),
                    batch.column(0).take(at),
                    batch.column(1).take(at),
                    pa.array(np.tile(np.arange(k) == 0, len(vectors))),
                ],
                ["shard", "node", "vector", "home"],
            )

    return run


def pruned(vectors, candidates, degree):
    """Robust pruning of candidate lists (-1: none): the nearest stays and hides those much nearer to it than to the vector."""
    n, width = candidates.shape
    out = np.full((n, degree), -1, np.int64)
    for begin in range(0, n, 256):
        rows = candidates[begin : begin + 256]
        valid = rows >= 0
        far = vectors[np.maximum(rows, 0)]
        own = vectors[begin : begin + len(rows)]
        distance = np.sqrt(np.maximum(2 - 2 * np.einsum("nkd,nd->nk", far, own), 0))
        between = np.sqrt(np.maximum(2 - 2 * np.einsum("nkd,njd->nkj", far, far), 0))
        alive = valid.copy()
        for slot in range(degree):
            masked = np.where(alive, distance, np.inf)
            best = masked.argmin(1)
            some = np.isfinite(masked[np.arange(len(rows)), best])
            if not some.any():
                break
            at = np.flatnonzero(some)
            out[begin + at, slot] = rows[at, best[at]]
            hidden = ALPHA * between[at, best[at]] <= distance[at]
            alive[at] &= ~hidden
            alive[at, best[at]] = False
    return out


def graph(vectors, seed, threshold):
    """Adjacency of one block (pruned lists of near and random candidates, with links back), and near candidates within the range."""
    n = len(vectors)
    nothing = np.zeros(0, np.int64)
    if n < 2:
        return np.full((n, DEGREE), -1, np.int64), nothing, nothing
    near = min(NEAR, n - 1)
    lists, first, second = [], [], []
    single = vectors.astype(np.float32)
    for begin in range(0, n, 1024):
        similarity = single[begin : begin + 1024] @ single.T
        similarity[np.arange(len(similarity)), begin + np.arange(len(similarity))] = -np.inf
        lists.append(np.argpartition(-similarity, near - 1, 1)[:, :near])
        row, slot = np.nonzero(np.take_along_axis(similarity, lists[-1], 1) >= threshold - SLACK)
        a, b = row + begin, lists[-1][row, slot]
        exact = np.einsum("ij,ij->i", vectors[a], vectors[b]) >= threshold
        first.append(a[exact])
        second.append(b[exact])
    rng = np.random.default_rng(seed)
    other = rng.integers(0, n, (n, RANDOM))
    other[other == np.arange(n)[:, None]] = -1
    # a random candidate that is near, too, counts once
    candidates = np.concatenate([np.concatenate(lists), other], 1)
    candidates = unique_rows(candidates)
    out = pruned(vectors, candidates, DEGREE)
    return unique_rows(np.concatenate([out, backward(out, n), other[:, :LONG]], 1)), np.concatenate(first), np.concatenate(second)


def unique_rows(lists):
    """Lists without repeated numbers; -1 fills up."""
    ordered = np.sort(lists, 1)
    ordered[:, 1:][ordered[:, 1:] == ordered[:, :-1]] = -1
    ordered = -np.sort(-ordered, 1)
    used = int((ordered >= 0).sum(1).max(initial=1))
    return ordered[:, : max(1, used)]


def backward(lists, n):
    """For each number up to DEGREE rows that list it, those that have it nearest first.

    Rows with the same nearest number form a chain in the last column, so that all of them
    are reached from it, however many they are.
    """
    row, slot = np.nonzero(lists >= 0)
    target = lists[row, slot]
    order = np.lexsort((row, slot, target))
    target, row, slot = target[order], row[order], slot[order]
    place = np.arange(len(target)) - np.searchsorted(target, target)
    keep = place < DEGREE
    out = np.full((n, DEGREE + 1), -1, np.int64)
    out[target[keep], place[keep]] = row[keep]
    target, row = target[slot == 0], row[slot == 0]
    same = target[1:] == target[:-1]
    out[row[:-1][same], DEGREE] = row[1:][same]
    return out


def build(threshold):
    """Rows of two kinds, from input sorted by shard and block: (node, neighbours, null, null) of every vector, and
    (null, null, a, b), links that join what was found on the way."""

    def run(batches):
        for batch in whole_runs(batches, ["shard", "block"]):
            node = batch.column("node").to_numpy()
            for a, b in runs_of(batch):
                vectors = matrix(batch.column("vector").slice(a, b - a))
                lists, first, second = graph(vectors, int(node[a]) & 0xFFFF, threshold)
                own = node[a:b]
                flat = lists[lists >= 0]
                ends = np.concatenate([[0], np.cumsum((lists >= 0).sum(1))]).astype(np.int32)
                first, second = forest(own[first], own[second])
                nodes, links = pa.nulls(len(own), pa.int64()), pa.nulls(len(first), pa.int64())
                names = ["node", "neighbours", "a", "b"]
                neighbours = pa.ListArray.from_arrays(pa.array(ends), pa.array(own[flat]))
                yield pa.RecordBatch.from_arrays([pa.array(own), neighbours, nodes, nodes], names)
                yield pa.RecordBatch.from_arrays([links, pa.nulls(len(first), neighbours.type), pa.array(first, pa.int64()), pa.array(second, pa.int64())], names)

    return run


def runs_of(batch, keys=("shard", "block")):
    from lutrin.llm.runs import changes

    first = changes(batch, list(keys))
    return zip(first, np.append(first[1:], batch.num_rows))


def search(vectors, lists, queries, own, threshold, beam):
    """Pairs (query, vector) at or above the threshold, in double precision.

    `own` is the place of each query among the vectors, or -1. The greedy part goes on from
    the best unvisited vector of the beam until the whole beam is visited.
    """
    n = len(vectors)
    single = vectors.astype(np.float32)
    medoid = int(np.argmax(single @ single.mean(0)))
    asked = queries.astype(np.float32)
    q = len(queries)
    seen = np.zeros((q, n), bool)
    rows = np.arange(q)
    pool = np.full((q, beam), -1, np.int64)
    score = np.full((q, beam), -np.inf, np.float32)
    open_ = np.zeros((q, beam), bool)

    def offer(row, node):
        """Add unseen (query, vector) pairs to the beams."""
        key = np.unique(row * n + node)
        row, node = key // n, key % n
        fresh = ~seen[row, node]
        row, node = row[fresh], node[fresh]
        seen[row, node] = True
        if not len(row):
            return row, node, np.zeros(0, np.float32)
        return row, node, np.einsum("ij,ij->i", asked[row], single[node])

    def keep(row, node, value):
        nonlocal pool, score, open_
        if not len(row):
            return
        place = np.arange(len(row)) - np.searchsorted(row, row)
        width = int(place.max()) + 1
        more = np.full((q, width), -1, np.int64)
        worth = np.full((q, width), -np.inf, np.float32)
        more[row, place], worth[row, place] = node, value
        pool, score = np.concatenate([pool, more], 1), np.concatenate([score, worth], 1)
        open_ = np.concatenate([open_, more >= 0], 1)
        top = np.argsort(-score, 1, kind="stable")[:, :beam]
        pool, score, open_ = (np.take_along_axis(x, top, 1) for x in (pool, score, open_))

    found_row, found_node = [], []

    def collect(row, node, value):
        hit = value >= threshold - SLACK
        found_row.append(row[hit])
        found_node.append(node[hit])
        return row[hit], node[hit]

    start_row = np.concatenate([rows, rows[own >= 0]])
    start_node = np.concatenate([np.full(q, medoid), own[own >= 0]])
    first = offer(start_row, start_node)
    collect(*first)
    keep(*first)
    while open_.any():
        best = np.where(open_, score, -np.inf).argmax(1)
        live = np.flatnonzero(open_[rows, best])
        open_[live, best[live]] = False
        near = lists[pool[live, best[live]]]
        row = np.repeat(live, near.shape[1])
        node = near.ravel()
        new = offer(row[node >= 0], node[node >= 0])
        collect(*new)
        keep(*new)
    # the range: everything that is reached through vectors near enough
    row, node = np.concatenate(found_row), np.concatenate(found_node)
    while len(row):
        out = []
        for begin in range(0, len(row), 1 << 16):
            near = lists[node[begin : begin + (1 << 16)]]
            r, v = np.repeat(row[begin : begin + (1 << 16)], near.shape[1]), near.ravel()
            out.append(collect(*offer(r[v >= 0], v[v >= 0])))
        row, node = np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])
    row, node = np.concatenate(found_row), np.concatenate(found_node)
    exact = np.zeros(len(row))
    for begin in range(0, len(row), 1 << 18):
        part = slice(begin, begin + (1 << 18))
        exact[part] = np.einsum("ij,ij->i", queries[row[part]], vectors[node[part]])
    hit = exact >= threshold
    return row[hit], node[hit]


def forest(a, b):
    """Pairs that join the same numbers as all pairs (a, b), one less than the numbers of each component."""
    if not len(a):
        return a, b
    names, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(names))
    while True:
        least = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], least)
        np.minimum.at(new, label[y], least)
        new = new[new]
        new = np.minimum(new[label], label)
        if (new == label).all():
            break
        label = new
    away = np.flatnonzero(label != np.arange(len(names)))
    return names[away], names[label[away]]


def look(threshold, beam):
    """Links (a, b) that join what the search finds, from rows sorted by (shard, block, part), indexed vectors first."""

    def run(batches):
        for batch in whole_runs(batches, ["shard", "block", "part"]):
            for a, b in runs_of(batch, ("shard", "block", "part")):
                one = batch.slice(a, b - a)
                asked = one.column("asked").to_numpy(zero_copy_only=False)
                node = one.column("node").to_numpy()
                held = np.flatnonzero(~asked)
                if not len(held):
                    continue
                all_vectors = matrix(one.column("vector"))
                vectors, names = all_vectors[held], node[held]
                order = np.argsort(names, kind="stable")
                place = {int(v): i for i, v in enumerate(names)}
                neighbours = one.column("neighbours")
                width = max([1, *(len(neighbours[int(i)].values or []) for i in held)])
                lists = np.full((len(held), width), -1, np.int64)
                for k, i in enumerate(held):
                    value = neighbours[int(i)].values
                    own = value.to_numpy() if value is not None else np.zeros(0, np.int64)
                    at = np.minimum(np.searchsorted(names[order], own), len(names) - 1)
                    own = order[at][names[order][at] == own]  # those that this shard holds
                    lists[k, : len(own)] = own
                queries = np.flatnonzero(asked)
                pairs = []
                for begin in range(0, len(queries), QUERIES):
                    part = queries[begin : begin + QUERIES]
                    own = np.array([place.get(int(v), -1) for v in node[part]])
                    row, found = search(vectors, lists, all_vectors[part], own, threshold, beam)
                    pairs.append(forest(node[part][row], names[found]))
                me, other = forest(*(np.concatenate([p[k] for p in pairs]) for k in (0, 1))) if pairs else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(me, pa.int64()), pa.array(other, pa.int64())], ["a", "b"])

    return run


def count(threshold):
    """(node, n): rows (copies counted) of its own component within the range of each asked vector, itself included.

    Input sorted by (group, block, part), indexed vectors first, then by component: a group
    is one component, or many small ones that lie one after the other.
    """

    def run(batches):
        for batch in whole_runs(batches, ["group", "block", "part"]):
            for a, b in runs_of(batch, ("group", "block", "part")):
                one = batch.slice(a, b - a)
                asked = one.column("asked").to_numpy(zero_copy_only=False)
                node, copies = one.column("node").to_numpy(), one.column("copies").to_numpy()
                component, vectors = one.column("component").to_numpy(), matrix(one.column("vector"))
                held, queries = np.flatnonzero(~asked), np.flatnonzero(asked)
                total = np.zeros(len(queries), np.int64)
                low = np.searchsorted(component[held], component[queries], side="left")
                high = np.searchsorted(component[held], component[queries], side="right")
                edges = np.flatnonzero(np.diff(component[queries], prepend=component[queries][:1] - 1)) if len(queries) else []
                for begin, end in zip(edges, np.append(edges[1:], len(queries))) if len(queries) else ():
                    own = held[low[begin] : high[begin]]
                    for first in range(begin, end, QUERIES):
                        some = queries[first : min(first + QUERIES, end)]
                        near = vectors[some] @ vectors[own].T >= threshold
                        total[first : first + len(some)] = near @ copies[own]
                yield pa.RecordBatch.from_arrays([pa.array(node[queries]), pa.array(total)], ["node", "n"])

    return run


def compare_all(sample, threshold):
    """How many rows lie within the threshold of each sampled vector."""

    def run(batches):
        names, vectors = sample.value
        total = np.zeros(len(names), np.int64)
        for batch in batches:
            if batch.num_rows:
                own = matrix(batch.column(1))
                for begin in range(0, len(own), 4096):
                    near = vectors @ own[begin : begin + 4096].T >= threshold
                    total += (near * batch.column(2).to_numpy()[begin : begin + 4096][None, :]).sum(1)
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(total)], ["node", "n"])

    return run


def link_vectors(vectors, vec_id="vec_id", embedding="embedding", threshold=0.95):
    """Link vectors whose cosine is at least `threshold`.

    One row per row of `vectors`: vec_id, n_links (other rows linked directly, copies
    counted), component_id (smallest vec_id that links reach, itself included), kept
    (vec_id = component_id), recall (of the audit, the same in all rows; a job that stays below the target stops). Null, empty and zero
    vectors and those with null or non-finite components link with nothing, nor do vectors of
    other sizes link with each other; equal vectors are one node with copies. Rows that
    repeat a vec_id count each; a row with a null vec_id is linked, but has a null component
    and is kept. Further columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vector-graph")
    key = vectors.schema[vec_id].dataType.simpleString()
    plain = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"))
    rows = scratch.save(plain.mapInArrow(unit_vectors, f"vec_id {key}, vector binary"), "rows")
    nodes = rows.where("vector IS NOT NULL").withColumn("row", F.monotonically_increasing_id()).groupBy("vector")
    nodes = nodes.agg(F.min("row").alias("node"), F.count("*").alias("copies"), F.min("vec_id").alias("id"))
    nodes = scratch.save(nodes, "nodes")
    sizes = [r[0] for r in nodes.groupBy(F.length("vector").alias("size")).count().orderBy("size").collect()]  # the sizes that occur
    found = None
    for size in sizes:  # vectors of one size at a time, of which there is one as a rule
        links = _links(scratch, nodes.where(F.length("vector") == size), threshold)
        found = links if found is None else (found[0].union(links[0]), min(found[1], links[1]))
    if found is None:
        return rows.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"), F.lit(1.0).alias("recall")
        )
    linked, recall = found
    named = nodes.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    named = named.join(least, "component")
    named = named.select("vector", "component_id", (F.coalesce("n", F.col("copies")) - 1).alias("n_links"))
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return rows.join(named, "vector", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
        F.lit(float(recall)).alias("recall"),
    )


def _links(scratch, nodes, threshold):
    """((node, component, n) of every vector with a link, recall); n counts rows within the range, copies and itself included."""
    spark = nodes.sparkSession
    total = nodes.count()
    spread = F.xxhash64("vector")
    n_pivots = int(min(MAX_PIVOTS, max(1, total // PER_PIVOT)))
    picked = nodes.select("vector").orderBy(spread, "vector").limit(n_pivots).collect()
    pivots = spark.sparkContext.broadcast(np.stack([np.frombuffer(r.vector) for r in picked]))  # at most MAX_PIVOTS vectors
    picked = nodes.select("node", "vector").orderBy(F.xxhash64("vector", F.lit(1)), "node").limit(AUDIT).collect()
    names = np.array([r.node for r in picked], np.int64)
    sample = spark.sparkContext.broadcast((names, np.stack([np.frombuffer(r.vector) for r in picked])))  # at most AUDIT vectors
    truth = nodes.select("node", "vector", "copies").mapInArrow(compare_all(sample, threshold), "node long, n long")
    truth = truth.groupBy("node").agg(F.sum("n").alias("truth")).join(nodes.select("node", "copies"), "node")
    truth = scratch.save(truth.select("node", (F.col("truth") - F.col("copies")).alias("truth"), "copies"), "audit")
    for attempt in range(ATTEMPTS):
        edges = _search(scratch, nodes, pivots, threshold, OVERLAP + 2 * attempt, BEAM << attempt)
        linked = _counted(scratch, nodes, components(scratch, edges), threshold)
        recall = _recall(truth, linked)
        if recall >= TARGET:
            return linked, recall
    raise RuntimeError(f"the graph finds {recall:.3f} of a vector's links, less than {TARGET}: more overlap or a wider beam is needed")


def _recall(truth, linked):
    """The mean share of its links that a sampled vector has found: of all with links, or of those with few, whichever is less."""
    part = F.least(F.col("truth"), F.coalesce(F.col("n") - F.col("copies"), F.lit(0))) / F.col("truth")
    few = F.avg(F.when(F.col("truth") <= FEW, part))
    seen = truth.where("truth > 0").join(linked, "node", "left").agg(F.avg(part).alias("all"), few.alias("few")).first()
    return min(1.0 if share is None else share for share in seen)


def _counted(scratch, nodes, joined, threshold):
    """(node, component, n) for the nodes of components, counted in blocks of a component or of many small ones."""
    sizes = joined.groupBy("component").agg(F.count("*").alias("size"))
    groups = max(1, -(-joined.count() // BLOCK))
    small = F.pmod(F.xxhash64("component"), F.lit(groups)) - groups  # below all components' numbers
    members = joined.join(scratch.save(sizes, "sizes"), "component").join(nodes.select("node", "vector", "copies"), "node")
    members = members.withColumn("blocks", F.when(F.col("size") > SMALL, F.ceil(F.col("size") / BLOCK)).otherwise(1).cast("long"))
    members = members.withColumn("group", F.when(F.col("size") > SMALL, F.col("component")).otherwise(small))
    members = scratch.save(members.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks"))), "linked")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    columns = ["node", "component", "vector", "copies"]
    held = members.select("group", F.col("own").alias("block"), every.alias("part"), F.lit(False).alias("asked"), *columns)
    asked = members.select("group", every.alias("block"), F.col("own").alias("part"), F.lit(True).alias("asked"), *columns)
    keys = ["group", "block", "part"]
    work = held.union(asked).repartition(*keys).sortWithinPartitions(*keys, "asked", "component", "node")
    counts = work.mapInArrow(count(threshold), "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    return scratch.save(joined.join(counts, "node"), "counted")


def _search(scratch, nodes, pivots, threshold, overlap, beam):
    schema = "shard long, node long, vector binary, home boolean"
    members = nodes.select("node", "vector").mapInArrow(assign(pivots, overlap), schema)
    members = scratch.save(members, "members")
    sizes = members.groupBy("shard").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks"))
    members = members.join(sizes, "shard").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    inside = members.select("shard", "block", "node", "vector").repartition("shard", "block").sortWithinPartitions("shard", "block", "node")
    lists = scratch.save(inside.mapInArrow(build(threshold), "node long, neighbours array<bigint>, a long, b long"), "lists")
    united = lists.where("node IS NOT NULL").groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"))

    def numbers():
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))

    held = members.join(united, "node").withColumn("part", numbers())
    held = held.select("shard", "block", "part", F.lit(False).alias("asked"), "node", "vector", "neighbours")
    asked = members.where("home").withColumn("part", F.col("block")).drop("block").withColumn("block", numbers())
    none = F.lit(None).cast("array<bigint>").alias("neighbours")
    asked = asked.select("shard", "block", "part", F.lit(True).alias("asked"), "node", "vector", none)
    work = held.union(asked).repartition("shard", "block", "part").sortWithinPartitions("shard", "block", "part", "asked", "node")
    found = scratch.save(work.mapInArrow(look(threshold, beam), "a long, b long"), "found")
    return found.union(lists.where("a IS NOT NULL").select("a", "b"))
