"""Whitening of vectors from exact, bit-sliced cross-products.

Entries become integers. In a task the rows of a block are shifted by the dimension's least
value, so that they are not negative, and every dimension is cut into bit planes; a plane
packs its bit of 64 rows into a word. The product sum of two dimensions is then the sum over
their planes of 2^(p + q) times the bits that both have set: an AND and a count of ones,
exact whatever the order. Tasks add up these integers, Spark adds up the tasks, and only a
matrix of dimensions by dimensions reaches the driver, where it is centred as integers before
it is divided and decomposed.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lutrin.llm.common import Scratch

#: An entry c becomes floor(SCALE * c) + SHIFT. Fixed values.
SCALE, SHIFT = 64, 1_000_000
#: Rows whose planes a task holds at a time.
BLOCK = 4096
#: Components whose variance is below this share of the largest are rounding, not variance.
LEAST = 1e-12


def entries(batches):
    """(vec_id, x): the integers of each vector, null where one of them does not exist."""
    for batch in batches:
        vectors = batch.column(1)
        if isinstance(vectors, pa.ChunkedArray):
            vectors = vectors.combine_chunks()
        ends = np.concatenate([[0], np.cumsum([0 if v is None else v for v in vectors.value_lengths().to_pylist()])])
        flat = vectors.flatten()
        bad = flat.is_null().to_numpy(zero_copy_only=False)
        c = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
        with np.errstate(over="ignore", invalid="ignore"):
            x = np.floor(SCALE * c)
            bad |= ~(np.abs(x) < 2.0**62)  # not finite, or not a long
            x = np.where(bad, 0, x).astype(np.int64) + SHIFT
        broken = np.concatenate([[0], np.cumsum(bad)])
        known = vectors.is_valid().to_numpy(zero_copy_only=False) & (broken[ends[1:]] == broken[ends[:-1]])
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(x))
        keep = pa.array(np.flatnonzero(known))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), lists.take(keep)], ["vec_id", "x"])


def matrix(column):
    """Lists of equal size as a matrix."""
    width = column.value_lengths()[0].as_py() if len(column) else 0
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def described(batches):
    """(dim, n, total, low, high) of the vectors of one size in a task; totals as decimal text."""
    n, total, low, high = 0, None, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        x = matrix(batch.column(0))
        least, most = x.min(0), x.max(0)
        sums = [int(v) + int(lowest) * len(x) for v, lowest in zip(exact_sum(x - least), least)] if narrow(least, most) else [sum(map(int, v)) for v in x.T]
        if total is None:
            total, low, high = sums, least, most
        else:
            total, low, high = [a + b for a, b in zip(total, sums)], np.minimum(low, least), np.maximum(high, most)
        n += len(x)
    if n:
        k = len(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k, dtype=np.int32)), pa.array([n] * k, pa.int64()), pa.array([str(v) for v in total]), pa.array(low), pa.array(high)],
            ["dim", "n", "total", "low", "high"],
        )


def narrow(low, high):
    """Whether sums of a batch of differences fit into 64 bits."""
    return all(int(b) - int(a) < 1 << 40 for a, b in zip(low, high))


def exact_sum(x):
    return x.sum(0, dtype=np.int64)


def planes(x, low, bits):
    """Bit planes of the shifted columns of x: one row of words for each (dimension, bit)."""
    rows = -(-len(x) // 64) * 64
    out = np.zeros((sum(bits), rows // 64), np.uint64)
    at = 0
    for k, n in enumerate(bits):
        shifted = np.zeros(rows, np.uint64)
        shifted[: len(x)] = (x[:, k].view(np.uint64)) - np.uint64(int(low[k]) % (1 << 64))  # exact modulo 2^64
        for p in range(n):
            plane = ((shifted >> np.uint64(p)) & np.uint64(1)).astype(np.uint8)
            out[at] = np.packbits(plane, bitorder="little").view(np.uint64)
            at += 1
    return out


def scatter(low, bits):
    """(i, j, total) with i <= j: sums of products of shifted columns, added up in the task; as decimal text."""
    weight = [1 << p for n in bits for p in range(n)]
    owner = np.repeat(np.arange(len(bits)), bits)
    wide = 2 * max(bits, default=0) + 32 > 62

    def run(batches):
        sums = np.zeros((len(weight), len(weight)), np.int64)  # common ones of two planes, over all rows of the task
        seen = False
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK):
                seen = True
                own = planes(matrix(batch.column(0).slice(begin, BLOCK)), low, bits)
                for a in range(len(own)):
                    sums[a, a:] += np.bitwise_count(own[a] & own[a:]).sum(1, dtype=np.int64)
        if not seen:
            return
        sums = np.triu(sums) + np.triu(sums, 1).T
        if wide:
            factor = np.array(weight, object)
            product = np.zeros((len(bits), len(bits)), object)
            np.add.at(product, (owner[:, None], owner[None, :]), sums.astype(object) * factor[:, None] * factor[None, :])
        else:
            spread = np.zeros((len(weight), len(bits)), np.int64)
            spread[np.arange(len(weight)), owner] = weight
            product = spread.T @ sums @ spread
        i, j = np.triu_indices(len(bits))
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array([str(int(v)) for v in product[i, j]])], ["i", "j", "total"]
        )

    return run


def whole(column):
    """Sum of whole numbers that are given as decimal text."""
    return F.sum(F.col(column).cast("decimal(38,0)"))


class Fit:
    """Sums, exact covariance and components of the vectors of one size."""

    def __init__(self, n, total, low, cross, components):
        self.n, self.total = n, total
        size = len(total)
        shifted = [t - n * v for t, v in zip(total, low)]
        centred = np.zeros((size, size), object)
        for (i, j), value in cross.items():
            centred[i, j] = centred[j, i] = n * value - shifted[i] * shifted[j]
        self.scatter = centred
        self.covariance = np.array([[int(v) / (n * n) for v in row] for row in centred], float).reshape(size, size)  # rounded once
        values, vectors = np.linalg.eigh(self.covariance)
        self.trace = sum(int(centred[i, i]) for i in range(size)) / (n * n)
        order = np.argsort(-values, kind="stable")[:components]
        order = order[values[order] > LEAST * max(values.max(initial=0), 0)]
        self.values, self.vectors = values[order], vectors[:, order]
        #: Whether n * x - S fits into 64 bits for all entries.
        self.short = n * max((int(h) - int(v) for h, v in zip(self.highs(low, total, n), low)), default=0) < 1 << 62

    @staticmethod
    def highs(low, total, n):
        """A bound of each dimension's entries: all others at their least."""
        return [t - (n - 1) * v for t, v in zip(total, low)]


def deviations(x, fit):
    """n * x - S as integers (64 bits where they fit), and as doubles divided by n."""
    if fit.short and max(map(abs, fit.total), default=0) < 1 << 62 and fit.n * int(np.abs(x).max(initial=0)) < 1 << 62:
        whole = fit.n * x - np.array(fit.total, np.int64)
        return whole, whole / fit.n
    whole = fit.n * x.astype(object) - np.array(fit.total, object)
    return whole, (whole / fit.n).astype(float)


def whitened(centred, fit):
    return (centred @ fit.vectors) / np.sqrt(fit.values)


def moments(fit, mean):
    """Sums of whitened values (`mean` None), or of products of their distances from the mean; one row a component."""
    k = len(fit.value.values)

    def run(batches):
        total = np.zeros((k, 1 if mean is None else k))
        for batch in batches:
            if batch.num_rows:
                w = whitened(deviations(matrix(batch.column(0)), fit.value)[1], fit.value)
                total += w.sum(0)[:, None] if mean is None else (w - mean).T @ (w - mean)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(k, dtype=np.int32), total.shape[1])), pa.array(np.tile(np.arange(total.shape[1], dtype=np.int32), k)), pa.array(total.ravel())],
            ["i", "j", "total"],
        )

    return run


def projected(fit, error):
    """A row for each vector and component."""

    def run(batches):
        own = fit.value
        k = len(own.values)
        share = own.values / own.trace if k else own.values
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK):
                part = batch.slice(begin, BLOCK)
                x = matrix(part.column(1))
                whole, centred = deviations(x, own)
                deviation = [sum(int(v) * int(v) for v in row) for row in whole] if not small(whole) else (whole * whole).sum(1)
                at = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(at)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(at), own.n, np.int64)),
                        pa.array(deviation, pa.int64()).take(pa.array(at)),
                        pa.array(whitened(centred, own).ravel()),
                        pa.array(np.tile(share, len(x))),
                        pa.array(np.full(len(at), error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def small(whole):
    """Whether sums of squares fit into 64 bits."""
    return whole.dtype != object and whole.shape[1] * int(np.abs(whole).max(initial=0)) ** 2 < 1 << 63


def summed(rows, run, keys="i int, j int", value="double"):
    """Numbers that `run` finds in every task, added up; as many as the matrix has entries."""
    found = rows.mapInArrow(run, f"{keys}, total {value}").groupBy("i", "j")
    return found.agg(whole("total").alias("total") if value == "string" else F.sum("total").alias("total")).collect()


def fit_one(rows, components):
    """The fit of vectors of one size. What is collected is bounded by the square of that size."""
    found = rows.mapInArrow(described, "dim int, n long, total string, low long, high long").groupBy("dim")
    found = found.agg(F.sum("n").alias("n"), whole("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"))
    found = sorted(found.collect())
    low = [r.low for r in found]
    bits = [(r.high - r.low).bit_length() for r in found]
    cross = {(r.i, r.j): int(r.total) for r in summed(rows, scatter(low, bits), value="string")}
    return Fit(found[0].n, [int(r.total) for r in found], low, cross, components)


def whiten(vectors, vec_id="vec_id", embedding="embedding", components=32):
    """Whitened principal components of integer vectors.

    One row per remaining row of `vectors` and component: vec_id, component (from 1, by falling
    variance), n (vectors fitted), deviation (sum over dimensions of (n * x - S)^2, exact),
    whitened, explained (share of the variance), identity_error (the largest entry of the
    whitened values' covariance less the identity, measured over all rows).

    Null vectors, those with a null, infinite or NaN entry, and those with an entry whose
    integer is not a long are dropped. Vectors of another size are another table: each size is
    fitted by itself, and vectors without entries give no rows. Repeated rows count each, null
    and repeated identifiers are carried as they are. Components without variance have no
    whitened value and are left out, so equal vectors, or a single one, give no rows. A
    deviation that is not a long stops the job with an overflow error, as it can't be given
    exactly. Further columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "whitening")
    key = vectors.schema[vec_id].dataType.simpleString()
    plain = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    rows = scratch.save(plain.mapInArrow(entries, f"vec_id {key}, x array<bigint>"), "entries")
    sizes = [r[0] for r in rows.groupBy(F.size("x").alias("size")).count().orderBy("size").collect()]  # the sizes that occur, one as a rule
    schema = f"vec_id {key}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    found = spark.createDataFrame([], schema)
    for size in sizes:
        if not size:
            continue
        own = rows.where(F.size("x") == size)
        fit = fit_one(own.select("x"), components)
        if not len(fit.values):
            continue
        shared = spark.sparkContext.broadcast(fit)  # size * components numbers, and the scatter matrix
        k = len(fit.values)
        mean = np.zeros(k)
        for r in summed(own.select("x"), moments(shared, None)):
            mean[r.i] = r.total / fit.n
        covariance = np.zeros((k, k))
        for r in summed(own.select("x"), moments(shared, mean)):
            covariance[r.i, r.j] = r.total / fit.n
        error = float(np.abs(covariance - np.eye(k)).max())
        out = own.mapInArrow(projected(shared, error), schema)
        found = out if len(sizes) == 1 else found.union(out)
    return found
