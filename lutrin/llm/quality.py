"""Quality scores from document statistics: random Fourier features, ridge, isotonic calibration.

Every text is described by some thirty statistics of its bytes, words and lines. Random
Fourier features of the standardised statistics approximate a Gaussian kernel, so ridge
regression on them is a kernel method whose normal equations add up over partitions. They are
added up for each fold of the labelled rows apart; a fold's complement is the total less the
fold, so scores of rows that a model has not seen calibrate it at no further pass.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lutrin.llm import byte_words as bw
from lutrin.llm.common import Scratch

#: Random Fourier features, width of the Gaussian kernel as a multiple of the root of the number of statistics, ridge penalty for a row.
FEATURES, WIDTH, PENALTY, SEED = 384, 0.7, 1e-4, 13
#: Standardised statistics beyond this are cut to it.
FAR = 4.0
#: Labelled rows whose number falls on HELD modulo FOLDS are never learned from; the others are the folds of the calibration.
FOLDS, HELD = 5, 0
#: Bins of raw scores that are calibrated.
BINS, LOW, HIGH = 2048, -0.5, 1.5

_CLASSES = np.zeros((7, 256), bool)  # upper, lower, digit, sentence mark, other mark, line break, beyond ASCII
_CLASSES[0, 65:91] = _CLASSES[1, 97:123] = _CLASSES[2, 48:58] = True
_CLASSES[3, [ord(c) for c in ".,;:!?'\"()-"]] = True
_CLASSES[4, [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:!?'\"()-"]] = True
_CLASSES[5, [10, 13]] = True
_CLASSES[6, 128:] = True
_LETTER = _CLASSES[0] | _CLASSES[1] | _CLASSES[6]
_LINE = np.ones(256, bool)
_LINE[[10, 13]] = False

STATISTICS = (
    "bytes words lines upper lower digit mark symbol breaks beyond capital_share word_length word_spread long_words short_words bare_words"
    " shouted capitalised marked_ends symbol_ends distinct_words commonest repeated_next distinct_pairs distinct_runs doubled entropy"
    " line_length line_spread distinct_lines full_lines"
).split()


def per_text(first, values):
    """Sums of values between the bounds of each text."""
    return np.diff(np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])[first])


def distinct(first, values):
    """(number of distinct values of each text, how often its commonest occurs)."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((values, text))
    text, values = text[order], values[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (values[1:] != values[:-1])
    at = np.flatnonzero(new)
    n = np.bincount(text[at], minlength=len(first) - 1)
    most = np.zeros(len(first) - 1)
    np.maximum.at(most, text[at], np.diff(np.append(at, len(text))))
    return n, most


def pairs(h):
    """Hash of each value with the next."""
    return bw.mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) if len(h) else h


def within(first, n):
    """Which of the n - 1 neighbours of n values belong to one text."""
    inside = np.ones(max(n - 1, 0), bool)
    edge = first[1:-1]
    inside[edge[(edge > 0) & (edge < n)] - 1] = False
    return inside


def grouped(first, inside):
    """Bounds of each text among those neighbours that are inside."""
    return np.concatenate([[0], np.cumsum(inside)])[np.clip(np.minimum(first, len(inside)), 0, None)]


def statistics(data, offsets):
    """One row of STATISTICS for each text."""
    n = np.diff(offsets).astype(float)
    some = np.maximum(n, 1)
    kinds = [per_text(offsets, c[data]) for c in _CLASSES]
    upper, lower, digit, mark, symbol, breaks, beyond = kinds
    starts, ends, first = bw.bounds(data, offsets, bw.BLANK_SEPARATED)
    words = np.diff(first).astype(float)
    word = np.maximum(words, 1)
    size = (ends - starts).astype(float)
    length = per_text(first, size) / word
    sums = np.concatenate([[0], np.cumsum(_LETTER[data])])
    letters = sums[ends] - sums[starts]
    caps = np.concatenate([[0], np.cumsum(_CLASSES[0][data])])
    capital = caps[ends] - caps[starts]
    last, opening = data[np.maximum(ends - 1, 0)] if len(ends) else data[:0], data[starts]
    h = bw.hashes(bw.lower(data), starts, ends)
    n_distinct, most = distinct(first, h)
    inside = within(first, len(h))
    two = grouped(first, inside)
    follow = (h[1:] == h[:-1])[inside] if len(h) else h
    n_pairs, _ = distinct(two, pairs(h)[inside])
    couples = np.maximum(np.diff(two), 1)
    # runs of eight bytes, at every fourth place of a text
    text = np.repeat(np.arange(len(n)), np.diff(offsets))
    place = np.arange(len(data)) - offsets[text]
    at = np.flatnonzero((place % 4 == 0) & (place + 8 <= np.diff(offsets)[text]))
    owner = text[at]
    eight = np.lib.stride_tricks.sliding_window_view(data, 8)[at].copy().view(np.uint64).ravel() if len(at) else np.zeros(0, np.uint64)
    run_first = np.searchsorted(owner, np.arange(len(n) + 1))
    n_runs, _ = distinct(run_first, eight)
    same = np.zeros(len(data), bool)
    same[1:] = (data[1:] == data[:-1]) & ~_LETTER[data[1:]] & (data[1:] > 32)
    same[offsets[:-1][n > 0]] = False
    counts = np.bincount(text * 256 + data, minlength=256 * len(n)).reshape(-1, 256) / some[:, None]
    entropy = -(counts * np.log2(np.where(counts > 0, counts, 1))).sum(1)
    line_starts, line_ends, line_first = bw.bounds(data, offsets, _LINE)
    lines = np.diff(line_first).astype(float)
    line = np.maximum(lines, 1)
    line_size = (line_ends - line_starts).astype(float)
    line_length = per_text(line_first, line_size) / line
    n_lines, _ = distinct(line_first, bw.hashes(data, line_starts, line_ends))
    closed = _CLASSES[3][data[np.maximum(line_ends - 1, 0)]] if len(line_ends) else line_ends
    columns = [
        np.log1p(n),
        np.log1p(words),
        np.log1p(lines),
        upper / some,
        lower / some,
        digit / some,
        mark / some,
        symbol / some,
        breaks / some,
        beyond / some,
        upper / np.maximum(upper + lower, 1),
        np.log1p(length),
        np.log1p(np.sqrt(np.maximum(per_text(first, size * size) / word - length**2, 0))),
        per_text(first, size > 16) / word,
        per_text(first, size == 1) / word,
        per_text(first, letters == 0) / word,
        per_text(first, (capital == letters) & (letters > 1)) / word,
        per_text(first, _CLASSES[0][opening] & (capital < letters)) / word,
        per_text(first, _CLASSES[3][last]) / word,
        per_text(first, _CLASSES[4][last]) / word,
        n_distinct / word,
        most / word,
        per_text(two, follow) / couples,
        n_pairs / couples,
        n_runs / np.maximum(np.diff(run_first), 1),
        per_text(offsets, same) / some,
        entropy,
        np.log1p(line_length),
        np.log1p(np.sqrt(np.maximum(per_text(line_first, line_size**2) / line - line_length**2, 0))),
        n_lines / line,
        per_text(line_first, closed) / line,
    ]
    return np.stack(columns, 1)


def describe(batches):
    """(doc_id, features) of whole texts; a null text is an empty one."""
    with np.errstate(over="ignore"):
        for batch in batches:
            for first, data, offsets in bw.chunks(batch.column(1)):
                rows = statistics(data, offsets)
                ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(rows)), pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))], ["doc_id", "features"]
                )


class Kernel:
    """Random Fourier features of standardised statistics, and a constant."""

    def __init__(self, mean, deviation):
        self.mean = np.array(mean)
        self.deviation = np.where(np.array(deviation) > 1e-9, deviation, 1.0)
        rng = np.random.default_rng(SEED)
        size = len(self.mean)
        self.frequencies = rng.normal(size=(size, FEATURES)) / (WIDTH * np.sqrt(size))
        self.phases = rng.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, rows):
        standard = np.clip((rows - self.mean) / self.deviation, -FAR, FAR)
        waves = np.sqrt(2 / FEATURES) * np.cos(standard @ self.frequencies + self.phases)
        return np.concatenate([waves, np.ones((len(rows), 1))], 1)


def matrix(column):
    return column.flatten().to_numpy().reshape(len(column), len(STATISTICS))


def normal_equations(kernel):
    """(fold, i, row): row i of the weighted products of features with features and labels, added up in the task."""

    def run(batches):
        size = FEATURES + 1
        sums = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            z, fold = kernel.value(matrix(batch.column("features"))), batch.column("fold").to_numpy()
            n, good = batch.column("n").to_numpy().astype(float), batch.column("good").to_numpy().astype(float)
            for k in np.unique(fold):
                own = fold == k
                part = np.concatenate([(z[own] * n[own, None]).T @ z[own], z[own].T @ good[own, None]], 1)
                sums[int(k)] = sums[int(k)] + part if int(k) in sums else part
        for k, total in sums.items():
            ends = np.arange(size + 1, dtype=np.int32) * (size + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(size, k, np.int32)),
                    pa.array(np.arange(size, dtype=np.int32)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(total.ravel())),
                ],
                ["fold", "i", "row"],
            )

    return run


def add_up(key, table):
    """Sum of the rows of one line of the equations: one row of fixed size for each task."""
    rows = table.column("row").combine_chunks().flatten().to_numpy().reshape(table.num_rows, FEATURES + 2)
    total = rows.sum(0)
    return pa.table({"fold": [key[0].as_py()], "i": [key[1].as_py()], "row": pa.array([total], pa.list_(pa.float64()))}, schema=EQUATIONS)


EQUATIONS = pa.schema([("fold", pa.int32()), ("i", pa.int32()), ("row", pa.list_(pa.float64()))])


def ridge(equations):
    """Coefficients from summed equations; the constant is not penalised."""
    left, right = equations[:, :-1], equations[:, -1]
    rows = left[-1, -1]
    penalty = np.full(len(left), PENALTY * max(rows, 1.0))
    penalty[-1] = 1e-9
    return np.linalg.solve(left + np.diag(penalty), right)


def bins_of(raw):
    return np.clip((raw - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(np.int64)


def binned(kernel, models):
    """(bin, n, good) of labelled rows, scored by the model that has not seen their fold."""

    def run(batches):
        total = np.zeros((2, BINS))
        for batch in batches:
            if batch.num_rows:
                z, fold = kernel.value(matrix(batch.column("features"))), batch.column("fold").to_numpy()
                raw = np.empty(len(z))
                for k in np.unique(fold):
                    raw[fold == k] = z[fold == k] @ models[int(k)]
                at = bins_of(raw)
                total += [np.bincount(at, batch.column(name).to_numpy(), BINS) for name in ("n", "good")]
        used = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), *(pa.array(t[used].astype(np.int64)) for t in total)], ["bin", "n", "good"]
        )

    return run


def isotonic(bins):
    """Pool adjacent violators: (raw scores, rising shares of good rows) to interpolate between. `bins`: sorted (bin, n, good)."""
    blocks = []  # first bin, last bin, n, good
    for k, n, good in bins:
        blocks.append([k, k, n, good])
        while len(blocks) > 1 and blocks[-2][3] * blocks[-1][2] >= blocks[-1][3] * blocks[-2][2]:
            _, last, n, good = blocks.pop()
            blocks[-1][1], blocks[-1][2], blocks[-1][3] = last, blocks[-1][2] + n, blocks[-1][3] + good
    middle = [LOW + (HIGH - LOW) * (edge + 0.5) / BINS for a, b, _, _ in blocks for edge in ((a, b) if b > a else (a,))]
    share = [good / n for a, b, n, good in blocks for _ in ((a, b) if b > a else (a,))]
    return np.array(middle), np.array(share)


def scored(kernel, model, curve, threshold):
    """(doc_id, score, predicted)."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                rows = matrix(batch.column(1))
                score = np.concatenate([np.interp(kernel.value(part) @ model, *curve) for part in np.array_split(rows, len(rows) // 4096 + 1)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"]
                )

    return run


def fold_of(column):
    """crc32 of an identifier as text, modulo FOLDS; a null one counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)).cast("int")


def quality_scores(docs, labels, doc_id="doc_id", text="text", label_id="doc_id", quality="quality", threshold=0.3):
    """Score every text from 0 to 1: how likely a label of 1 is.

    One row per row of `docs`: doc_id, held_out (the row is never learned from: crc32 of its
    identifier modulo 5 is 0), score, predicted (1 from the threshold on). Only whole texts
    decide a score; nothing else of a row does. A null text is an empty one, and empty texts
    are scored like others; a null doc_id is held out. Labels are joined by identifier: rows of
    `labels` with a null identifier or a null label teach nothing, a repeated or contradicting
    one counts each time, as does a repeated document. With labels of one value that is the
    score of all texts, without any it is one half. Equal texts have equal scores. Further
    columns of both tables are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    key = docs.schema["doc_id"].dataType.simpleString()
    rows = scratch.save(docs.mapInArrow(describe, f"doc_id {key}, features array<double>"), "statistics")
    known = labels.select(F.col(label_id).alias("doc_id"), (F.col(quality) == 1).cast("int").alias("good")).where("doc_id IS NOT NULL AND good IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("good").alias("good"))
    known = known.withColumn("fold", fold_of("doc_id")).where(F.col("fold") != HELD)
    learned = scratch.save(rows.join(known, "doc_id").select("features", "fold", "n", "good"), "learned")
    moments = rows.agg(*(f(F.col("features")[k]) for k in range(len(STATISTICS)) for f in (F.avg, F.stddev_pop))).first()
    kernel = spark.sparkContext.broadcast(Kernel([moments[2 * k] or 0.0 for k in range(len(STATISTICS))], [moments[2 * k + 1] or 0.0 for k in range(len(STATISTICS))]))
    model, curve = _fit(learned, kernel)
    out = rows.mapInArrow(scored(kernel, model, curve, threshold), f"doc_id {key}, score double, predicted int")
    return out.select("doc_id", (fold_of("doc_id") == HELD).alias("held_out"), "score", "predicted")


def _fit(learned, kernel):
    """(coefficients, calibration). What is collected has the size of the model, a matrix for each fold and the bins."""
    equations = learned.mapInArrow(normal_equations(kernel), "fold int, i int, row array<double>")
    found = equations.groupBy("fold", "i").applyInArrow(add_up, "fold int, i int, row array<double>").collect()
    size = FEATURES + 1
    folds = {}
    for r in found:
        folds.setdefault(r.fold, np.zeros((size, size + 1)))[r.i] = r.row
    if not folds:
        return np.zeros(size), (np.array([0.0]), np.array([0.5]))
    total = sum(folds.values())
    models = {k: ridge(total - own if len(folds) > 1 else total) for k, own in folds.items()}
    bins = learned.mapInArrow(binned(kernel, models), "bin int, n long, good long").groupBy("bin")
    bins = sorted(map(tuple, bins.agg(F.sum("n"), F.sum("good")).collect()))  # at most BINS rows
    return ridge(total), isotonic(bins)
