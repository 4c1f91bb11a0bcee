"""Language identification by fusing evidence in Bayes' rule.

Three sources are combined: the likelihood of a text's letter trigrams in each language, what
a page or record declares about itself, and where it comes from. The last is a prior of the
host, smoothed towards its registered domain, that towards the address suffix, and that
towards the whole corpus; its counts come from grouped aggregation over all rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lutrin.llm import byte_words as bw
from lutrin.llm.common import Scratch

BUCKETS = 1 << 15
#: Labelled rows that the trigram model is fitted on, about; a language with fewer among them has LEAST_ROWS, or all it has.
SAMPLE_ROWS, LEAST_ROWS = 20_000, 1000
#: A text counts as at most so many independent trigrams.
EFFECTIVE = 60.0
#: Rows of its parent that a host, domain or suffix prior is smoothed with.
STRENGTH = 10.0
UNKNOWN = "und"
#: Share of a text's trigrams that may be names, keys or noise in any language.
NOISE = 0.25
#: A row is rejected as unknown only from this posterior on.
CERTAIN = 0.99
#: Counts or terms that a task holds in one array, about.
HELD = 1 << 21

# Letters, blanks as one class, everything else dropped from the trigrams.
_CLASS = np.zeros(256, np.uint32)
_CLASS[97:123] = np.arange(97, 123)
_CLASS[128:] = np.arange(128, 256)


def letters_of(data, offsets):
    """Letters (a to z, and non-ASCII bytes) of each text."""
    sums = np.concatenate([[0], np.cumsum(_CLASS[bw.lower(data)] > 0)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def trigrams(data, offsets):
    """Bucket of each letter trigram, and the text it belongs to; a word ends with one blank."""
    c = _CLASS[bw.lower(data)]
    text = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    keep = c > 0
    keep[1:] |= c[:-1] > 0  # one blank after a word
    edge = offsets[:-1][np.diff(offsets) > 0]
    keep[edge] |= c[edge] > 0
    c, text = c[keep], text[keep]
    if len(c) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    code = (c[:-2] << np.uint32(16)) | (c[1:-1] << np.uint32(8)) | c[2:]
    inside = (text[2:] == text[:-2]) & (c[1:-1] > 0)
    code = code[inside] * np.uint32(0x9E3779B1)
    return (code >> np.uint32(17)).astype(np.int64), text[:-2][inside]


def tag(declared):
    """Primary language of a declaration, in lower case, without script, region or variant; other text as it is, but for case and blanks."""
    plain = F.lower(F.trim(declared.cast("string")))
    return F.when(plain != "", F.regexp_replace(plain, r"^([a-z]{2,8})[-_].*$", "$1"))


def count_trigrams(languages):
    """(language, bucket, n) of labelled rows, added up in the task; only what occurs is held."""

    def run(batches):
        number = {language: i for i, language in enumerate(languages)}
        keys, counts, held = [], [], 0

        def added():
            key, place = np.unique(np.concatenate(keys), return_inverse=True)
            return [key], [np.bincount(place, np.concatenate(counts)).astype(np.int64)]

        for batch in batches:
            labels = np.array([number.get(x, -1) for x in batch.column(0).to_pylist()])
            for row, data, offsets in bw.chunks(batch.column(1)):
                code, text = trigrams(data, offsets)
                label = labels[row + text]
                known = label >= 0
                key, n = np.unique(label[known] * BUCKETS + code[known], return_counts=True)
                keys.append(key)
                counts.append(n)
                held += len(key)
                if held > HELD:
                    keys, counts = added()
                    held = 0
        if keys:
            (key,), (n,) = added()
            for at in range(0, len(key), HELD):
                k = key[at : at + HELD]
                columns = [pa.array(k // BUCKETS, pa.int32()), pa.array(k % BUCKETS, pa.int32()), pa.array(n[at : at + HELD], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["language", "bucket", "n"])

    return run


def fit(rows, label="label", text="text", sample_rows=SAMPLE_ROWS, spread=()):
    """A trigram model of every label that occurs, from a sample of its rows, picked by a hash.

    About `sample_rows` rows are picked in all, and besides so many of each rare label that it
    has LEAST_ROWS (at most `sample_rows`) or all its rows. The hash is that of the text and the columns
    `spread`, so it does not depend on how files are split; rows that agree in all of these are picked
    together. Returns (languages, log-probabilities by bucket and
    language). The last column is the unknown language, which finds every bucket alike.
    """
    rows = rows.where(F.col(label) != UNKNOWN)
    sizes = rows.groupBy(label).agg(F.count("*").alias("n")).collect()  # as many rows as the model has languages
    total = sum(r["n"] for r in sizes)
    languages = sorted(r[0] for r in sizes)
    counts = np.zeros((len(languages), BUCKETS))
    if languages:
        shares = [(r[0], min(1.0, max(sample_rows / total, min(LEAST_ROWS, sample_rows) / r["n"]))) for r in sizes]
        shares = rows.sparkSession.createDataFrame(shares, "label string, share double")
        hashed = rows.select(F.col(label).alias("label"), text, F.xxhash64(text, *spread).alias("h"))
        picked = hashed.join(F.broadcast(shares), "label").where(F.pmod("h", F.lit(1_000_000)) < F.col("share") * 1_000_000)
        picked = picked.select("label", text).mapInArrow(count_trigrams(languages), "language int, bucket int, n long")
        found = picked.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toArrow()  # languages * BUCKETS rows at most
        counts[found["language"].to_numpy(), found["bucket"].to_numpy()] = found["n"].to_numpy()
    # unseen buckets have half of the probability at most, or a language of few rows would be like the unknown one
    seen = counts.sum(1, keepdims=True)
    extra = np.minimum(0.5, seen / BUCKETS)
    p = (counts + extra) / np.maximum(seen + extra * BUCKETS, 1)
    p = (1 - NOISE) * p + NOISE / BUCKETS
    table = np.concatenate([np.log(p), np.full((1, BUCKETS), -np.log(BUCKETS))])
    return [*languages, UNKNOWN], np.ascontiguousarray(table.T.astype(np.float32))


def log_likelihoods(table, code, text, n):
    """Sum over the trigrams of each of `n` texts, for all languages at once; `text` ascends."""
    sums = np.zeros((n, table.shape[1]))
    step = max(1, HELD // table.shape[1])
    for at in range(0, len(code), step):
        part = text[at : at + step]
        first = np.flatnonzero(np.diff(part, prepend=-1))
        sums[part[first]] += np.add.reduceat(table[code[at : at + step]], first, axis=0, dtype=np.float64)
    return sums


def score(model):
    """(id, declared, host, likelihoods, trigrams) of each row; the log-likelihoods are tempered."""

    def run(batches):
        languages, table = model.value
        for batch in batches:
            texts = batch.column(3)
            for row, data, offsets in bw.chunks(texts):
                n = len(offsets) - 1
                code, text = trigrams(data, offsets)
                sums = log_likelihoods(table, code, text, n)
                count = np.bincount(text, minlength=n)
                weight = np.minimum(1.0, EFFECTIVE / np.maximum(count, 1))
                sums = (sums - sums.max(1, keepdims=True)) * weight[:, None]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, n),
                        batch.column(1).slice(row, n),
                        batch.column(2).slice(row, n),
                        pa.array(list(sums), pa.list_(pa.float64())),
                        pa.array(count, pa.int64()),
                        pa.array(letters_of(data, offsets), pa.int64()),
                    ],
                    ["id", "declared", "host", "likelihoods", "trigrams", "letters"],
                )

    return run


def host_of(address):
    """Host of an address; one without a scheme is a host as it is."""
    rest = F.when(F.instr(address, "://") > 0, F.substring_index(F.substring_index(address, "://", -1), "/", 1)).otherwise(address)
    return F.lower(F.regexp_extract(rest, r"^[^/?#:]*", 0))


def vector(columns):
    return F.array(*columns)


def priors(scored, languages):
    """Language counts of each host, its domain, its suffix and the corpus, from the texts alone."""
    size = len(languages)
    weight = F.transform("likelihoods", lambda x: F.exp(x))
    scored = scored.where("trigrams > 0").withColumn("p", weight)
    scored = scored.withColumn("total", F.aggregate("p", F.lit(0.0), lambda a, x: a + x))
    sums = [F.sum(F.col("p")[i] / F.col("total")).alias(f"n{i}") for i in range(size)]
    hosts = scored.groupBy(F.coalesce("host", F.lit("")).alias("host")).agg(*sums)
    hosts = hosts.withColumn("domain", F.substring_index("host", ".", -2))
    hosts = hosts.withColumn("suffix", F.when(F.instr("host", ".") > 0, F.substring_index("host", ".", -1)).otherwise(F.lit("")))
    for level, group in (("domain", ["domain"]), ("suffix", ["suffix"])):
        above = hosts.groupBy(*group).agg(vector([F.sum(f"n{i}") for i in range(size)]).alias(f"{level}_counts"))
        hosts = hosts.join(above, group)
    return hosts.select("host", vector([F.col(f"n{i}") for i in range(size)]).alias("host_counts"), "domain_counts", "suffix_counts")


def fuse(model, corpus, declared, certain):
    """Posterior of each row from its own likelihoods and the counts of the corpus without it."""

    def run(batches):
        languages, confusion = model, declared
        number = {x: i for i, x in enumerate(languages)}
        n = len(languages)
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            matrix = lambda name: np.array(batch.column(name).to_pylist(), float).reshape(rows, n)
            likelihoods = matrix("likelihoods")
            count = batch.column("trigrams").to_numpy()
            own = np.exp(likelihoods)
            own = own / own.sum(1, keepdims=True) * (count > 0)[:, None]
            prior = (corpus - own + 1.0) / (corpus.sum() - own.sum(1, keepdims=True) + n)
            for level in ("suffix_counts", "domain_counts", "host_counts"):
                counts = np.maximum(matrix(level) - own, 0)
                prior = (counts + STRENGTH * prior) / (counts.sum(1, keepdims=True) + STRENGTH)
            said = np.array([number.get(x, -1) for x in batch.column("declared").to_pylist()])
            total = likelihoods + np.log(prior) + np.where(said[:, None] >= 0, np.log(confusion[:, said].T), 0.0)
            posterior = np.exp(total - total.max(1, keepdims=True))
            posterior /= posterior.sum(1, keepdims=True)
            best = posterior.argmax(1)
            top = posterior[np.arange(rows), best]
            read = np.where(count > 0, likelihoods.argmax(1), n - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([languages[k] for k in best]),
                    pa.array(top),
                    pa.array([languages[k] for k in read]),
                    batch.column("declared"),
                    pa.array(count, pa.int64()),
                    pa.array((batch.column("letters").to_numpy() > 0) & (posterior[:, n - 1] < certain)),
                ],
                ["id", "language", "posterior", "text_language", "declared", "trigrams", "accepted"],
            )

    return run


def identify(docs, doc_id="doc_id", text="text", declared="lang", address="source", label=None, certain=CERTAIN, sample_rows=SAMPLE_ROWS, spread=None):
    """The language of every row of `docs`.

    One row per row: id, language, posterior, text_language (by the text alone), declared,
    trigrams, accepted. `label` (by default the declared language) trains the trigram model;
    every label that occurs is modelled, however rare. Labels are taken by their primary language (`en-CA`,
    `EN` and `en` are one), and so are `language`, `text_language` and `declared`. The sample depends on the
    contents of the rows alone, by text and the columns `spread` (by default `doc_id`).
    Rejected are rows without letters, and those that are in an unknown language with a
    posterior of `certain` or more; doubt between known languages rejects nothing. A null or
    empty text, or one without letters, has no evidence of its own: its language is that of
    its other evidence. A null
    declaration, one that is no label, and a null address count as no evidence. Equal posteriors go to
    the language that sorts first; null and repeated ids are carried as they are; further
    columns are ignored; an empty table gives no rows. Texts are read whole.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "language")
    whole = F.coalesce(F.col(text), F.lit(""))
    said = tag(F.col(declared)) if declared else F.lit(None).cast("string")
    host = host_of(F.col(address).cast("string")) if address else F.lit(None).cast("string")
    rows = docs.select(F.col(doc_id).alias("id"), said.alias("declared"), host.alias("host"), whole.alias("text"))
    spread = [doc_id] if spread is None else spread
    labelled = docs.select(tag(F.col(label or declared)).alias("label"), whole.alias("text"), *(F.col(c).alias(f"spread{i}") for i, c in enumerate(spread)))
    model = fit(labelled, sample_rows=sample_rows, spread=[f"spread{i}" for i in range(len(spread))])
    languages = model[0]
    key = rows.schema["id"].dataType.simpleString()
    schema = f"id {key}, declared string, host string, likelihoods array<double>, trigrams long, letters long"
    scored = scratch.save(rows.mapInArrow(score(spark.sparkContext.broadcast(model)), schema), "scored")  # BUCKETS * languages floats
    hosts = scratch.save(priors(scored, languages), "hosts")
    n = len(languages)
    sums = hosts.agg(*(F.sum(F.col("host_counts")[i]) for i in range(n))).first()
    corpus = np.array([x or 0.0 for x in sums])
    confusion = np.full((n, n), 1.0)  # of the text's language (rows) and the declared one
    best = F.array_position("likelihoods", F.array_max("likelihoods")) - 1
    agreed = scored.where(F.col("trigrams") > 0).groupBy(best.cast("int").alias("k"), "declared").agg(F.count("*").alias("n"))
    for r in agreed.where(F.col("declared").isin(languages[:-1])).collect():  # languages squared rows at most
        confusion[r.k, languages.index(r.declared)] += r.n
    confusion /= confusion.sum(1, keepdims=True)
    zero = F.array(*[F.lit(0.0)] * n)
    joined = scored.withColumn("host", F.coalesce("host", F.lit(""))).join(hosts, "host", "left")
    for level in ("host_counts", "domain_counts", "suffix_counts"):
        joined = joined.withColumn(level, F.coalesce(level, zero))
    schema = f"id {key}, language string, posterior double, text_language string, declared string, trigrams long, accepted boolean"
    return joined.mapInArrow(fuse(languages, corpus, confusion, certain), schema)


def page_evidence(pages, page_id="page_id", url="url", html="html"):
    """(id, text, declared, address) of web pages: the markup language and the text between tags."""
    bare = F.regexp_replace(F.col(html), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    said = F.lower(F.regexp_extract(F.col(html), r"""(?i)<html[^>]*\blang\s*=\s*["']?([a-z]{2,3})""", 1))
    return pages.select(
        F.col(page_id).alias("id"), bare.alias("text"), F.when(said != "", said).alias("declared"), F.col(url).alias("address")
    )
