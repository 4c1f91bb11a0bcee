"""From raw documents to packed sequences: five stages, each written and read by the next.

A stage takes (spark, documents, folder of the tables). What it drops is decided by content,
so that null and repeated identifiers are safe, and removed by an anti join whose small side
is broadcast only after its rows were counted.
"""

import public_tokenizers
from pyspark.sql import functions as F

from lutrin.llm.common import Scratch
from lutrin.llm.decontamination import decontaminate
from lutrin.llm.language import identify
from lutrin.llm.near_duplicates import near_duplicates
from lutrin.llm.packing import pack
from lutrin.llm.secrets import redact

TOKENIZER = "byte_bpe_50k.json"
#: Rows of fixed width up to which the dropped keys are broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 100_000


def text_key():
    return F.md5(F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8"))


def without(docs, dropped, keys):
    """`docs` without the rows that match one of `dropped`, null-safe; `keys`: name of a column of `dropped` -> column of `docs`.

    Rows are carried in one struct, so that no name of theirs can clash.
    """
    if dropped.count() <= BROADCAST_ROWS:
        dropped = F.broadcast(dropped)
    names = list(keys)
    packed = docs.select(F.struct("*").alias("row"), *(keys[n].alias(f"key{i}") for i, n in enumerate(names)))
    dropped = dropped.select(*(F.col(n).alias(f"drop{i}") for i, n in enumerate(names)))
    same = None
    for i in range(len(names)):
        term = F.col(f"key{i}").eqNullSafe(F.col(f"drop{i}"))
        same = term if same is None else same & term
    return packed.join(dropped, same, "left_anti").select("row.*")


def language(spark, docs, sf_dir):
    """Drop documents in no known language, or without letters.

    What is dropped is told by text, declared language and source, null ones included, so
    repeated rows share their fate. A null or empty text has no letters. All columns of other
    names are kept as they are, whatever they are called; an empty table stays empty.
    """
    keyed = docs.select(F.struct(text_key().alias("k"), F.col("lang").alias("l"), F.col("source").alias("s")).alias("key"), "doc_id", "text", "lang", "source")
    found = identify(keyed, "key", spread=["doc_id"])
    rejected = found.where("NOT accepted").select("id.k", "id.l", "id.s").distinct()
    rejected = Scratch(spark, "pipeline").save(rejected, "rejected")
    return without(docs, rejected, {"k": text_key(), "l": F.col("lang"), "s": F.col("source")})


def near_dedup(spark, docs, sf_dir):
    """Keep the document with the smallest id of each group of near copies (five words, 0.8).

    Of rows that repeat an identifier and its text one stays; rows that share an identifier
    alone are told by their text. Rows with a null identifier, a null text or an empty one are
    no copies and stay. All other columns are kept as they are; an empty table stays empty.
    """
    scratch = Scratch(spark, "pipeline")
    found = near_duplicates(docs, words=5, percent=80)
    dropped = found.where("NOT kept").select("doc_id", F.lower(F.hex("text_md5")).alias("k")).distinct()
    kept = without(docs, scratch.save(dropped, "dropped"), {"doc_id": F.col("doc_id"), "k": text_key()})
    repeated = kept.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    repeated = scratch.save(repeated, "repeated")
    if repeated.take(1):  # rows that are repeated as a whole
        once = kept.join(repeated, "doc_id", "left_semi").select(F.struct("*").alias("row"), text_key().alias("key"), F.col("doc_id").alias("id"))
        once = once.dropDuplicates(["id", "key"]).select("row.*")
        kept = without(kept, repeated, {"doc_id": F.col("doc_id")}).unionByName(once)
    return kept


def decontamination(spark, docs, sf_dir):
    """Drop documents that hold ten words in a row of a benchmark item.

    Documents are told by their text, so equal ones go together; null and empty texts hold
    nothing and stay. All other columns are kept as they are; an empty table stays empty.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate(docs.select(text_key().alias("key"), "text"), items, doc_id="key")
    dropped = found.where(F.size("hit_words") > 0).select(F.col("doc_id").alias("k")).distinct()
    dropped = Scratch(spark, "pipeline").save(dropped, "contaminated")
    return without(docs, dropped, {"k": text_key()})


def secret_scan(spark, docs, sf_dir):
    """Replace secrets in the texts; no document goes.

    n_chars follows the text; null texts stay null. All other columns are kept as they are;
    an empty table stays empty.
    """
    return redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark, docs, sf_dir):
    """Pack what is left into sequences of at most 2048 tokens; a row for each piece, null texts as empty ones."""
    return pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: Trained models, sketches and token ids are not expressible; tests hold a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over `documents`, each written as Parquet and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
