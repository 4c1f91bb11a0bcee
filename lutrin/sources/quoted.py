"""Delimited text with line breaks in quotes, read by many tasks a file.

Whether a line starts inside quotes depends on all quotes before it in its file. Three steps
find that out without reading a file in one piece:

1. every split counts the quotes of its lines; that is one row a split;
2. a running sum over the splits of a file tells which of them start inside quotes;
3. every split is read again from its first true record start. A record that is cut by the
   border of two splits, or covers several, is put together from their pieces; only
   splits whose borders lie inside a record are read for that.

A quote inside quotes must be doubled, and one in a field without quotes is against the
format: it joins lines that are none, which a strict reader notices by their number of fields.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

QUOTE = '"'
#: Files up to this many have the rows of their splits broadcast: 40 bytes or so for each file, and for each 128 MB of a
#: larger one. Beyond, lines and splits are joined by a shuffle.
BROADCAST_FILES = 200_000

_SPLIT = ("fichier", "debut", "longueur")
_RECORDS = "fichier string, debut long, ligne long, premier boolean, vient boolean, va boolean, value string"


def split_lines(spark, path):
    """Lines of text files with their split and their order. Line ends stay as they are but for the last character."""
    block = F.col("_metadata")
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            block["file_path"].alias("fichier"),
            block["file_block_start"].alias("debut"),
            block["file_block_length"].alias("longueur"),
            F.monotonically_increasing_id().alias("ligne"),
            "value",
        )
    )


def quote_count(column):
    return F.length(column) - F.length(F.replace(column, F.lit(QUOTE), F.lit("")))


def open_splits(lines):
    """One row a split: whether it starts, and whether it ends, inside quotes."""
    quotes = F.sum(quote_count(F.col("value")).cast("long"))
    counts = lines.groupBy(*_SPLIT).agg(quotes.alias("guillemets"))
    until = Window.partitionBy("fichier").orderBy("debut").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("guillemets").over(until)
    return counts.select(
        *_SPLIT, ((total - F.col("guillemets")) % 2 == 1).alias("ouvert"), (total % 2 == 1).alias("reste")
    )


def _records(batches):
    """Records of lines in order, from splits one after the other; pieces of cut ones are marked.

    `vient`: the piece goes on from an earlier split; `va`: it goes on in a later one.
    """
    key, inside, held = None, 0, None  # held: (fichier, debut, ligne, premier, vient, lines) of the open record
    for batch in batches:
        out = {name: [] for name in ("fichier", "debut", "ligne", "premier", "vient", "va", "value")}

        def put(record, goes, out=out):
            *place, text = record
            text = "\n".join(text)
            for column, value in zip(out.values(), (*place, goes, text if goes else text.removesuffix("\r"))):
                column.append(value)

        quotes = pc.count_substring(batch.column("value"), QUOTE).to_numpy(zero_copy_only=False)
        odd = (quotes & 1).astype(bool)
        splits = list(zip(batch.column("fichier").to_pylist(), batch.column("debut").to_pylist()))
        value, ligne, opened = (batch.column(name).to_pylist() for name in ("value", "ligne", "ouvert"))
        first, at = [], 0
        while at < len(splits):  # runs of lines of one split
            first.append(at)
            end = at + 1
            while end < len(splits) and splits[end] == splits[at]:
                end += 1
            at = end
        for begin, end in zip(first, [*first[1:], len(splits)]):
            fresh = splits[begin] != key
            if fresh:
                if held:
                    put(held, True)
                key, held = splits[begin], None
                inside = int(opened[begin])
                if inside:
                    held = (*key, ligne[begin], False, True, [])
            before = (inside + np.concatenate([[0], np.cumsum(odd[begin:end])])) % 2
            after = before[1:]
            for k in range(begin, end):
                if held is None:
                    started = (*key, ligne[k], fresh and k == begin and key[1] == 0, False)
                    if not after[k - begin]:
                        put((*started, [value[k]]), False)
                    else:
                        held = (*started, [value[k]])
                else:
                    held[-1].append(value[k])
                    if not after[k - begin]:
                        put(held, False)
                        held = None
            inside = int(before[-1])
        yield _batch(out)
    if held:
        out = {name: [] for name in ("fichier", "debut", "ligne", "premier", "vient", "va", "value")}
        for column, item in zip(out.values(), (*held[:-1], True, "\n".join(held[-1]))):
            column.append(item)
        yield _batch(out)


def _batch(out):
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))


def _with_state(lines, splits, few):
    """Lines with the state of their split; a split that was not counted stops the job."""
    splits = splits.withColumn("_la", F.lit(True))
    joined = lines.join(F.broadcast(splits) if few else splits, list(_SPLIT), "left")
    problem = F.raise_error(F.concat(F.lit("the splits of a file changed while it was read: "), "fichier")).cast("boolean")
    joined = joined.withColumn("ouvert", F.when(F.col("_la"), F.col("ouvert")).otherwise(problem))
    if not few:
        joined = joined.repartition(*_SPLIT).sortWithinPartitions(*_SPLIT, "ligne")
    return joined


def quoted_records(spark, path, header=True, strict=True):
    """Records of delimited files as text: fichier, bloc and ligne (their order in a file), value.

    Line breaks in quotes belong to the record; the carriage return that ends a record does
    not. Records of white space alone are left out, as is the first one of each file if there
    is a `header`. A quote that is never closed stops the job when `strict`; otherwise the rest
    of the file is its last record. Files are UTF-8; a packed file is one split.
    """
    lines = split_lines(spark, path)
    few = len(lines.inputFiles()) <= BROADCAST_FILES
    splits = open_splits(lines)
    columns = ["fichier", "debut", "ligne", "ouvert", "value"]
    lines = split_lines(spark, path)
    records = _with_state(lines, splits.drop("reste"), few).select(*columns).mapInArrow(_records, _RECORDS)
    whole = records.where("NOT vient AND NOT va").drop("vient", "va")
    # pieces come from splits that start or end inside a record alone
    cut = _with_state(lines, splits, few).where("ouvert OR reste").select(*columns).mapInArrow(_records, _RECORDS)
    cut = cut.where("vient OR va")
    order = Window.partitionBy("fichier").orderBy("debut", "ligne")
    runs = cut.withColumn("_nr", F.sum(F.when(F.col("vient"), 0).otherwise(1)).over(order)).groupBy("fichier", "_nr")
    joined = runs.agg(
        F.sort_array(F.collect_list(F.struct("debut", "ligne", "premier", "value", "va"))).alias("p"),
    ).select(
        "fichier",
        F.col("p")[0]["debut"].alias("debut"),
        F.col("p")[0]["ligne"].alias("ligne"),
        F.col("p")[0]["premier"].alias("premier"),
        F.array_join(F.col("p")["value"], "\n").alias("value"),
        F.forall("p", lambda x: x["va"]).alias("_offen"),
    )
    if strict:
        problem = F.raise_error(F.concat(F.lit("a quote is never closed in "), "fichier")).cast("string")
        joined = joined.withColumn("value", F.when(F.col("_offen"), problem).otherwise(F.col("value")))
    rows = whole.unionByName(joined.drop("_offen"))
    if header:
        rows = rows.where("NOT premier")
    marked = F.when(F.col("debut") == 0, F.regexp_replace("value", "^﻿", "")).otherwise(F.col("value"))
    rows = rows.withColumn("value", marked).where(F.trim(F.col("value"), F.lit(" \t\r\n")) != "")
    return rows.select("fichier", F.col("debut").alias("bloc"), "ligne", "value")
