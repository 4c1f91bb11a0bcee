"""Landed JSON answers: pages, wrapped arrays, nested children, label/answer lists."""

from functools import reduce
from operator import or_

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lutrin import values as V
from lutrin.operators.gates import Gate


def read_pages(spark, path, record, wrapper=None):
    """Records of all landed files, with the name of their file as `fichier`.

    A file is an array of records, or an object that holds that array under
    `wrapper`. `record` is the schema of one record; identifiers are best read as
    text, which takes numbers too. A file that does not parse stops the job.
    """
    record = T.StructType.fromDDL(record) if isinstance(record, str) else record
    fields = list(record.fields)
    if wrapper:
        fields.append(T.StructField(wrapper, T.ArrayType(record)))
    pages = (
        spark.read.schema(T.StructType(fields))
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(path)
        .select("*", F.col("_metadata.file_name").alias("fichier"), _folder(F.col("_metadata.file_path")).alias("dossier"))
    )
    return unwrap(pages, record, wrapper, ["fichier", "dossier"]) if wrapper else pages


def unwrap(pages, record, wrapper, keep=()):
    """One row per record of pages that hold an array under `wrapper`, or are a record themselves."""
    # An object without the array is no record either.
    is_record = reduce(or_, [F.col(f.name).isNotNull() for f in record.fields])
    bare = F.when(is_record, F.array(F.struct(*[F.col(f.name) for f in record.fields])))
    return pages.select(*keep, F.inline(F.coalesce(F.col(wrapper), bare)))


def _folder(path):
    """The folder of a file, without the scheme that listing and reading spell differently."""
    return F.regexp_replace(F.regexp_replace(path, r"/[^/]*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*:/+", "/")


def list_pages(spark, path):
    """Folder and name of all landed files, also of those without a record. No file is read."""
    files = spark.read.format("binaryFile").load(path).select("path")
    return files.select(_folder(F.col("path")).alias("dossier"), F.regexp_extract("path", r"[^/]*$", 0).alias("fichier"))


PAGE_PATTERN = r"(\d+)\D*$"


def count_pages(listing, rows, page_pattern=PAGE_PATTERN):
    """Rows of every landed page: dossier, page, nb; nb is 0 for a page without records."""
    found = rows.groupBy("dossier", "fichier").agg(F.count(F.lit(1)).alias("nb"))
    number = F.regexp_extract("fichier", page_pattern, 1).try_cast("bigint")
    return listing.join(found, ["dossier", "fichier"], "left").select(
        "dossier", number.alias("page"), F.coalesce("nb", F.lit(0)).alias("nb")
    )


SHORT, MISSING, REPEATED = "incomplète", "manquante", "répétée"


def incomplete_pages(counts, page_size):
    """Signs that pages of a folder were lost: (dossier, page, jusqua, nb, probleme).

    A page below the page size that is not the last one; numbers that are missing between 1
    and the last one, as ranges; a number that occurs more than once. Each folder is one
    delivery. Files without a number are only judged by their rows.
    """
    by_folder = Window.partitionBy("dossier")
    ordered = by_folder.orderBy("page")
    pages = counts.select(
        "*",
        F.max("page").over(by_folder).alias("_last"),
        F.coalesce(F.lag("page").over(ordered), F.lit(0)).alias("_before"),
    )
    numbered = F.col("page").isNotNull()
    short = (F.col("nb") < page_size) & ~F.coalesce(F.col("page") == F.col("_last"), F.col("_last").isNull())
    gap = numbered & (F.col("page") > F.col("_before") + 1)
    again = numbered & (F.col("page") == F.col("_before"))

    def problem(rows, name, first, last, nb):
        return rows.select(
            "dossier", first.alias("page"), last.alias("jusqua"), nb.cast("bigint").alias("nb"), F.lit(name).alias("probleme")
        )

    page = F.col("page")
    return (
        problem(pages.filter(short), SHORT, page, page, F.col("nb"))
        .union(problem(pages.filter(gap), MISSING, F.col("_before") + 1, page - 1, F.lit(None)))
        .union(problem(pages.filter(again), REPEATED, page, page, F.col("nb")))
    )


def short_pages(rows, page_size, page_pattern=PAGE_PATTERN):
    """Pages below the page size that are not the last one: signs of a lost page."""
    number = F.regexp_extract("fichier", page_pattern, 1).try_cast("bigint")
    counts = rows.groupBy(number.alias("page")).agg(F.count(F.lit(1)).alias("nb"))
    last = counts.agg(F.max("page").alias("page"))
    return counts.filter(F.col("nb") < page_size).join(last, "page", "left_anti")


def project(df, paths, names=None, keep=()):
    """Chosen fields as text, by dotted path; missing ones are blank."""
    names = names or {}
    return df.select(
        *keep,
        *[
            F.coalesce(F.col(p).cast("string"), F.lit("")).alias(names.get(p, p.split(".")[-1]))
            for p in paths
        ],
    )


def explode_children(df, parent, children, tag):
    """One row per child record, tagged with its parent's identifier as text."""
    return df.select(F.col(parent).cast("string").alias(tag), F.inline(children))


def pivot_fields(df, fields, label, answer, labels, keep=()):
    """A list of label/answer pairs as one column per label; the last answer of a label wins.

    Works inside each row, nothing is shuffled. A missing label reads blank.
    """

    def last_answer(wanted):
        pairs = F.filter(F.col(fields), lambda x: x[label] == wanted)
        answers = F.transform(pairs, lambda x: x[answer])
        return F.coalesce(F.try_element_at(answers, F.lit(-1)), F.lit(""))

    return df.select(*keep, *[last_answer(name).alias(name) for name in labels])


def unexpected_labels(df, fields, label, labels, keep=()):
    """Rows with labels that are not expected, and those labels."""
    seen = F.transform(F.col(fields), lambda x: x[label])
    extra = F.array_except(seen, F.array(*[F.lit(name) for name in labels]))
    return df.select(*keep, F.explode(extra).alias("champ"))


# ---- the three interfaces -----------------------------------------------------

BOOKING_RECORD = ", ".join(f"{f} string" for f in V.BOOKING_FIELDS)
EVENT_RECORD = (
    "id string, title string, start string, end string,"
    " owner struct<id: string, name: string>, presenter string"
)
REGISTRATION_RECORD = (
    "event_id string, registrants"
    " array<struct<booking_id: string, registration_type: string, email: string>>"
)
DESK_RECORD = (
    "transaction_id string, dataset_id string, created string, question string, details string,"
    " answer string, internal_note string, owner string, custom_fields"
    " array<struct<field_id: string, field_label: string, field_answer: string>>"
)


def read_bookings(spark, path, page_size=V.BOOKING_PAGE):
    """Landed booking pages as staging text, and the gate on lost pages."""
    pages = read_pages(spark, path, BOOKING_RECORD)
    counts = count_pages(list_pages(spark, path), pages)
    return project(pages, V.BOOKING_FIELDS), Gate(
        "bookings: lost pages", incomplete_pages(counts, page_size)
    )


def full_answers(rows, most):
    """Files with as many records as one answer may hold: the rest was cut off."""
    counts = rows.groupBy("dossier", "fichier").agg(F.count(F.lit(1)).alias("nb"))
    return counts.filter(F.col("nb") >= most)


def read_events(spark, path, most=V.EVENT_ANSWER):
    """Landed training events as staging text, and the gate on answers that were cut off."""
    events = read_pages(spark, path, EVENT_RECORD, wrapper="events")
    staged = project(events, V.EVENT_FIELDS, names={"end": "finish", "owner.name": "owner"})
    return staged, Gate("events: cut answers", full_answers(events, most))


# A number that is the whole name of a file, or follows the word `event`.
EVENT_IN_NAME = r"(?i)(?:^|event[-_]?)(\d+)\.[^.\d]+$"


def tag_event(pages, event_pattern=EVENT_IN_NAME):
    """Registrations with their event as `_event`: from the answer, else from the name of its file."""
    in_name = F.regexp_extract("fichier", event_pattern, 1)
    return pages.withColumn(
        "_event", F.coalesce(F.col("event_id"), F.when(in_name != "", in_name))
    )


def read_registrations(spark, path, event_pattern=EVENT_IN_NAME):
    """Landed registrations, one row per registrant, and the gate on files of no known event."""
    tagged = tag_event(read_pages(spark, path, REGISTRATION_RECORD), event_pattern)
    nobody = tagged.filter(F.col("_event").isNull()).select("dossier", "fichier").distinct()
    rows = explode_children(tagged, "_event", "registrants", "event_id")
    return project(rows, V.REGISTRATION_FIELDS), Gate("registrations: files without event", nobody)


def flatten_transactions(transactions):
    """Desk transactions with their four answers as columns."""
    plain = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in V.DESK_FIELDS]
    return pivot_fields(
        transactions, "custom_fields", "field_label", "field_answer", V.DESK_LABELS, keep=plain
    )


def read_transactions(spark, path):
    """Landed desk transactions, and the gate on unexpected labels."""
    rows = read_pages(spark, path, DESK_RECORD, wrapper="transactions")
    extra = unexpected_labels(
        rows, "custom_fields", "field_label", V.DESK_LABELS, keep=["transaction_id"]
    )
    return flatten_transactions(rows), Gate("desk: unexpected labels", extra)
