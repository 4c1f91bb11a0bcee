"""Fixed-width people files."""

from pyspark.sql import functions as F

from lutrin import values as V
from lutrin.functions.text import field


def read_lines(spark, path, encoding):
    """Lines of text in any encoding; `.gz` files are unpacked by their extension.

    The CSV reader is used because the text reader ignores `encoding`. The
    separator is a control character that the files do not hold; a line that holds
    it stops the job rather than lose its end.
    """
    return (
        spark.read.schema("value string")
        .option("sep", "\u0001")
        .option("quote", "")
        .option("mode", "FAILFAST")
        .option("encoding", encoding)
        .csv(path)
    )


def slice_fields(lines, layout):
    """Fields of `layout` (name -> start, end) cut out of the `value` column."""
    cut = [field(F.col("value"), start, end).alias(name) for name, (start, end) in layout.items()]
    others = [F.col(c) for c in lines.columns if c != "value"]
    return lines.select(*others, *cut)


def parse_people(lines, layout, required):
    """Fields of all lines whose `required` field is not blank."""
    return slice_fields(lines, layout).filter(F.col(required) != "")


def file_order():
    """Orders the rows of one file: offset of their block, then their number in it.

    To be taken on the scan, before any shuffle. It repeats when a task is run again.
    """
    return F.struct(
        F.col("_metadata.file_block_start").alias("bloc"),
        F.monotonically_increasing_id().alias("ligne"),
    )


def read_fixed_width(spark, path, layout, required, encoding=V.PEOPLE_ENCODING, partitions=None):
    """Rows of fixed-width files whose `required` field is not blank.

    Each row carries the name of its file (`fichier`) and its order in it (`id`).
    A `.gz` file is one task to read; `partitions` spreads its rows afterwards.
    """
    lines = read_lines(spark, path, encoding).select(
        "value", F.col("_metadata.file_name").alias("fichier"), file_order().alias("id")
    )
    rows = parse_people(lines, layout, required)
    return rows.repartition(partitions) if partitions else rows


def read_students(spark, path, **options):
    return read_fixed_width(spark, path, V.STUDENT_LAYOUT, "login", **options)


def read_staff(spark, path, **options):
    return read_fixed_width(spark, path, V.STAFF_LAYOUT, "Login", **options)
