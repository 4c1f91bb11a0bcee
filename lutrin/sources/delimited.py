"""Delimited files: lookups, staging files, loans; and the delimited sinks."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lutrin import values as V
from lutrin.functions.dates import normalize_date
from lutrin.functions.text import blank_to_null
from lutrin.manifests import Files
from lutrin.schemas import TABLES, conform
from lutrin.sources.fixed_width import file_order
from lutrin.sources.quoted import quoted_records


def _typed(name, kind, strict):
    text = F.coalesce(F.col(name).cast("string"), F.lit(""))
    if isinstance(kind, T.StringType):
        return text.alias(name)
    value = text.try_cast(kind)
    if strict:
        problem = F.raise_error(
            F.concat(F.lit(f"{name}: not a {kind.simpleString()}: '"), text, F.lit("'"))
        )
        value = F.coalesce(value, problem.cast(kind))
    return value.alias(name)


def text_options(sep, strict):
    """How delimited text is read, from files or from a column."""
    return {"sep": sep, "quote": '"', "escape": '"', "mode": "FAILFAST" if strict else "PERMISSIVE"}


def parse_delimited(lines, columns, types=None, sep=";", strict=True, extra=()):
    """The same from the text column `value`, one row each, without header. `extra` columns come first, as they are."""
    types = types or {}
    schema = ", ".join(f"`{c}` string" for c in columns)
    options = text_options(sep, strict) | {"multiLine": "true"}  # line breaks in quotes stay as they are
    rows = lines.select(*extra, F.from_csv("value", schema, options).alias("_row")).select(*extra, "_row.*")
    return rows.select(*extra, *[_typed(c, types.get(c, T.StringType()), strict) for c in columns])


def read_delimited(
    spark, path, columns, types=None, sep=";", header=True, multiline=False, strict=True, order=None
):
    """Columns bound by position; the header is skipped, not read.

    Blank text stays blank. A blank or malformed number, date or instant, and a
    row with too few or too many fields, stop the job when `strict`; otherwise they
    become NULL, missing fields blank. Large files are split over tasks; a quoted
    line break then cuts a row and stops a strict read. `multiline` allows such
    breaks but makes every file one task. `order` names a column for the order of
    the rows in their file. `multiline="split"` allows the breaks and splits the files
    all the same (see `sources.quoted`).
    """
    types = types or {}
    if multiline == "split":
        records = quoted_records(spark, path, header, strict)
        extra = [F.struct("bloc", "ligne").alias(order)] if order else []
        if order:
            records = records.select(*extra, "value")
        return parse_delimited(records, columns, types, sep, strict, [order] if order else [])
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = (
        spark.read.schema(schema)
        .option("header", header)
        .option("enforceSchema", True)
        .option("multiLine", multiline)
        .options(**text_options(sep, strict))
        .csv(path)
    )
    extra = [file_order().alias(order)] if order else []
    return rows.select(*extra, *[_typed(c, types.get(c, T.StringType()), strict) for c in columns])


def read_table(spark, name, path, **options):
    """A landed file of one of the tables, with the column order and separator of the contract."""
    spec = TABLES[name]
    types = {f.name: f.dataType for f in spec.schema.fields}
    options.setdefault("sep", spec.sep)
    return read_delimited(spark, path, spec.loaded, types, **options)


def stamp_day(df, day=None):
    """Add the load day, yesterday when none is given."""
    value = F.lit(str(day)).cast("date") if day else F.date_sub(F.current_date(), 1)
    return df.withColumn("journee", value)


# Text columns whose blanks mean "missing", per table.
BLANK_MEANS_MISSING = {
    "programmes": ("nom",),
    "programmes_laval": ("nom",),
    "_tmp_evenements": ("presenter",),
}


def to_table_types(rows, name, strict=True):
    """Columns in the types of their table; see `read_delimited` for blanks."""
    kinds = {f.name: f.dataType for f in TABLES[name].schema.fields}
    return rows.select(*[_typed(c, kinds[c], strict) for c in rows.columns])


def blanks_to_missing(df, name):
    for column in BLANK_MEANS_MISSING.get(name, ()):
        df = df.withColumn(column, blank_to_null(F.col(column)))
    return df


def load_lookup(spark, name, path, **options):
    """A lookup table, as in its contract. These files are small, so line breaks are allowed."""
    options.setdefault("multiline", True)
    return conform(blanks_to_missing(read_table(spark, name, path, **options), name), name)


def load_staging(spark, name, path, day=None, **options):
    """A staging table; people tables get their load day."""
    if name == "_tmp_personnel":
        options["order"] = "id"
    rows = blanks_to_missing(read_table(spark, name, path, **options), name)
    return stamp_day(rows, day) if "journee" in TABLES[name].schema.names else rows


def normalize_loan_dates(rows):
    """Rename the loan date column and bring its dates to one form; other dates become NULL."""
    renamed = rows.withColumnRenamed(V.LOAN_DATE_HEADER, V.LOAN_DATE)
    return renamed.withColumn(V.LOAN_DATE, normalize_date(F.col(V.LOAN_DATE)))


def extract_loans(spark, path, multiline=False):
    """A loan export as it is delivered: named columns, order kept, dates normalised."""
    rows = (
        spark.read.option("sep", "\t")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(path)
    )
    return normalize_loan_dates(rows)


def read_loans(spark, path, multiline=False):
    """A loan export bound by position and made ready to load."""
    rows = read_table(spark, "_tmp_emprunts", path, multiline=multiline)
    return normalize_loan_dates(rows)


def write_delimited(df, path, sep=",", order=()):
    """Text with header, quotes doubled, missing values blank, all other text as it is. One file per task.

    The files are written to a hidden folder beside `path` and moved there when all tasks are
    done, so `path` never holds a part of an output: a write that fails leaves what was there,
    and `df` may be read from it. A driver that dies while the folders change places leaves no
    `path`, but the old files in a folder `_<name>.before-…` and the new ones beside it. With `order`
    the rows are sorted over all files, in the order of the file names.
    """
    files = Files(df.sparkSession)
    parent, _, name = path.rstrip("/").rpartition("/")
    run = uuid.uuid4().hex
    fresh, before = (f"{parent}/_{name}.{step}-{run}" if parent else f"_{name}.{step}-{run}" for step in ("writing", "before"))
    try:
        _write_text(df.sort(*order) if order else df, fresh, sep)
        replaced = files.exists(path)
        if replaced:
            files.move(path, before)
        try:
            files.move(fresh, path)
        except Exception:
            if replaced:
                files.move(before, path)
            raise
    except Exception:
        files.delete(fresh)
        raise
    if replaced:
        files.delete(before)


def _write_text(df, path, sep):
    (
        df.write.mode("errorifexists")
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
