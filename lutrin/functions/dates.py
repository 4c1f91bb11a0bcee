"""Terms, loan dates, request windows and days in file names."""

from pyspark.sql import functions as F

ISO_START = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}"
ISO_WHOLE = ISO_START + "$"
DAY_FIRST = r"^(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}):(\d{1,2}):(\d{1,2})$"


def day_of(instant):
    """The date of an instant. (`date_trunc` would give an instant again.)"""
    return instant.cast("date")


def term_start(day):
    """First day of the term of a date: 1 September, 1 May or 1 January."""
    month = F.month(day)
    first = F.when(month >= 9, 9).when(month >= 5, 5).otherwise(1)
    return F.make_date(F.year(day), first, F.lit(1))


def normalize_date(text):
    """Loan dates as `yyyy-MM-dd HH:mm:ss` text.

    Text that starts that way is kept whole, `d/M/yyyy H:m:s` is converted, the
    rest is NULL. The conversion goes through a zone-less timestamp, so that no
    session time zone can move an hour.
    """
    iso = F.regexp_replace(text, DAY_FIRST, r"$3-$2-$1 $4:$5:$6")
    converted = iso.try_cast("timestamp_ntz").cast("string")
    return F.when(text.rlike(ISO_START), text).when(text.rlike(DAY_FIRST), converted)


def parse_instant(text):
    """Instant from the first 19 characters; what follows is ignored."""
    return F.substring(text, 1, 19).try_cast("timestamp_ntz")


def is_iso_instant(text):
    return text.rlike(ISO_WHOLE)


def date_chunks(bounds, days, start="start", end="end"):
    """Rows (debut, fin): windows of `days` days from `start` to `end`, both included.

    `bounds` holds one row per range; the windows cover it without overlap.
    """
    windows = F.sequence(F.col(start), F.col(end), F.make_dt_interval(F.lit(days)))
    return bounds.select(
        "*",
        F.explode(F.when(F.col(start) <= F.col(end), windows)).alias("debut"),
    ).withColumn("fin", F.least(F.date_add("debut", days - 1), F.col(end)))


def day_in_name(name):
    """The day before the first eight digits of a file name; NULL without such digits."""
    digits = F.regexp_extract(name, r"(\d{8})", 1)
    iso = F.regexp_replace(digits, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return F.date_sub(iso.try_cast("date"), 1)
