"""Text repairs."""

from pyspark.sql import functions as F

# The characters counted as blanks around a field, Unicode ones included.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text):
    """Remove blanks of any kind at both ends (`trim` alone only knows the plain space)."""
    return F.btrim(text, F.lit(BLANKS))


def blank_to_null(text):
    return F.nullif(text, F.lit(""))


def null_to_blank(text):
    return F.coalesce(text, F.lit(""))


def is_blank(text):
    return text.isNull() | (text == "")


def field(line, start, end):
    """Characters `start` to `end` of a line, 0-based, end excluded, blanks removed."""
    return strip(F.substring(line, start + 1, end - start))


def report_line(columns, sep="\t"):
    """One line of delimited text; a missing value reads `None`."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in columns])
