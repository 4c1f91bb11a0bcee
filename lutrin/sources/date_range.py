"""Scans of database tables or landed copies, limited to a range of days."""

from datetime import datetime, timedelta

from lutrin.operators.filters import between_days


def day_predicates(column, first, last, slices=1):
    """Half-open conditions, `slices` per day, that cover `first` to `last` without overlap.

    Each becomes one task. More slices split a day that holds most of the rows.
    """
    start = datetime.fromisoformat(str(first))
    days = (datetime.fromisoformat(str(last)) - start).days + 1
    step = timedelta(days=1) / slices
    edges = [start + step * n for n in range(days * slices + 1)]
    return [
        f"{column} >= '{a.isoformat(' ')}' AND {column} < '{b.isoformat(' ')}'"
        for a, b in zip(edges, edges[1:])
    ]


def read_jdbc_days(spark, url, table, column, first, last, properties=None, slices=1):
    """Rows of a database table for some days, read in parallel slices of days."""
    return spark.read.jdbc(
        url,
        table,
        predicates=day_predicates(column, first, last, slices),
        properties=properties or {},
    )


def read_days(spark, path, column, first, last):
    """The same from a landed Parquet copy; the range is pushed down to the scan."""
    return between_days(spark.read.parquet(path), column, first, last)
