"""Row filters with the three-valued logic of SQL deletes."""

from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from lutrin import values as V


def drop_where(df, condition, *columns):
    """Remove the rows for which `condition` is true, keep those where it is NULL.

    `columns` are the columns the condition reads. They let the filter reach the
    scan (`NOT condition OR column IS NULL`), which a COALESCE around the
    condition would prevent.
    """
    if not columns:
        return df.filter(~F.coalesce(condition, F.lit(False)))
    missing = reduce(or_, [F.col(c).isNull() for c in columns])
    return df.filter(~condition | missing)


def drop_listed(df, column, names):
    return drop_where(df, F.col(column).isin(*names), column)


def drop_containing(df, column, part):
    return drop_where(df, F.col(column).contains(part), column)


def drop_containing_any_case(df, column, part):
    return drop_where(df, F.col(column).ilike(f"%{part}%"), column)


def drop_retired(df, column="Statut"):
    return drop_listed(df, column, V.RETIRED_STATUSES)


def drop_blank(df, column):
    return df.filter(F.col(column).isNotNull() & (F.col(column) != ""))


def drop_flagged(df, column, flags, name="nom", keep="conserver"):
    """Remove rows whose value is listed as not kept; unlisted and NULL values stay."""
    dropped = flags.filter(~F.col(keep)).select(F.col(name).alias(column))
    return df.join(dropped, column, "left_anti").select(*df.columns)


def without(df, others, keys):
    """Rows whose keys do not occur in `others`; a NULL key never occurs.

    Keys are made distinct before the shuffle: the other side of an anti join is
    not split when one key fills it.
    """
    listed = others.select(*keys).distinct()
    return df.join(listed, list(keys), "left_anti").select(*df.columns)


def between_days(df, column, first, last):
    """Rows whose instant falls on `first` to `last`, both included.

    Written as a half-open range on the bare column, so that it is pushed to the
    scan and prunes row groups.
    """
    start = F.lit(str(first)).cast("date").cast("timestamp_ntz")
    end = F.date_add(F.lit(str(last)).cast("date"), 1).cast("timestamp_ntz")
    return df.filter((F.col(column) >= start) & (F.col(column) < end))
