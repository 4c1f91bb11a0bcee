"""Registered queries and their SQL."""

from pyspark.sql import functions as F

from lutrin.functions.privacy import Salts, pseudonymize

QUERIES = {}
SQL = {}

# Salts of the checks. Real ones come from the session.
SALTS = Salts("p-", "-s")


def check(sql=None, name=None):
    """Register a function (spark, table reader) -> DataFrame, under its own name or `name`."""

    def add(build):
        known = name or build.__name__

        def query(spark, sf_dir):
            return build(spark, lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[known] = query
        if sql:
            SQL[known] = sql
        return build

    return add


def pseudonym_sql(expression):
    return f"'\\x' || sha256('{SALTS.prefix}' || {expression} || '{SALTS.suffix}')"


def pseudonym(expression):
    return pseudonymize(F.expr(expression), SALTS)


def values(spark, rows, columns):
    """A small lookup, written as SQL VALUES so that the planner knows its size."""

    def literal(value):
        if value is None:
            return "NULL"
        if isinstance(value, bool):
            return str(value).lower()
        return "'" + value.replace("'", "\\'") + "'"

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")


def values_sql(rows):
    def literal(value):
        if value is None:
            return "NULL"
        if isinstance(value, bool):
            return str(value).lower()
        return "'" + value.replace("'", "''") + "'"

    return "VALUES " + ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)


def text_date(expression):
    return F.expr(expression).cast("date").cast("string")


def term_sql(day):
    return (
        f"make_date(year({day}), CASE WHEN month({day}) >= 9 THEN 9"
        f" WHEN month({day}) >= 5 THEN 5 ELSE 1 END, 1)"
    )
