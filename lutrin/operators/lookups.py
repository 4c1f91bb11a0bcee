"""Lookups: synonyms, prioritised chains, single-value tables.

A lookup is broadcast by hint only after its rows were counted (`broadcast_if_small`,
when the lookup files are loaded). Any other is broadcast when the planner finds it
under `spark.sql.autoBroadcastJoinThreshold`; else it is sorted and merged, with adaptive
splitting of hot values.
"""

from pyspark.sql import functions as F


# Rows of at most five columns of 255 characters: some 60 MB at the very most.
BROADCAST_ROWS = 50_000


def broadcast_if_small(table, rows=BROADCAST_ROWS):
    """The table with a broadcast hint if it has at most `rows` rows, which one small job checks.

    The hint stays with what is derived from the table by filters and grouping.
    """
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


def one_per_key(lookup, keys, value):
    """A lookup with one row per key. Of several values the smallest is kept."""
    return lookup.groupBy(*keys).agg(F.min(value).alias(value))


def synonyms_of(synonyms, domain):
    return one_per_key(
        synonyms.filter(F.col("domaine") == domain), ["rejeter"], "accepter"
    )


def normalize(df, columns, synonyms, domain):
    """Replace rejected names by accepted ones in each column; other names stay."""
    names = synonyms_of(synonyms, domain)
    joined = df
    accepted = {}
    for i, column in enumerate(columns):
        renamed = names.select(
            F.col("rejeter").alias(f"_rejected{i}"), F.col("accepter").alias(f"_accepted{i}")
        )
        joined = joined.join(renamed, F.col(column) == F.col(f"_rejected{i}"), "left")
        accepted[column] = F.coalesce(f"_accepted{i}", column).alias(column)
    return joined.select(*[accepted.get(c, F.col(c)) for c in df.columns])


def lookup(df, table, on, value, into=None):
    """Left join of one value. `on` maps a column of `df` (or an expression) to one of `table`."""
    into = into or value
    pairs = list(on.items()) if isinstance(on, dict) else list(on)
    keys = [theirs for _, theirs in pairs]
    single = one_per_key(table, keys, value).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(value).alias("_value")
    )
    match = None
    for i, (ours, _) in enumerate(pairs):
        left = F.col(ours) if isinstance(ours, str) else ours
        term = left == F.col(f"_k{i}")
        match = term if match is None else match & term
    kept = [c for c in df.columns if c != into]
    return df.join(single, match, "left").select(*kept, F.col("_value").alias(into))


def lookup_chain(df, steps, into):
    """The first value found along `steps`, a list of (table, on, value).

    Each step is a left join on a lookup with one row per key, so rows are never
    multiplied; a step only counts where the earlier ones found nothing.
    """
    found = []
    for i, (table, on, value) in enumerate(steps):
        column = f"_step{i}"
        df = lookup(df, table, on, value, column)
        found.append(column)
    kept = [c for c in df.columns if c not in found and c != into]
    return df.select(*kept, F.coalesce(*found).alias(into))
