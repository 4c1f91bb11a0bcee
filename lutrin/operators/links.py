"""Links between facts and the person table, both of unbounded size.

A single identifier may hold a large share of the facts: a shared account, or the
blank that stands for no identifier at all. Neither may end up in one task:

* a blank identifier never links, and its rows are spread over all tasks;
* identifiers above a share of the rows are matched against a broadcast copy of
  just their own person rows. There are about 1/share of them at most, whatever the
  size of the data, and the person side has one row per identifier, so that copy is
  bounded. Their rows are spread as well;
* all other rows take the ordinary equi-join.
"""

from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from lutrin.functions.privacy import blank_pseudonym
from lutrin.operators.merge import latest_by

# A key with more than this share of the rows is hot.
HOT_SHARE = 0.001
# Starts the join keys of rows that match nobody; no identifier starts like this.
SPREAD = "\u0000"
# Keys a sketch tracks: enough to notice any key of half that share for certain.
TRACKED = 8000
# Sketches of single tasks are first merged into this many, then into one.
SKETCH_GROUPS = 256


def hot_keys(df, column, share=HOT_SHARE):
    """Values of `column` that hold more than `share` of the rows: about 1/share values at most.

    Found with frequent-item sketches, in one pass that shuffles a sketch of bounded
    size per task and no keys. The list only decides which way a row takes to
    meet its person: a key just around the share may be judged either way, and the
    joined rows are the same.
    """
    sketches = df.groupBy((F.spark_partition_id() % SKETCH_GROUPS).alias("_group")).agg(
        F.expr(f"approx_top_k_accumulate(`{column}`, {TRACKED})").alias("_sketch"),
        F.count(F.lit(1)).alias("_rows"),
    )
    # Grouped by a constant: a global aggregate cannot serialise the empty state that
    # a task without rows would leave.
    merged = sketches.groupBy(F.lit(0).alias("_all")).agg(
        F.expr(f"approx_top_k_combine(_sketch, {TRACKED})").alias("_sketch"),
        F.sum("_rows").alias("_total"),
    )
    most = max(1, round(1 / share))
    top = F.expr(f"approx_top_k_estimate(_sketch, {min(most, TRACKED)})")
    return (
        merged.select("_total", F.inline(top))
        .filter(F.col("count") > F.col("_total") * F.lit(float(share)))
        .select(F.col("item").alias(column))
    )


def unique_persons(persons, key, salts=None):
    """One row per link key: the latest day, then the smallest pseudonym.

    Rows whose key is missing or blank are left out; the partial ranking before
    the shuffle keeps a key shared by many persons small.
    """
    known = persons.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    if salts is not None:
        known = known.filter(F.col(key) != blank_pseudonym(salts))
    return latest_by(known, [key], [F.desc("journee"), F.asc("usager")])


def link(df, persons, on, person_key, columns, how="left", encode=None, hot=None):
    """Join facts to persons (one row per `person_key`) and add person columns.

    `on` is the raw identifier column of the facts and `encode` turns it into the
    person key. `columns` maps person columns to the names they get; existing
    columns of that name are replaced. Unmatched rows get NULLs (`left`) or are
    dropped (`inner`).

    `hot` lists the raw identifiers to keep out of the shuffle. By default they
    are counted in `df`; a caller whose `df` is costly passes those counted in the
    tables it was made from.
    """
    names = list(columns.items())
    usable = F.col(on).isNotNull() & (F.col(on).cast("string") != "")
    if hot is None:
        hot = hot_keys(df.filter(usable).select(on), on)
    if how == "inner":
        df = df.filter(usable)
    return _attach(df, persons, on, usable, person_key, names, how, encode, hot)


def _attach(df, persons, on, usable, person_key, names, how, encode, hot):
    """Join on the encoded `on` column where `usable`; `hot` values stay out of the shuffle."""
    encode = encode or (lambda c: c.cast("string"))
    side = persons.select(
        F.col(person_key).alias("_key"),
        F.lit(True).alias("_found"),
        *[F.col(theirs).alias(f"_p{i}") for i, (theirs, _) in enumerate(names)],
    )
    hot = hot.select(F.col(hot.columns[0]).alias("_hot")).withColumn("_key", encode(F.col("_hot")))
    hot_found = side.join(F.broadcast(hot.select("_key")), "_key", "left_semi")
    hot_rows = hot.join(F.broadcast(hot_found), "_key", "left").select(
        "_hot",
        F.col("_found").alias("_hot_found"),
        *[F.col(f"_p{i}").alias(f"_h{i}") for i in range(len(names))],
    )
    with_hot = df.join(F.broadcast(hot_rows), usable & (F.col(on) == F.col("_hot")), "left")

    # Rows of hot identifiers, matched or known to have no person, and rows without
    # an identifier get a join key that no person has, different from task to task
    # and from content to content.
    settled = F.col("_hot").isNotNull() | ~usable
    spread = F.concat(
        F.lit(SPREAD), F.spark_partition_id().cast("string"), F.lit("-"), F.xxhash64(*df.columns)
    )
    spread_out = with_hot.withColumn(
        "_key", F.when(settled, spread).otherwise(encode(F.col(on)))
    )
    joined = spread_out.join(side, "_key", "left")
    if how == "inner":
        joined = joined.filter(F.col("_found") | F.col("_hot_found"))
    added = {ours: F.coalesce(f"_h{i}", f"_p{i}") for i, (_, ours) in enumerate(names)}
    kept = [F.col(c) for c in df.columns if c not in added]
    return joined.select(*kept, *[value.alias(ours) for ours, value in added.items()])


def enrich_missing(df, persons, on, person_key, columns, missing, encode=None, hot=None):
    """Refresh rows that lack any of `missing` from the persons now known.

    On a match all `columns` are replaced, also by NULL; without one the row stays
    as it is. Complete rows carry no join key, so they match nobody; splitting them
    off instead would compute `df` once more.
    """
    lacking = reduce(or_, [F.col(c).isNull() for c in missing])
    usable = lacking & F.col(on).isNotNull() & (F.col(on).cast("string") != "")
    if hot is None:
        hot = hot_keys(df.filter(usable).select(on), on)
    names = [(theirs, f"_new_{ours}") for theirs, ours in columns.items()]
    known = persons.withColumn("_here", F.lit(True))
    names.append(("_here", "_known"))
    linked = _attach(df, known, on, usable, person_key, names, "left", encode, hot)
    replaced = set(columns.values())
    return linked.select(
        *[
            (
                F.when(F.col("_known"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
                if c in replaced
                else F.col(c)
            )
            for c in df.columns
        ]
    )
