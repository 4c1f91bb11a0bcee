"""Quality gates: queries for violations, judged before anything is written.

A failing gate writes all its violations to the report folder, if one is given. What
leaves a run otherwise, in messages and logs, is only names, counts and paths.
"""

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lutrin.functions.dates import day_of, is_iso_instant, parse_instant
from lutrin.functions.people import cycle_of
from lutrin.functions.text import report_line
from lutrin.schemas import MAX_LENGTH
from lutrin.schemas import spec as spec_of

STOP = "stop"
WARN = "warn"
# Lines of a preview. The report of a gate is always whole.
PREVIEW = 20


@dataclass(frozen=True)
class Gate:
    """`seen` is what was counted while the rows were written: none means that nothing has to be looked up."""

    name: str
    violations: DataFrame
    severity: str = STOP
    seen: int | None = None


@dataclass(frozen=True)
class GateResult:
    name: str
    severity: str
    count: int
    # First lines, with personal data: for a person at a screen, neither logged nor part of a message.
    preview: str = field(default="", repr=False)
    report: str = ""


class GateFailure(Exception):
    def __init__(self, results):
        self.results = results
        failed = [r for r in results if r.severity == STOP and r.count]
        super().__init__(
            "; ".join(
                f"{r.name}: {r.count} violation(s)" + (f", report in {r.report}" if r.report else "")
                for r in failed
            )
        )


def report(violations, sep="\t"):
    """Delimited text lines of all violations, one row each, without header."""
    return violations.select(report_line(violations.columns, sep).alias("value"))


def write_report(violations, path, sep="\t"):
    """All violations as delimited text with a header, one file per task."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("None")).alias(c) for c in violations.columns]
    violations.select(*text).write.mode("overwrite").option("sep", sep).option("header", True).csv(path)


def preview(violations, rows=PREVIEW, sep="\t"):
    """Header and the first lines, for a message. The whole report is `report`."""
    lines = [r.value for r in report(violations, sep).take(rows)]
    return "\n".join([sep.join(violations.columns), *lines])


def report_name(gate):
    """A folder name made of the name of a gate."""
    return re.sub(r"[^a-z0-9]+", "-", gate.lower()).strip("-")


def check_gates(gates, reports=None):
    """Count all violations in one job and return a result per gate.

    Gates that were watched while their rows were written, and saw nothing, take no part in it;
    where none is left there is no job. With a folder for `reports` the whole report of each
    failing gate is written there.
    """
    open_ = [(i, g) for i, g in enumerate(gates) if g.seen is None or g.seen > 0]
    if not open_:
        return [GateResult(g.name, g.severity, 0) for g in gates]
    counts = reduce(
        DataFrame.unionAll,
        [
            g.violations.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("gate"), "n")
            for i, g in open_
        ],
    )
    found = {r.gate: r.n for r in counts.collect()}  # one row per gate

    def result(gate, count):
        if not count:
            return GateResult(gate.name, gate.severity, 0)
        path = f"{reports}/{report_name(gate.name)}" if reports else ""
        if path:
            write_report(gate.violations, path)
        return GateResult(gate.name, gate.severity, count, preview(gate.violations), path)

    return [result(g, found.get(i, 0)) for i, g in enumerate(gates)]


def run_gates(gates, reports=None):
    """Results of all gates; raises when a stopping one has violations."""
    results = check_gates(gates, reports)
    if any(r.severity == STOP and r.count for r in results):
        raise GateFailure(results)
    return results


@dataclass(frozen=True)
class Build:
    """Rows ready to be written, and the gates that must pass first."""

    rows: DataFrame
    gates: list = field(default_factory=list)

    def checked(self):
        run_gates(self.gates)
        return self.rows


# ---- violations ---------------------------------------------------------------


def unlisted(df, column, allowed, by=()):
    """Distinct values of a column that are not listed. NULL never counts.

    Values and list are made distinct first: equal ones are merged before the
    shuffle, so the anti join only sees a handful of rows, without any need to
    broadcast the list.
    """
    values = df.filter(F.col(column).isNotNull()).select(*by, column).distinct()
    listed = allowed.select(F.col(allowed.columns[0]).alias(column)).distinct()
    return values.join(listed, column, "left_anti").select(*by, column)


def unknown_cycles(students, cycles, by=()):
    """Whole rows (cycle, programme code, programme) whose first character is not listed."""
    rows = students.select(
        *by, "codeCycle", "codeProgramme", "programme", cycle_of(F.col("codeCycle")).alias("_c")
    )
    # Only one-character codes can match, so this list is bounded by the alphabet.
    listed = cycles.filter(F.length("cycle") <= 1).select(F.col("cycle").alias("_c")).distinct()
    known = rows.filter(F.col("_c").isNotNull())
    return known.join(F.broadcast(listed), "_c", "left_anti").drop("_c")


def unresolved(df, column, group):
    """Groups of rows that lack a value, with their number."""
    return df.filter(F.col(column).isNull()).groupBy(*group).agg(F.count(F.lit(1)).alias("nb"))


def unmatched(df, column, table, by=()):
    """Distinct values without a row in `table`; NULL counts as unmatched."""
    values = df.select(*by, column).distinct()
    return values.join(table.select(column).distinct(), column, "left_anti").select(*by, column)


def unmapped_names(df, columns, synonyms, domain):
    """Distinct names, over several columns, that are neither rejected nor accepted forms."""
    names = (
        df.select(F.explode(F.array(*columns)).alias("succursale"))
        .filter(F.col("succursale").isNotNull())
        .distinct()
    )
    pairs = synonyms.filter(F.col("domaine") == domain)
    known = pairs.select(F.explode(F.array("rejeter", "accepter")).alias("succursale")).distinct()
    return names.join(known, "succursale", "left_anti")


def malformed_dates(df, column="date"):
    return df.filter(~is_iso_instant(F.col(column)))


def broken_keys(df, keys):
    """Keys that are missing or occur more than once, with their number of rows."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("nb"))
        .filter((F.col("nb") > 1) | missing)
    )


def missing_values(df, columns):
    """Rows that lack a value of a key column."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def _overlong(lengths):
    checks = F.array(
        *[
            F.struct(
                F.lit(c).alias("colonne"),
                F.lit(n).alias("limite"),
                F.length(c).alias("longueur"),
                F.col(c).alias("valeur"),
            )
            for c, n in lengths.items()
        ]
    )
    return F.filter(checks, lambda x: x["longueur"] > x["limite"])


def any_overlong(lengths):
    return reduce(lambda a, b: a | b, [F.length(c) > n for c, n in lengths.items()])


def too_long(df, lengths):
    """One row per overlong value: column, its limit, its length, the value. One pass."""
    return df.filter(any_overlong(lengths)).select(F.inline(_overlong(lengths)))


def text_lengths(name, columns):
    """Limits of the text columns of a table that are among `columns`."""
    return {
        f.name: f.metadata[MAX_LENGTH]
        for f in spec_of(name).schema.fields
        if MAX_LENGTH in f.metadata and f.name in columns
    }


def other_day(moment="dateheure", day="journee"):
    """Whether a row lies in another day than its own moment; a missing day or moment does, too."""
    return ~F.coalesce(F.col(day) == day_of(F.col(moment)), F.lit(False))


def keyed_by_moment(name, columns):
    """Whether the key of a table holds a moment, of which its day is a part: then equal keys share a day."""
    key = spec_of(name).key
    return "dateheure" in key and "journee" not in key and {"dateheure", "journee"} <= set(columns)


def contract_gates(df, name, key=True):
    """Key and length gates of a table, for the columns that `df` has.

    A table that is kept by day and keyed by a moment must have each row in the day of its
    moment. So gates over some days also answer for the keys of all others.
    """
    spec = spec_of(name)
    gates = []
    if key and keyed_by_moment(name, df.columns):
        gate = f"{name}: day"
        gates.append(Gate(gate, df.filter(other_day()).select(*spec.key, "journee"), seen=seen_in(df, gate)))
    if key and spec.key and set(spec.key) <= set(df.columns):
        gates.append(Gate(f"{name}: key", broken_keys(df, spec.key)))
    lengths = text_lengths(name, df.columns)
    if lengths:
        gate = f"{name}: text length"
        gates.append(Gate(gate, too_long(df, lengths), seen=seen_in(df, gate)))
    return gates


# ---- gates of single rows, counted while the rows are written -------------------


def seen_in(df, gate):
    """What a gate saw while `df` was written, or None if it was not watched."""
    return getattr(df, "seen", {}).get(gate)


def row_conditions(name, columns):
    """Gates of a staged table that look at one row at a time: name -> condition of a violation."""
    found = {}
    lengths = text_lengths(name, columns)
    if lengths:
        found[f"{name}: text length"] = any_overlong(lengths)
    if keyed_by_moment(name, columns):
        found[f"{name}: day"] = other_day()
    if name == "_tmp_emprunts" and "date" in columns:
        dated = F.col("date").isNotNull() & (F.col("date") != "")
        found["loans: impossible dates"] = dated & parse_instant(F.col("date")).isNull()
        found["loans: odd dates"] = dated & ~is_iso_instant(F.col("date"))
    return found


class Watch:
    """Counts violating rows of gates as a by-product of the job that writes the rows.

    A task that is run again may count twice, so a count above zero only says that the gate
    has to be looked at; zero is certain.
    """

    def __init__(self, rows, conditions):
        self.names = list(conditions)
        self.observation = Observation() if conditions else None
        self.rows = rows
        if conditions:
            counted = [F.count_if(F.coalesce(c, F.lit(False))).alias(f"g{i}") for i, c in enumerate(conditions.values())]
            self.rows = rows.observe(self.observation, *counted)

    def seen(self):
        """Gate -> violating rows, once the rows are written."""
        if not self.names:
            return {}
        found = self.observation.get
        return {gate: found[f"g{i}"] for i, gate in enumerate(self.names)}
