"""The lookup tables a run works with."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lutrin.operators.aggregates import split_factor
from lutrin.operators.gates import contract_gates, run_gates
from lutrin.operators.lookups import broadcast_if_small, lookup
from lutrin.schemas import conform
from lutrin.sources.delimited import load_lookup


@dataclass(frozen=True)
class Lookups:
    programmes: DataFrame
    programmes_laval: DataFrame
    disciplines: DataFrame
    unites: DataFrame
    synonymes: DataFrame
    cycles: DataFrame
    statuts: DataFrame


def build_disciplines(disciplines, sectors):
    """Disciplines with the sector of their library and each librarian's share."""
    placed = lookup(disciplines, sectors, {"bibliotheque": "bibliotheque"}, "secteur")
    return conform(split_factor(placed), "disciplines")


def with_missing_factors(disciplines):
    """Fill only the shares that are missing, over all rows of the discipline."""
    filled = split_factor(disciplines.withColumnRenamed("facteur", "_kept"))
    return conform(
        filled.withColumn("facteur", F.coalesce("_kept", "facteur")), "disciplines"
    )


def load_lookups(spark, files, reports=None):
    """Read all lookups; `files` maps table names to paths. Small ones get a broadcast hint.

    A lookup with a repeated key or an overlong text stops here, before anything is loaded.
    """
    tables = {name: load_lookup(spark, name, path) for name, path in files.items()}
    run_gates([gate for name, rows in tables.items() for gate in contract_gates(rows, name)], reports)

    def read(name):
        return broadcast_if_small(tables[name])

    return Lookups(
        programmes=read("programmes"),
        programmes_laval=read("programmes_laval"),
        disciplines=broadcast_if_small(build_disciplines(read("disciplines"), read("secteurs"))),
        unites=read("unites"),
        synonymes=read("_synonymes"),
        cycles=read("_verif_cycles"),
        statuts=read("_verif_statuts_reservations"),
    )
