"""Reference-desk transactions: landed answers to one delimited extract."""

from lutrin.operators.gates import run_gates
from lutrin.sources.delimited import write_delimited
from lutrin.sources.json_pages import read_transactions


def export_desk(spark, landed, target, reports=None):
    """Write all transactions as text, one row each; unexpected labels stop it first."""
    rows, labels = read_transactions(spark, landed)
    checks = run_gates([labels], reports)
    write_delimited(rows, target)
    return checks
