"""Circulation loans."""

from pyspark.sql import functions as F

from lutrin import values as V
from lutrin.functions.dates import day_of, parse_instant, term_start
from lutrin.functions.privacy import pseudonymize
from lutrin.operators import gates as G
from lutrin.operators.filters import drop_blank
from lutrin.operators.links import hot_keys, link, unique_persons
from lutrin.operators.lookups import normalize
from lutrin.operators.merge import latest_by
from lutrin.schemas import conform

KEY = ["cb_document", "cb_usager", "dateheure"]


# The key with the borrower's pseudonym as 16 bytes.
DIGEST_KEY = ["cb_document", "dateheure", "_digest"]


def _digest(pseudonym):
    return F.unhex(F.md5(pseudonym)).alias("_digest")


def collapse_outside(loans, home):
    """Both libraries of a document from another institution become the outside library.

    `home` is the text that names the own institution. A missing institution
    changes nothing, a blank one counts as outside.
    """
    outside = ~F.col("institution_doc").contains(home)

    def collapsed(column):
        return F.when(outside, V.OUTSIDE_LIBRARY).otherwise(F.col(column))

    return loans.withColumn("bibliotheque_pret", collapsed("bibliotheque_pret")).withColumn(
        "bibliotheque_document", collapsed("bibliotheque_document")
    )


def dated_loans(loans, synonyms, home):
    """Loans with their institutions named and outside libraries collapsed."""
    named = normalize(
        loans, ["bibliotheque_pret", "institution_doc", "institution_usager"], synonyms, V.LOANS
    )
    return collapse_outside(named, home)


def loan_gates(staging, synonyms, home):
    dated = drop_blank(staging, "date")
    loans = dated_loans(dated, synonyms, home)
    libraries = ["bibliotheque_pret", "bibliotheque_document"]
    return [
        G.Gate("loans: unknown libraries", G.unmapped_names(loans, libraries, synonyms, V.LOANS)),
        G.Gate(
            "loans: impossible dates",
            dated.filter(parse_instant(F.col("date")).isNull()),
            seen=G.seen_in(staging, "loans: impossible dates"),
        ),
        G.Gate("loans: odd dates", G.malformed_dates(dated), G.WARN, G.seen_in(staging, "loans: odd dates")),
    ]


def loan_source(staging, persons, synonyms, home, salts, current):
    """Loans of known persons that `current` lacks in the shape of the table, one per key.

    Of equal loans the first by content stays. Rows are ranked and then met with the current
    loans by one shuffle, on a digest of the pseudonym, which only becomes a column of those
    that stay; hot borrowers are counted on the bare staging column.
    """

    def encode(barcode):
        return pseudonymize(barcode, salts)

    dated = drop_blank(staging, "date")
    named = normalize(
        dated_loans(dated, synonyms, home),
        ["bibliotheque_pret", "bibliotheque_document"],
        synonyms,
        V.LOANS,
    ).withColumn("dateheure", parse_instant(F.col("date")))
    # rows are sorted and shuffled from here on: no more columns than the table takes
    named = named.select(*KEY, *OWN_COLUMNS, _digest(encode(F.col("cb_usager"))))
    single = latest_by(named, DIGEST_KEY, [F.asc_nulls_first(c) for c in OWN_COLUMNS])
    known_loans = current.select(*KEY, _digest(F.col("cb_usager"))).select(*DIGEST_KEY)
    new = single.join(known_loans, DIGEST_KEY, "left_anti").drop("_digest")
    known = dated.filter(F.col("cb_usager").isNotNull() & (F.col("cb_usager") != ""))
    linked = link(
        new,
        unique_persons(persons, "codebarres", salts),
        "cb_usager",
        "codebarres",
        {"usager": "usager", "courriel": "courriel", "discipline": "discipline", "codebarres": "_cb"},
        how="inner",
        encode=encode,
        hot=hot_keys(known.select("cb_usager"), "cb_usager"),
    )
    day = day_of(F.col("dateheure"))
    rows = linked.withColumn("cb_usager", F.col("_cb")).select(
        "*", day.alias("journee"), term_start(day).alias("session")
    )
    return conform(rows, "emprunts")


# What may differ between loans of equal key: the rest follows from borrower and time.
OWN_COLUMNS = (
    "cote",
    "bibliotheque_pret",
    "bibliotheque_document",
    "institution_doc",
    "institution_usager",
)


def build_loans(staging, persons, synonyms, current, home, salts):
    """Current loans plus the new ones; of equal loans in a batch the first by content stays."""
    source = loan_source(staging, persons, synonyms, home, salts, current)
    filled = current.withColumn("session", F.coalesce("session", term_start(F.col("journee"))))
    rows = conform(filled, "emprunts").unionByName(source)
    return G.Build(rows, loan_gates(staging, synonyms, home))
