"""Pseudonyms of personal identifiers."""

from dataclasses import dataclass

from pyspark.sql import functions as F

# Spark leaves the values of settings named `secret` out of its logs.
PREFIX_CONF = "spark.lutrin.secret.prefix"
SUFFIX_CONF = "spark.lutrin.secret.suffix"


@dataclass(frozen=True)
class Salts:
    """Secret text put before and after an identifier. Never written in code."""

    prefix: str
    suffix: str

    @staticmethod
    def from_session(spark):
        return Salts(spark.conf.get(PREFIX_CONF), spark.conf.get(SUFFIX_CONF))

    def __repr__(self):
        return "Salts(***)"


def pseudonymize(identifier, salts):
    r"""`\x` and the hexadecimal SHA-256 of prefix + identifier + suffix; NULL counts as blank."""
    salted = F.concat(
        F.lit(salts.prefix), F.coalesce(identifier.cast("string"), F.lit("")), F.lit(salts.suffix)
    )
    return F.concat(F.lit("\\x"), F.sha2(salted, 256))


def blank_pseudonym(salts):
    """The pseudonym every blank identifier shares: it never identifies anyone."""
    return pseudonymize(F.lit(""), salts)
