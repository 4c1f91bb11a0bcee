"""Session settings the jobs are written for."""

from pyspark.sql import SparkSession

from lutrin.functions.privacy import PREFIX_CONF, SUFFIX_CONF

# Adaptive execution picks join strategies from measured sizes, splits skewed
# join partitions and rebalances skewed writes. Joining on a hot key right under
# an aggregation on the same key would otherwise switch the splitting off, hence
# the forced setting; partitions count as skewed from the size that tasks aim at.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.scheduler.mode": "FAIR",  # domains of a daily run share the cluster
    "spark.ui.enabled": "false",
}


def build_session(app="lutrin", master=None, **extra):
    """A session with `SETTINGS`; keyword values in `extra` win over them.

    Salts given as settings are kept out of printed plans, and so out of event logs.
    """
    salts = [extra[k] for k in (PREFIX_CONF, SUFFIX_CONF) if extra.get(k)]
    if salts:
        quoted = "|".join("\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E" for s in salts)
        extra.setdefault("spark.sql.redaction.string.regex", quoted)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
