"""URL filters by empirical-Bayes host reputation.

Labelled outcomes of pages are added up by host, registered domain and address suffix. Each
level's rate is shrunk towards the one above it by a beta-binomial prior whose strength is
estimated from how much the rates of that level differ. A host is blocked where even the
upper bound of its posterior rate of good pages is below a limit; fixed rules come first.
"""

from pyspark.sql import functions as F

from lutrin.llm.common import Scratch

#: A host is blocked if its rate of good pages is below LIMIT, with a one-sided bound of Z deviations.
LIMIT, Z = 0.5, 1.645
#: Bounds of the prior's strength in pages.
WEAKEST, STRONGEST = 2.0, 1000.0


def split_url(url):
    """Host and path columns of an address; both empty where there is no `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


#: Address suffixes of two labels below which strangers register. A bounded parameter; all other suffixes are the last label. Fixed values.
SUFFIXES = tuple(
    f"{second}.{country}"
    for country, seconds in {
        "uk": "ac co gov ltd me net org plc sch",
        "au": "asn com edu gov id net org",
        "nz": "ac co geek gen govt net org school",
        "za": "ac co gov net org web",
        "jp": "ac ad co ed go gr lg ne or",
        "kr": "ac co go ne or re",
        "cn": "ac com edu gov net org",
        "tw": "com edu gov idv net org",
        "hk": "com edu gov idv net org",
        "sg": "com edu gov net org per",
        "in": "ac co edu firm gen gov ind net org res",
        "br": "adv blog com edu gov net org",
        "ar": "com edu gob net org",
        "mx": "com edu gob net org",
        "tr": "com edu gen gov net org web",
        "il": "ac co gov net org",
        "th": "ac co go in or",
        "id": "ac co go or sch web",
        "my": "com edu gov net org",
        "pl": "com edu gov net org",
        "ua": "com edu gov net org",
    }.items()
    for second in seconds.split()
)
_ADDRESS = r"^(\d+(\.\d+){3}|\[.*\])$"


def site_of(host):
    """The name that has a reputation: a host without user and port, and without a last dot."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", "")
    return F.regexp_replace(bare, r"\.+$", "")


def suffix_of(host, suffixes=SUFFIXES):
    """The part of a name under which strangers register; a numeric address is its own."""
    last = F.substring_index(host, ".", -2)
    return F.when(host.rlike(_ADDRESS) | last.isin(*suffixes), F.when(host.rlike(_ADDRESS), host).otherwise(last)).otherwise(F.substring_index(host, ".", -1))


def domain_of(host, suffixes=SUFFIXES):
    """The registered domain: the suffix and one label more, if there is one."""
    two, three = F.substring_index(host, ".", -2), F.substring_index(host, ".", -3)
    return F.when(host.rlike(_ADDRESS), host).when(two.isin(*suffixes), three).otherwise(two)


def rule_column(rules, host, path):
    """The longest rule (host, path) that fits, and its verdict; null where none does. Ties go to the first."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    longest = sorted(rules, key=lambda r: -len(r[1]) - len(r[2]))
    for verdict, rule_host, rule_path in reversed(longest):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        named = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, named).otherwise(found)
    return found


def shrink(level, mean, strength, good="good", n="n"):
    """Posterior mean of a level from its counts and the prior of the level above."""
    return ((F.col(good) + F.col(mean) * F.col(strength)) / (F.col(n) + F.col(strength))).alias(level)


def strength_of(rates, mean):
    """Strength of the beta prior by moments: how far rates differ beyond what their counts explain."""
    p = F.col(mean)
    spread = F.sum(F.col("n") * (F.col("good") / F.col("n") - p) ** 2)
    noise = F.sum(p * (1 - p))
    room = F.sum(F.col("n") * p * (1 - p)) - noise
    excess = F.greatest((spread - noise) / room, F.lit(1 / (1 + STRONGEST)))
    bounded = F.least(F.greatest(1 / excess - 1, F.lit(WEAKEST)), F.lit(STRONGEST))
    return rates.agg(F.coalesce(F.when(room > 0, bounded), F.lit(STRONGEST)).alias("strength"))


def posteriors(scratch, outcomes):
    """Rates of every level from its outcomes: (tables by level, strengths by level, mean of all).

    `outcomes` has host and good (0 or 1); rows with a null in either are no outcomes.
    """
    known = outcomes.where("host IS NOT NULL AND good IS NOT NULL").select(site_of(F.col("host")).alias("host"), "good")
    hosts = known.groupBy("host").agg(F.sum("good").alias("good"), F.count("*").alias("n"))
    hosts = hosts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))
    hosts = scratch.save(hosts, "hosts")
    whole = hosts.agg(((F.sum("good") + 1) / (F.sum("n") + 2)).alias("mean")).first()["mean"]
    whole = 0.5 if whole is None else whole
    above = F.lit(whole)
    levels, strengths = {}, {}
    for level, parent in (("suffix", None), ("domain", "suffix"), ("host", "domain")):
        counts = hosts.groupBy(*dict.fromkeys([level, parent or level, "suffix"])).agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
        if parent:
            counts = counts.join(levels[parent].select(parent, F.col(f"{parent}_rate").alias("mean")), parent)
        else:
            counts = counts.withColumn("mean", above)
        strengths[level] = float(strength_of(counts, "mean").first()["strength"])
        rated = counts.withColumn("strength", F.lit(strengths[level])).withColumn(f"{level}_rate", shrink("x", "mean", "strength"))
        levels[level] = scratch.save(rated, level)
    return levels, strengths, whole


def upper_bound(rate, spread):
    """Z deviations above a rate whose variance is the share `spread` of that of a single page."""
    return F.least(rate + Z * F.sqrt(rate * (1 - rate) * spread), F.lit(1.0))


def reputations(scratch, outcomes):
    """Posterior of every host with outcomes: host, n, good, rate, upper."""
    return rated_hosts(posteriors(scratch, outcomes)[0]["host"])


def rated_hosts(host):
    rate = F.col("host_rate")
    upper = upper_bound(rate, 1 / (F.col("n") + F.col("strength") + 1))
    return host.select("host", "n", "good", rate.alias("rate"), upper.alias("upper"))


def inherited(hosts, levels, strengths, whole):
    """Rate and upper bound of every host of `hosts` from its nearest level above that has outcomes: host, rate, upper.

    The host itself has none (n = 0): its rate is that of the level, and its variance adds up
    what is not known of that level and how far each level between differs from the one above.
    """
    rows = hosts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))
    unseen = 1 / (strengths["host"] + 1)  # of a host without outcomes, given its domain
    found = []
    for level in ("domain", "suffix"):
        own = 1 / (F.col("n") + F.col("strength") + 1)
        spread = own + (1 - own) * unseen
        rate = F.col(f"{level}_rate")
        rows = rows.join(levels[level].select(level, F.struct(rate.alias("rate"), upper_bound(rate, spread).alias("upper")).alias(f"of_{level}")), level, "left")
        found.append(F.col(f"of_{level}"))
        own = 1 / (strengths[level] + 1)
        unseen = own + (1 - own) * unseen
    corpus = F.struct(F.lit(float(whole)).alias("rate"), upper_bound(F.lit(float(whole)), F.lit(unseen)).alias("upper"))
    return rows.select("host", F.coalesce(*found, corpus).alias("above")).select("host", "above.*")


def judge(pages, outcomes, rules=(), page_id="page_id", url="url", limit=LIMIT, inherit=False):
    """A verdict for every row of `pages`.

    One row per row: page_id, host, path, rule, verdict, n_outcomes, rate and upper bound of
    the host's posterior. A rule decides where one fits. Otherwise a host whose upper bound is
    below `limit` is blocked, and every other allowed. With `inherit`, a host without outcomes
    is judged by the same bound of the nearest level that has some: its domain, its suffix,
    the corpus; without, it has no rate and is allowed. Reputation is that of the host without
    user and port, its domain the name registered below a suffix of SUFFIXES or one label. A null url or one without `://` has an
    empty host and path, which no rule fits, and of the levels only the corpus. Null and repeated page_ids are carried as they are,
    `outcomes` (host, good) may repeat rows, each an outcome; further columns are ignored; an
    empty table gives no rows. Of equally long rules the first counts.
    """
    scratch = Scratch(pages.sparkSession, "reputation")
    host, path = split_url(F.col(url).cast("string"))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    levels, strengths, whole = posteriors(scratch, outcomes.select("host", "good"))
    known = rated_hosts(levels["host"])
    rows = rows.withColumn("site", site_of(F.col("host")))
    if inherit:
        above = inherited(rows.select(F.col("site").alias("host")).distinct().join(known, "host", "left_anti"), levels, strengths, whole)
        known = scratch.save(known.unionByName(above, allowMissingColumns=True), "known")
    fits = rule_column(list(rules), F.col("host"), F.col("path"))
    bad = F.coalesce(F.col("upper") < limit, F.lit(False))
    return (
        rows.join(known.withColumnRenamed("host", "site"), "site", "left")
        .withColumn("fits", fits)
        .select(
            "page_id",
            "host",
            "path",
            F.col("fits.rule").alias("rule"),
            F.coalesce(F.col("fits.verdict"), F.when(bad, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
            F.coalesce("n", F.lit(0)).alias("n_outcomes"),
            "rate",
            "upper",
        )
    )
