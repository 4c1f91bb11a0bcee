"""One query per operator, on the given tables."""

from pyspark.sql import functions as F

from checks.registry import (
    SALTS,
    check,
    pseudonym,
    pseudonym_sql,
    term_sql,
    text_date,
    values,
    values_sql,
)
from lutrin.functions.dates import (
    date_chunks,
    day_in_name,
    day_of,
    normalize_date,
    parse_instant,
    term_start,
)
from lutrin.functions.people import (
    staff_audience,
    staff_function,
    staff_level,
    student_level,
)
from lutrin.functions.privacy import pseudonymize as hashed
from lutrin.functions.text import blank_to_null
from lutrin.operators import aggregates as A
from lutrin.operators import filters
from lutrin.operators import gates as G
from lutrin.operators import links, lookups, merge
from lutrin.plans.computers import changed_persons, days_to_refresh, waiting_pairs
from lutrin.plans.loans import collapse_outside
from lutrin.sources.daily_files import unpaired_days as unpaired
from lutrin.sources.fixed_width import slice_fields
from lutrin.sources.json_pages import explode_children as children_of
from lutrin.sources.json_pages import pivot_fields, project, short_pages, unexpected_labels

# ---- scalar expressions -------------------------------------------------------


@check(
    f"""
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS journee,
           CAST({term_sql("o_orderdate")} AS VARCHAR) AS session
    FROM orders
    """
)
def term_derivation(spark, t):
    return t("orders").select(
        "o_orderkey",
        text_date("o_orderdate").alias("journee"),
        term_start(F.col("o_orderdate")).cast("string").alias("session"),
    )


@check(f"SELECT c_custkey, {pseudonym_sql('c_name')} AS usager FROM customer")
def pseudonymize(spark, t):
    return t("customer").select("c_custkey", hashed(F.col("c_name"), SALTS).alias("usager"))


LEVELS_SQL = """
    CASE substr(o_orderpriority, 1, 1)
      WHEN '1' THEN 'Étudiant - 1er cycle' WHEN '2' THEN 'Étudiant - 2e cycle'
      WHEN '3' THEN 'Étudiant - 3e cycle' WHEN '4' THEN 'Postdoctorat'
      WHEN '6' THEN 'Étudiant - Médecine 3e cycle' WHEN 'C' THEN 'Étudiant - Certificat' END
"""


@check(f"SELECT o_orderkey, {LEVELS_SQL} AS niveau FROM orders")
def label_case(spark, t):
    return t("orders").select(
        "o_orderkey", student_level(F.col("o_orderpriority")).alias("niveau")
    )


# Part types and names stand for staff statuses and job titles.
STAFF_STATUS = "translate(substr(p_type, 1, 1), 'EMSPL', 'RCTPQ')"
STAFF_TITLE = (
    "replace(replace(replace(replace(p_name, 'small', 'Professeur'), 'ring', 'clinique'),"
    " 'red', 'Chercheur'), 'hot bolt', 'Chargé(e) de cours')"
)


@check(
    f"""
    SELECT p_partkey, statut,
      CASE WHEN statut = 'C' THEN 'Chargé de cours' WHEN statut = 'R' THEN 'Professeur'
           WHEN statut IN ('P', 'T') THEN 'Personnel' END AS fonction,
      CASE WHEN statut = 'C' THEN 'Chargé de cours' WHEN statut = 'R' THEN 'Professeur' END AS niveau
    FROM (SELECT p_partkey, {STAFF_STATUS} AS statut FROM part)
    """
)
def staff_labels(spark, t):
    status = F.expr(STAFF_STATUS)
    return t("part").select(
        "p_partkey",
        status.alias("statut"),
        staff_function(status).alias("fonction"),
        staff_level(status).alias("niveau"),
    )


@check(
    f"""
    SELECT p_partkey,
      CAST(CASE WHEN statut IN ('P', 'T') THEN 0
           WHEN statut = 'C' THEN CASE WHEN titre = 'Chargé(e) de cours' THEN 1 ELSE 0 END
           WHEN statut = 'R' THEN CASE WHEN titre LIKE 'Chercheur%' OR titre LIKE 'Enseignant%'
             OR (titre LIKE 'Prof%' AND titre NOT LIKE '%clini%') THEN 1 ELSE 0 END
           ELSE -1 END AS INTEGER) AS clientele
    FROM (SELECT p_partkey, {STAFF_STATUS} AS statut, {STAFF_TITLE} AS titre FROM part)
    """
)
def audience_flag(spark, t):
    flag = staff_audience(F.expr(STAFF_STATUS), F.expr(STAFF_TITLE))
    return t("part").select(
        "p_partkey", F.coalesce(flag.cast("int"), F.lit(-1)).alias("clientele")
    )


RENDERED_DATE = """
    CASE o_orderstatus
      WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
      WHEN 'O' THEN CAST(day(o_orderdate) AS VARCHAR) || '/' || CAST(month(o_orderdate) AS VARCHAR)
                    || '/' || CAST(year(o_orderdate) AS VARCHAR) || ' 3:04:05'
      ELSE CASE o_orderpriority WHEN '5-LOW' THEN 'n/a' WHEN '1-URGENT' THEN '31/02/2024 00:00:00'
           ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.123' END END
"""


def rendered_orders(t):
    """Orders with their date in one of the forms that loan files use."""
    iso = F.col("o_orderdate").cast("string")
    day_first = F.concat_ws(
        "/", F.day("o_orderdate"), F.month("o_orderdate"), F.year("o_orderdate")
    )
    odd = (
        F.when(F.col("o_orderpriority") == "5-LOW", "n/a")
        .when(F.col("o_orderpriority") == "1-URGENT", "31/02/2024 00:00:00")
        .otherwise(F.concat(iso, F.lit(".123")))
    )
    date = (
        F.when(F.col("o_orderstatus") == "F", iso)
        .when(F.col("o_orderstatus") == "O", F.concat(day_first, F.lit(" 3:04:05")))
        .otherwise(odd)
    )
    return t("orders").withColumn("date", date)


@check(
    f"""
    SELECT o_orderkey,
      CASE WHEN regexp_matches(date, '^\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}}') THEN date
           ELSE strftime(try_strptime(date, '%d/%m/%Y %H:%M:%S'), '%Y-%m-%d %H:%M:%S') END AS date
    FROM (SELECT o_orderkey, {RENDERED_DATE} AS date FROM orders)
    """,
    name="normalize_date",
)
def normalize_dates(spark, t):
    return rendered_orders(t).select("o_orderkey", normalize_date(F.col("date")).alias("date"))


@check(
    f"""
    SELECT o_orderkey, date FROM (SELECT o_orderkey, {RENDERED_DATE} AS date FROM orders)
    WHERE NOT regexp_matches(date, '^\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}}$')
    """
)
def date_gate(spark, t):
    return G.malformed_dates(rendered_orders(t).select("o_orderkey", "date"))


@check(
    """
    WITH bounds AS (SELECT event_type, MIN(CAST(ts AS DATE)) AS a, MAX(CAST(ts AS DATE)) AS b
                    FROM events GROUP BY event_type),
    w AS (SELECT event_type, b, unnest(generate_series(a, b, INTERVAL 10 DAY)) AS d FROM bounds)
    SELECT event_type, CAST(CAST(d AS DATE) AS VARCHAR) AS debut,
           CAST(least(CAST(d AS DATE) + 9, b) AS VARCHAR) AS fin
    FROM w
    """,
    name="date_chunks",
)
def windows_of_days(spark, t):
    day = day_of(F.col("ts"))
    bounds = t("events").groupBy("event_type").agg(
        F.min(day).alias("start"), F.max(day).alias("end")
    )
    return date_chunks(bounds, 10).select(
        "event_type", F.col("debut").cast("string"), F.col("fin").cast("string")
    )


@check(
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P'
      THEN CAST(CAST(o_orderdate AS DATE) - 1 AS VARCHAR) END AS journee FROM orders
    """
)
def file_day(spark, t):
    suffix = F.when(
        F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyyMMdd")
    ).otherwise("gz")
    name = F.concat(F.lit("synchro_ac.TXT."), suffix)
    return t("orders").select("o_orderkey", day_in_name(name).cast("string").alias("journee"))


# ---- filters ------------------------------------------------------------------

STATUSES = [("F", True), ("O", True), ("P", False)]


@check(
    f"""
    SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT EXISTS (
      SELECT 1 FROM ({values_sql(STATUSES)}) v(nom, conserver)
      WHERE v.nom = o_orderstatus AND NOT v.conserver)
    """
)
def status_antijoin(spark, t):
    flags = values(spark, STATUSES, ["nom", "conserver"])
    return filters.drop_flagged(
        t("orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", flags
    )


@check(
    "SELECT c_custkey, c_mktsegment FROM customer"
    " WHERE (c_mktsegment IN ('BUILDING', 'MACHINERY')) IS NOT TRUE"
)
def drop_listed(spark, t):
    return filters.drop_listed(
        t("customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", ["BUILDING", "MACHINERY"]
    )


@check("SELECT p_partkey, p_name FROM part WHERE (p_name LIKE '%ring%') IS NOT TRUE")
def drop_like(spark, t):
    return filters.drop_containing(t("part").select("p_partkey", "p_name"), "p_name", "ring")


@check("SELECT p_partkey, p_name FROM part WHERE (p_name ILIKE '%RiNG%') IS NOT TRUE")
def drop_ilike(spark, t):
    return filters.drop_containing_any_case(
        t("part").select("p_partkey", "p_name"), "p_name", "RiNG"
    )


@check(
    """
    SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (
      SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)
    """
)
def semi_exclude(spark, t):
    big = t("orders").filter("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return filters.without(t("customer").select("c_custkey", "c_name"), big, ["c_custkey"])


@check(
    """
    SELECT event_id, user_id, event_type FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-19'
    """
)
def date_range_scan(spark, t):
    return filters.between_days(t("events"), "ts", "2024-01-05", "2024-01-19").select(
        "event_id", "user_id", "event_type"
    )


@check(
    """
    SELECT o_orderkey, x AS date FROM (SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN ''
      WHEN '1-URGENT' THEN NULL ELSE o_orderpriority END AS x FROM orders) WHERE x <> ''
    """
)
def drop_blank(spark, t):
    text = F.expr(
        "CASE o_orderpriority WHEN '5-LOW' THEN '' WHEN '1-URGENT' THEN NULL ELSE o_orderpriority END"
    )
    return filters.drop_blank(t("orders").select("o_orderkey", text.alias("date")), "date")


@check(f"SELECT p_partkey FROM part WHERE {STAFF_STATUS} NOT IN ('Q', 'X')")
def drop_retired(spark, t):
    rows = t("part").select("p_partkey", F.expr(STAFF_STATUS).alias("Statut"))
    return filters.drop_retired(rows).drop("Statut")


# ---- lookups ------------------------------------------------------------------

NATION_NAMES_SQL = """
    names AS (SELECT n_name AS rejeter, r_name AS accepter FROM nation
              JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA')
"""


def nation_synonyms(t, domain):
    """Nation names are rejected in favour of their region, except in one region."""
    kept = t("region").filter("r_name <> 'ASIA'")
    return t("nation").join(kept, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.lit(domain).alias("domaine"),
        F.col("n_name").alias("rejeter"),
        F.col("r_name").alias("accepter"),
    )


def with_nation(df, key, t):
    nations = t("nation").select(F.col("n_nationkey").alias(key), "n_name")
    return df.join(nations, key)


@check(
    f"""
    WITH {NATION_NAMES_SQL}
    SELECT c_custkey, coalesce(accepter, n_name) AS lieu FROM customer
    JOIN nation ON c_nationkey = n_nationkey LEFT JOIN names ON n_name = rejeter
    """
)
def synonym_map(spark, t):
    df = with_nation(t("customer"), "c_nationkey", t).select(
        "c_custkey", F.col("n_name").alias("lieu")
    )
    return lookups.normalize(df, ["lieu"], nation_synonyms(t, "Réservations"), "Réservations")


FLAGS = [
    ("Emprunts", "R", "Rendu"),
    ("Emprunts", "F", "Final"),
    ("Emprunts", "A", "Autre"),
    ("Ordinateurs", "N", "Non"),
]


@check(
    f"""
    WITH s AS (SELECT * FROM ({values_sql(FLAGS)}) v(domaine, rejeter, accepter)
               WHERE domaine = 'Emprunts')
    SELECT l_orderkey, l_linenumber, l_partkey, coalesce(a.accepter, l_returnflag) AS pret,
           coalesce(b.accepter, l_linestatus) AS document
    FROM lineitem LEFT JOIN s a ON l_returnflag = a.rejeter LEFT JOIN s b ON l_linestatus = b.rejeter
    """
)
def synonym_multi(spark, t):
    df = t("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_returnflag").alias("pret"),
        F.col("l_linestatus").alias("document"),
    )
    names = values(spark, FLAGS, ["domaine", "rejeter", "accepter"])
    return lookups.normalize(df, ["pret", "document"], names, "Emprunts")


@check(
    """
    WITH outside AS (SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)
    SELECT s_suppkey,
      CASE WHEN n_name NOT LIKE '%NATION_1%' THEN 'Bibliothèque extérieure' ELSE s_name END AS bibliotheque_pret,
      CASE WHEN n_name NOT LIKE '%NATION_1%' THEN 'Bibliothèque extérieure' ELSE n_name END AS bibliotheque_document
    FROM outside
    """
)
def collapse_external(spark, t):
    df = with_nation(t("supplier"), "s_nationkey", t).select(
        "s_suppkey",
        F.col("n_name").alias("institution_doc"),
        F.col("s_name").alias("bibliotheque_pret"),
        F.col("n_name").alias("bibliotheque_document"),
    )
    return collapse_outside(df, "NATION_1").drop("institution_doc")


@check(
    """
    WITH one AS (SELECT p_brand AS k, 'marque ' || p_brand AS v FROM part
                 GROUP BY p_brand HAVING max(p_size) = 50),
    two AS (SELECT p_size AS k, 'taille ' || min(p_name) AS v FROM part GROUP BY p_size
            HAVING count(*) >= 40),
    three AS (SELECT p_type AS a, p_name AS b, 'type ' || min(p_brand) AS v FROM part GROUP BY ALL)
    SELECT p_partkey, coalesce(one.v, two.v, three.v) AS discipline
    FROM part LEFT JOIN one ON p_brand = one.k LEFT JOIN two ON p_size = two.k
    LEFT JOIN three ON p_type = three.a AND p_name = three.b
    """
)
def lookup_chain(spark, t):
    part = t("part")
    one = part.groupBy("p_brand").agg(F.max("p_size").alias("m")).filter("m = 50").select(
        F.col("p_brand").alias("marque"), F.concat(F.lit("marque "), "p_brand").alias("valeur")
    )
    two = (
        part.groupBy("p_size")
        .agg(F.count("*").alias("n"), F.min("p_name").alias("nom"))
        .filter("n >= 40")
        .select(F.col("p_size").alias("taille"), F.concat(F.lit("taille "), "nom").alias("valeur"))
    )
    three = part.select("p_type", "p_name", F.concat(F.lit("type "), "p_brand").alias("valeur"))
    return lookups.lookup_chain(
        part.select("p_partkey", "p_brand", "p_size", F.col("p_type").alias("t"), F.col("p_name").alias("n")),
        [
            (one, [("p_brand", "marque")], "valeur"),
            (two, [("p_size", "taille")], "valeur"),
            (three, [("t", "p_type"), ("n", "p_name")], "valeur"),
        ],
        "discipline",
    ).select("p_partkey", "discipline")


@check(
    """
    SELECT c_custkey, n_name AS discipline, r_name AS bibliotheque FROM customer
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    """
)
def case_level_join(spark, t):
    placed = lookups.lookup(
        t("customer").select("c_custkey", "c_nationkey"),
        t("nation"),
        {"c_nationkey": "n_nationkey"},
        "n_name",
        "discipline",
    )
    nations = lookups.lookup(t("nation"), t("region"), {"n_regionkey": "r_regionkey"}, "r_name")
    return lookups.lookup(
        placed, nations, {"c_nationkey": "n_nationkey"}, "r_name", "bibliotheque"
    ).drop("c_nationkey")


@check(
    """
    SELECT n_name, (SELECT r_name FROM region WHERE r_regionkey = n_regionkey) AS secteur,
           coalesce((SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey), 0) AS nb
    FROM nation
    """
)
def scalar_lookup(spark, t):
    placed = lookups.lookup(
        t("nation"), t("region"), {"n_regionkey": "r_regionkey"}, "r_name", "secteur"
    )
    return A.left_count(
        placed, t("customer"), "n_nationkey", "c_nationkey", "c_custkey", "nb"
    ).select("n_name", "secteur", "nb")


# ---- repairs and defaults -----------------------------------------------------


@check(
    f"""
    SELECT o_orderkey, CAST(coalesce(CASE WHEN o_orderstatus <> 'F' THEN DATE '1990-01-01' END,
                                     {term_sql("o_orderdate")}) AS VARCHAR) AS session
    FROM orders
    """
)
def fill_missing(spark, t):
    old = F.when(F.col("o_orderstatus") != "F", F.lit("1990-01-01").cast("date"))
    return t("orders").select(
        "o_orderkey",
        F.coalesce(old, term_start(F.col("o_orderdate"))).cast("string").alias("session"),
    )


@check(
    "SELECT o_orderkey, nullif(CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END, '')"
    " AS presentateur FROM orders",
    name="blank_to_null",
)
def blank_as_missing(spark, t):
    text = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderpriority"))
    return t("orders").select("o_orderkey", blank_to_null(text).alias("presentateur"))


# ---- links --------------------------------------------------------------------

PERSONS_SQL = f"""
    persons AS (SELECT c_custkey, {pseudonym_sql("c_name")} AS usager,
                       CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS discipline
                FROM customer WHERE c_acctbal >= 0)
"""


def customer_persons(t):
    """Customers not in debt as the person table; one segment has no discipline."""
    return t("customer").filter("c_acctbal >= 0").select(
        F.lit("2024-01-01").cast("date").alias("journee"),
        pseudonym("c_name").alias("usager"),
        pseudonym("'u' || c_custkey").alias("courriel"),
        pseudonym("'b' || c_custkey").alias("codebarres"),
        F.expr("CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END").alias("discipline"),
    )


@check(
    f"""
    WITH {PERSONS_SQL}
    SELECT o_orderkey, usager,
           CASE WHEN usager IS NULL THEN 'Inconnue' ELSE discipline END AS discipline
    FROM orders LEFT JOIN persons
      ON CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END = c_custkey
    """
)
def link_left(spark, t):
    facts = t("orders").select(
        "o_orderkey",
        F.expr("CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'u' || o_custkey END").alias("email"),
    )
    linked = links.link(
        facts,
        links.unique_persons(customer_persons(t), "courriel", SALTS),
        "email",
        "courriel",
        {"usager": "usager", "discipline": "discipline"},
        encode=lambda c: hashed(c, SALTS),
    )
    return linked.select(
        "o_orderkey",
        "usager",
        F.expr("CASE WHEN usager IS NULL THEN 'Inconnue' ELSE discipline END").alias("discipline"),
    )


@check(
    f"""
    WITH {PERSONS_SQL}
    SELECT o_orderkey, usager, discipline FROM orders JOIN persons ON o_custkey = c_custkey
    """
)
def link_inner(spark, t):
    return links.link(
        t("orders").select("o_orderkey", F.expr("'b' || o_custkey").alias("cb_usager")),
        links.unique_persons(customer_persons(t), "codebarres", SALTS),
        "cb_usager",
        "codebarres",
        {"usager": "usager", "discipline": "discipline"},
        how="inner",
        encode=lambda c: hashed(c, SALTS),
    ).drop("cb_usager")


@check(
    f"""
    WITH {PERSONS_SQL}
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'ancien'
                            WHEN p.usager IS NOT NULL THEN p.usager END AS lien,
           CASE WHEN o_orderstatus = 'F' THEN 'ancienne' WHEN p.usager IS NOT NULL THEN p.discipline
                ELSE 'gardée' END AS discipline
    FROM orders LEFT JOIN persons p ON o_custkey = c_custkey
    """
)
def enrich_missing(spark, t):
    facts = t("orders").select(
        "o_orderkey",
        F.expr("'u' || o_custkey").alias("email"),
        F.expr("CASE WHEN o_orderstatus = 'F' THEN 'ancien' END").alias("lien"),
        F.expr("CASE WHEN o_orderstatus = 'F' THEN 'ancienne' ELSE 'gardée' END").alias("discipline"),
    )
    return links.enrich_missing(
        facts,
        links.unique_persons(customer_persons(t), "courriel", SALTS),
        "email",
        "courriel",
        {"usager": "lien", "discipline": "discipline"},
        missing=["lien"],
        encode=lambda c: hashed(c, SALTS),
    ).drop("email")


@check(
    """
    SELECT c_nationkey, c_name AS usager FROM (
      SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment DESC, c_name) AS r
      FROM customer) WHERE r = 1
    """
)
def unique_person(spark, t):
    persons = t("customer").select(
        F.col("c_nationkey").cast("string").alias("codebarres"),
        F.col("c_mktsegment").alias("journee"),
        F.col("c_name").alias("usager"),
    )
    return links.unique_persons(persons, "codebarres").select(
        F.col("codebarres").cast("int").alias("c_nationkey"), "usager"
    )


@check(
    """
    SELECT o_orderkey, coalesce(presentateur, o_orderpriority) AS presentateur,
           coalesce(segment, 'Inconnue') AS discipline
    FROM (SELECT *, CASE WHEN o_orderstatus = 'O' THEN o_orderstatus END AS presentateur FROM orders)
    LEFT JOIN (SELECT c_custkey, c_mktsegment AS segment FROM customer WHERE c_acctbal >= 0)
      ON o_custkey = c_custkey
    """
)
def fallback_unknown(spark, t):
    known = t("customer").filter("c_acctbal >= 0").select("c_custkey", "c_mktsegment")
    facts = t("orders").withColumn(
        "presentateur", F.when(F.col("o_orderstatus") == "O", F.col("o_orderstatus"))
    )
    linked = links.link(
        facts.select("o_orderkey", "o_custkey", "o_orderpriority", "presentateur"),
        known.withColumn("c_custkey", F.col("c_custkey").cast("string")),
        "o_custkey",
        "c_custkey",
        {"c_mktsegment": "discipline"},
    )
    return linked.select(
        "o_orderkey",
        F.coalesce("presentateur", "o_orderpriority").alias("presentateur"),
        F.coalesce("discipline", F.lit("Inconnue")).alias("discipline"),
    )


@check(
    """
    WITH persons AS (SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal >= 0)
    SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS journee FROM orders
    JOIN persons ON o_custkey = c_custkey WHERE o_orderstatus = 'P' AND o_totalprice > 400000
    """
)
def sessions_to_refresh(spark, t):
    known = "o_orderstatus <> 'P' OR o_totalprice <= 400000"
    sessions = t("orders").select(
        F.col("o_custkey").cast("string").alias("usager"),
        F.col("o_orderdate").cast("date").alias("journee"),
        F.expr(f"CASE WHEN {known} THEN 'c' END").alias("courriel"),
        F.expr(f"CASE WHEN {known} THEN 'd' ELSE 'Inconnue' END").alias("discipline"),
        F.expr(f"CASE WHEN {known} THEN 'b' END").alias("bibliotheque"),
    )
    persons = t("customer").filter("c_acctbal >= 0").select(
        F.lit("2024-01-01").cast("date").alias("journee"),
        F.col("c_custkey").cast("string").alias("usager"),
        F.col("c_name").alias("courriel"),
        F.col("c_mktsegment").alias("discipline"),
        F.col("c_name").alias("bibliotheque"),
    )
    days = days_to_refresh(waiting_pairs(sessions), persons, SALTS)
    return days.select(F.col("journee").cast("string"))


@check(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS usager FROM customer
    WHERE c_acctbal >= 0 AND (c_mktsegment = 'BUILDING' OR c_nationkey < 5)
    """
)
def persons_changed(spark, t):
    """Persons against an earlier version that lacks one segment and knew other libraries in some nations."""
    persons = t("customer").filter("c_acctbal >= 0").select(
        F.col("c_custkey").cast("string").alias("usager"),
        F.expr("CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_name END").alias("courriel"),
        F.col("c_mktsegment").alias("discipline"),
        F.col("c_nationkey").cast("string").alias("bibliotheque"),
    )
    library = F.expr("CASE WHEN bibliotheque < 5 THEN NULL ELSE bibliotheque END")
    seen = persons.filter("discipline <> 'BUILDING'").withColumn("bibliotheque", library)
    return changed_persons(persons, seen).select("usager")


# ---- aggregates ---------------------------------------------------------------


@check(
    """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS journee, event_type AS secteur,
           CAST(sum(user_id) AS BIGINT) AS frequentation
    FROM events GROUP BY 1, 2
    """
)
def daily_sum(spark, t):
    return A.daily_sum(
        t("events").withColumnRenamed("event_type", "secteur"), "ts", ["secteur"], "user_id", "frequentation"
    ).withColumn("journee", F.col("journee").cast("string"))


@check(
    """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS journee, event_type AS secteur,
           CAST(trunc(CAST(sum(75 - user_id) AS DECIMAL(38, 0)) / 4) AS BIGINT) AS occupation
    FROM events GROUP BY 1, 2
    """
)
def daily_hours(spark, t):
    df = t("events").select(
        "ts", F.col("event_type").alias("secteur"), (75 - F.col("user_id")).alias("echantillon")
    )
    return A.daily_hours(df, "ts", ["secteur"], "echantillon", "occupation").withColumn(
        "journee", F.col("journee").cast("string")
    )


@check(
    """
    SELECT c_custkey, count(o.email) AS nb_participants FROM customer LEFT JOIN (
      SELECT o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS email FROM orders
    ) o ON c_custkey = o_custkey GROUP BY c_custkey
    """
)
def left_count(spark, t):
    children = t("orders").select(
        "o_custkey", F.expr("CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END").alias("email")
    )
    return A.left_count(
        t("customer").select("c_custkey"), children, "c_custkey", "o_custkey", "email", "nb_participants"
    )


@check(
    """
    SELECT s_suppkey, CAST(round(1.0 / count(*) OVER (PARTITION BY s_nationkey), 6) AS DOUBLE) AS facteur
    FROM supplier
    """
)
def split_factor(spark, t):
    return A.split_factor(
        t("supplier").select("s_suppkey", F.col("s_nationkey").alias("discipline"))
    ).select("s_suppkey", F.round("facteur", 6).cast("double").alias("facteur"))


@check(
    """
    SELECT c_nationkey, c_mktsegment, count(*) AS nb FROM customer WHERE NOT EXISTS (
      SELECT 1 FROM supplier WHERE s_nationkey = c_nationkey AND s_acctbal > 9000)
    GROUP BY ALL
    """
)
def grouped_gate(spark, t):
    rich = t("supplier").filter("s_acctbal > 9000")
    placed = lookups.lookup(
        t("customer"), rich, {"c_nationkey": "s_nationkey"}, "s_name", "discipline"
    )
    return G.unresolved(placed, "discipline", ["c_nationkey", "c_mktsegment"])


# ---- latest rows and merges ---------------------------------------------------


@check(
    """
    SELECT o_custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS journee FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS r
      FROM orders) WHERE r = 1
    """
)
def latest_by(spark, t):
    latest = merge.latest_by(
        t("orders").select("o_custkey", "o_orderkey", "o_orderdate"),
        ["o_custkey"],
        [F.desc("o_orderdate"), F.asc("o_orderkey")],
    )
    return latest.select("o_custkey", "o_orderkey", text_date("o_orderdate").alias("journee"))


@check(
    """
    SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS journee, max(event_id) AS event_id
    FROM events GROUP BY ALL
    """
)
def drop_first_duplicate(spark, t):
    events = t("events").select("user_id", text_date("ts").alias("journee"), "event_id")
    return merge.latest_by(events, ["user_id", "journee"], [F.desc("event_id")])


OLD_ORDERS = "o_orderdate < timestamp_ntz'1999-01-01'"
NEW_ORDERS = "o_orderdate >= timestamp_ntz'1997-01-01'"
OVERLAP_SQL = """
    cur AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders
            WHERE o_orderdate < TIMESTAMP '1999-01-01'),
    new AS (SELECT o_orderkey, o_custkey + 1 AS o_custkey, 'N' AS o_orderstatus, o_orderpriority
            FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01')
"""


def overlapping_orders(t):
    """Orders as a current table and a delivery that overlap in two years."""
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    current = t("orders").filter(OLD_ORDERS).select(*columns)
    new = t("orders").filter(NEW_ORDERS).select(*columns)
    return current, new.withColumn("o_custkey", F.col("o_custkey") + 1).withColumn(
        "o_orderstatus", F.lit("N")
    )


@check(
    f"""
    WITH {OVERLAP_SQL}
    SELECT coalesce(c.o_orderkey, n.o_orderkey) AS o_orderkey,
           coalesce(n.o_custkey, c.o_custkey) AS o_custkey,
           coalesce(c.o_orderstatus, n.o_orderstatus) AS o_orderstatus,
           coalesce(n.o_orderpriority, c.o_orderpriority) AS o_orderpriority
    FROM cur c FULL JOIN new n ON c.o_orderkey = n.o_orderkey
    """
)
def upsert(spark, t):
    current, new = overlapping_orders(t)
    return merge.upsert(current, new, ["o_orderkey"], update=["o_custkey", "o_orderpriority"])


@check(
    f"""
    WITH {OVERLAP_SQL}
    SELECT coalesce(c.o_orderkey, n.o_orderkey) AS o_orderkey,
           coalesce(n.o_custkey, c.o_custkey) AS o_custkey,
           coalesce(c.o_orderstatus, n.o_orderstatus) AS o_orderstatus,
           CASE WHEN n.o_orderkey IS NULL THEN c.o_orderpriority END AS o_orderpriority
    FROM cur c FULL JOIN new n ON c.o_orderkey = n.o_orderkey
    """
)
def upsert_reset(spark, t):
    current, new = overlapping_orders(t)
    return merge.upsert(
        current, new, ["o_orderkey"], update=["o_custkey"], reset=["o_orderpriority"]
    )


@check(
    f"""
    WITH {OVERLAP_SQL}
    SELECT coalesce(c.o_orderkey, n.o_orderkey) AS o_orderkey,
           coalesce(n.o_custkey, c.o_custkey) AS o_custkey,
           coalesce(c.o_orderstatus, n.o_orderstatus) AS o_orderstatus,
           coalesce(nullif(n.o_orderpriority, '5-LOW'), c.o_orderpriority) AS o_orderpriority
    FROM cur c FULL JOIN new n ON c.o_orderkey = n.o_orderkey
    """
)
def upsert_fill(spark, t):
    current, new = overlapping_orders(t)
    partial = new.withColumn("o_orderpriority", F.expr("nullif(o_orderpriority, '5-LOW')"))
    return merge.upsert(
        current, partial, ["o_orderkey"], update=["o_custkey"], fill=["o_orderpriority"]
    )


@check(
    """
    WITH cur AS (SELECT o_custkey, o_orderdate, o_orderkey FROM orders
                 WHERE o_orderdate < TIMESTAMP '1999-01-01'),
    new AS (SELECT * FROM (SELECT o_custkey, o_orderdate, o_orderkey, row_number() OVER (
              PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) AS r FROM orders
            WHERE o_orderdate >= TIMESTAMP '1997-01-01') WHERE r = 1),
    res AS (SELECT o_custkey, o_orderdate, o_orderkey FROM cur UNION ALL
      SELECT o_custkey, o_orderdate, o_orderkey FROM new n WHERE NOT EXISTS (
        SELECT 1 FROM cur c WHERE c.o_custkey = n.o_custkey AND c.o_orderdate = n.o_orderdate))
    SELECT o_custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS journee FROM res
    """
)
def insert_new(spark, t):
    orders = t("orders").select("o_custkey", "o_orderdate", "o_orderkey")
    merged = merge.insert_new(
        orders.filter(OLD_ORDERS),
        orders.filter(NEW_ORDERS),
        ["o_custkey", "o_orderdate"],
        [F.asc("o_orderkey")],
    )
    return merged.select("o_custkey", "o_orderkey", text_date("o_orderdate").alias("journee"))


@check(
    """
    WITH cur AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS journee, event_id, event_type, user_id FROM events),
    new AS (SELECT journee, event_id, 'repris' AS event_type, user_id FROM cur
            WHERE event_type = 'signup' AND journee >= '2024-01-10')
    SELECT * FROM cur WHERE journee NOT IN (SELECT journee FROM new) UNION ALL SELECT * FROM new
    """
)
def replace_partition(spark, t):
    current = t("events").select(
        text_date("ts").alias("journee"), "event_id", "event_type", "user_id"
    )
    new = current.filter("event_type = 'signup' AND journee >= '2024-01-10'").withColumn(
        "event_type", F.lit("repris")
    )
    return merge.replace_days(current, new)


@check(
    """
    SELECT c_name AS usager, c_mktsegment AS code_programme, NULL::VARCHAR AS code_unite FROM customer
    UNION ALL SELECT s_name, NULL, CAST(s_nationkey AS VARCHAR) FROM supplier
    """
)
def person_union(spark, t):
    return merge.combine(
        t("customer").select(
            F.col("c_name").alias("usager"), F.col("c_mktsegment").alias("code_programme")
        ),
        t("supplier").select(
            F.col("s_name").alias("usager"), F.col("s_nationkey").cast("string").alias("code_unite")
        ),
    )


@check(
    """
    SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier
    """
)
def distinct_union(spark, t):
    return (
        t("customer")
        .select(F.col("c_nationkey").alias("nationkey"))
        .union(t("supplier").select("s_nationkey"))
        .distinct()
    )


# ---- gates --------------------------------------------------------------------


@check(
    """
    SELECT o_orderpriority AS codecycle, o_orderkey, o_orderstatus AS programme FROM orders
    WHERE substr(o_orderpriority, 1, 1) NOT IN (SELECT CAST(r_regionkey AS VARCHAR) FROM region)
    """
)
def prefix_gate(spark, t):
    rows = t("orders").select(
        F.col("o_orderpriority").alias("codeCycle"),
        F.col("o_orderkey").alias("codeProgramme"),
        F.col("o_orderstatus").alias("programme"),
    )
    listed = t("region").select(F.col("r_regionkey").cast("string").alias("cycle"))
    return G.unknown_cycles(rows, listed).select(
        F.col("codeCycle").alias("codecycle"), F.col("codeProgramme").alias("o_orderkey"), "programme"
    )


@check(
    f"""
    WITH {NATION_NAMES_SQL}
    SELECT n_name AS lieu FROM customer JOIN nation ON c_nationkey = n_nationkey
    WHERE n_name NOT IN (SELECT rejeter FROM names) GROUP BY n_name
    """
)
def synonym_gate(spark, t):
    df = with_nation(t("customer"), "c_nationkey", t).select(F.col("n_name").alias("lieu"))
    names = nation_synonyms(t, "Ordinateurs").select("rejeter")
    return G.unlisted(df, "lieu", names)


@check(
    f"""
    WITH {NATION_NAMES_SQL},
    known AS (SELECT rejeter AS n FROM names UNION SELECT accepter FROM names)
    SELECT n_name AS succursale FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer)
      AND n_name NOT IN (SELECT n FROM known)
    UNION SELECT c_mktsegment FROM customer WHERE c_mktsegment NOT IN (SELECT n FROM known)
    """
)
def union_gate(spark, t):
    df = with_nation(t("customer"), "c_nationkey", t)
    return G.unmapped_names(
        df, ["n_name", "c_mktsegment"], nation_synonyms(t, "Emprunts"), "Emprunts"
    )


@check(
    """
    SELECT DISTINCT p_name AS discipline FROM part p WHERE NOT EXISTS (
      SELECT 1 FROM part q WHERE q.p_name = p.p_name AND q.p_size = 50)
    """
)
def unmatched_gate(spark, t):
    part = t("part").select(F.col("p_name").alias("discipline"), "p_size")
    return G.unmatched(part, "discipline", part.filter("p_size = 50"))


@check(
    """
    SELECT l_orderkey, l_linenumber, count(*) AS nb FROM lineitem GROUP BY ALL HAVING count(*) > 1
    """
)
def key_check(spark, t):
    return G.broken_keys(t("lineitem"), ["l_orderkey", "l_linenumber"])


@check(
    """
    SELECT 'p_name' AS colonne, 9 AS limite, length(p_name) AS longueur, p_name AS valeur FROM part
    WHERE length(p_name) > 9
    UNION ALL SELECT 'p_type', 6, length(p_type), p_type FROM part WHERE length(p_type) > 6
    """
)
def length_check(spark, t):
    return G.too_long(t("part"), {"p_name": 9, "p_type": 6})


@check(
    """
    SELECT concat_ws(chr(9), CAST(o_orderkey AS VARCHAR),
           coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END, 'None')) AS value FROM orders
    """
)
def report_lines(spark, t):
    rows = t("orders").select(
        "o_orderkey", F.expr("CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END").alias("x")
    )
    return G.report(rows)


@check(
    f"""
    SELECT o_orderkey, date FROM (SELECT o_orderkey, {RENDERED_DATE} AS date FROM orders)
    WHERE try_strptime(substr(date, 1, 19), '%Y-%m-%d %H:%M:%S') IS NULL
    """
)
def impossible_dates(spark, t):
    rows = rendered_orders(t).select("o_orderkey", "date")
    return rows.filter(parse_instant(F.col("date")).isNull())


@check(
    """
    WITH numbered AS (SELECT conv_id AS page, count(*) AS nb FROM conversations GROUP BY 1)
    SELECT page, nb FROM numbered WHERE nb < 6 AND page <> (SELECT max(page) FROM numbered)
    """
)
def short_page_gate(spark, t):
    name = F.concat(F.lit("page-"), F.col("conv_id").cast("string"), F.lit(".json"))
    return short_pages(t("conversations").select(name.alias("fichier")), 6)


@check(
    """
    SELECT DISTINCT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS journee FROM lineitem
    WHERE CAST(l_shipdate AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)
    """
)
def unpaired_days(spark, t):
    days = unpaired(
        t("lineitem").select(F.col("l_shipdate").cast("date").alias("journee")),
        t("orders").select(F.col("o_orderdate").cast("date").alias("journee")),
    )
    return days.select(F.col("journee").cast("string"))


# ---- record shapes ------------------------------------------------------------


@check(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS cle, c_name AS nom, c_mktsegment AS segment FROM customer
    WHERE c_mktsegment <> 'BUILDING'
    """
)
def fixed_width(spark, t):
    blank = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).otherwise("")
    lines = t("customer").select(
        F.concat(
            F.lit("...."),
            F.rpad(F.col("c_custkey").cast("string"), 12, " "),
            F.rpad(F.concat(F.lit("\u00a0 "), "c_name"), 40, " "),
            F.rpad(F.concat(F.lit("\t"), blank, F.lit(" ")), 20, " "),
        ).alias("value")
    )
    layout = {"cle": (4, 16), "nom": (16, 56), "segment": (56, 76)}
    return slice_fields(lines, layout).filter("segment <> ''")


@check(
    """
    SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS k, '' AS absent FROM events
    """
)
def json_project(spark, t):
    parsed = t("events").select(
        "event_id", F.from_json("props", "k bigint, absent string").alias("owner")
    )
    return project(parsed, ["owner.k", "owner.absent"], keep=["event_id"])


@check(
    """
    SELECT CAST(doc_id AS VARCHAR) AS event_id, unnest(range(1, len(l) + 1)) AS rang, unnest(l) AS ligne
    FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)
    """
)
def explode_children(spark, t):
    lines = F.transform(
        F.split("text", "\n"),
        lambda x, i: F.struct((i + 1).cast("bigint").alias("rang"), x.alias("ligne")),
    )
    return children_of(
        t("documents").select("doc_id", lines.alias("registrants")), "doc_id", "registrants", "event_id"
    )


def page_fields(t):
    """Pages with the parameters of their address as a list of labels and answers."""
    query = F.regexp_extract("url", r"\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda x: x != "")
    fields = F.transform(
        pairs,
        lambda x: F.struct(
            F.substring_index(x, "=", 1).alias("label"),
            F.regexp_extract(x, "=(.*)$", 1).alias("answer"),
        ),
    )
    return t("pages").select("page_id", fields.alias("champs"))


PAGE_PAIRS_SQL = """
    pairs AS (SELECT page_id, list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'),
                                          lambda x: x <> '') AS l FROM pages)
"""


def last_answer_sql(label):
    return (
        f"coalesce(regexp_extract(list_filter(l, lambda x: starts_with(x, '{label}='))[-1],"
        " '=(.*)$', 1), '')"
    )


@check(
    f"""
    WITH {PAGE_PAIRS_SQL}
    SELECT page_id, {last_answer_sql('page')} AS page, {last_answer_sql('ref')} AS ref,
           {last_answer_sql('utm_source')} AS utm_source
    FROM pairs
    """
)
def eav_pivot(spark, t):
    return pivot_fields(
        page_fields(t), "champs", "label", "answer", ["page", "ref", "utm_source"], keep=["page_id"]
    )


@check(
    f"""
    WITH {PAGE_PAIRS_SQL}, labels AS (SELECT page_id, regexp_extract(unnest(l), '^[^=]*', 0) AS champ FROM pairs)
    SELECT DISTINCT page_id, champ FROM labels WHERE champ NOT IN ('page', 'ref')
    """
)
def label_gate(spark, t):
    return unexpected_labels(page_fields(t), "champs", "label", ["page", "ref"], keep=["page_id"])
