"""The plans of the domains, on the given tables in the role of staging tables.

Dates are compared as text, shares as rounded doubles.
"""

from pyspark.sql import functions as F

from checks.operators import customer_persons
from checks.registry import (
    SALTS,
    check,
    pseudonym,
    pseudonym_sql,
    term_sql,
    values,
    values_sql,
)
from lutrin.plans import backfill, bookings, computers, loans, lookup_tables, people, trainings
from lutrin.plans import traffic as traffic_plan
from lutrin.schemas import conform
from lutrin.sources.json_pages import flatten_transactions


def dates_as_text(df, *names):
    for name in names:
        df = df.withColumn(name, F.col(name).cast("string"))
    return df


def synonyms(spark, rows):
    return values(spark, rows, ["domaine", "rejeter", "accepter"])


# ---- door counts --------------------------------------------------------------

DOORS = [
    ("Fréquentation", "click", "Droit"),
    ("Fréquentation", "view", "Droit"),
    ("Fréquentation", "purchase", "Musique"),
    ("Fréquentation", "signup", "Parc"),
    ("Fréquentation", "error", "Santé"),
    ("Ordinateurs", "click", "Ailleurs"),
]


@check(
    f"""
    WITH s AS (SELECT * FROM ({values_sql(DOORS)}) v(domaine, rejeter, accepter)
               WHERE domaine = 'Fréquentation'),
    named AS (SELECT CAST(ts AS DATE) AS journee, coalesce(accepter, event_type) AS bibliotheque,
                     user_id, CAST(floor(value) AS BIGINT) AS v
              FROM events LEFT JOIN s ON event_type = rejeter),
    new AS (SELECT journee, bibliotheque, CAST(sum(user_id) AS BIGINT) AS frequentation,
                   CAST(sum(v) AS BIGINT) // 4 AS occupation
            FROM named GROUP BY 1, 2),
    cur AS (SELECT CAST(o_orderdate AS DATE) AS journee, o_orderpriority AS bibliotheque,
                   count(*) AS frequentation, CAST(sum(o_custkey) AS BIGINT) AS occupation
            FROM orders GROUP BY 1, 2),
    old AS (SELECT DISTINCT journee, 'Droit' AS bibliotheque, CAST(-1 AS BIGINT) AS frequentation,
                   CAST(-1 AS BIGINT) AS occupation
            FROM named WHERE journee < DATE '2024-01-10'),
    res AS (SELECT * FROM new UNION ALL SELECT * FROM cur UNION ALL
            SELECT * FROM old WHERE (journee, bibliotheque) NOT IN (SELECT journee, bibliotheque FROM new))
    SELECT CAST(journee AS VARCHAR) AS journee, CAST({term_sql("journee")} AS VARCHAR) AS session,
           bibliotheque, frequentation, occupation
    FROM res
    """
)
def traffic(spark, t):
    events = t("events")
    entries = events.select(
        F.col("event_id").alias("Enregistrement"),
        F.col("event_type").alias("Secteur"),
        F.col("ts").alias("Date"),
        F.col("user_id").cast("int").alias("Entrees"),
    )
    occupancy = events.select(
        F.col("event_id").alias("Enregistrement"),
        F.col("event_type").alias("Secteur"),
        F.col("ts").alias("Date"),
        F.floor("value").cast("int").alias("Occupation"),
    )
    # The current table: other libraries on other days, and stale rows of delivered days.
    others = t("orders").groupBy(
        F.col("o_orderdate").cast("date").alias("journee"), F.col("o_orderpriority").alias("bibliotheque")
    ).agg(F.count("*").alias("frequentation"), F.sum("o_custkey").alias("occupation"))
    stale = (
        events.select(F.col("ts").cast("date").alias("journee"))
        .distinct()
        .filter("journee < date'2024-01-10'")
        .select(
            "journee",
            F.lit("Droit").alias("bibliotheque"),
            F.lit(-1).alias("frequentation"),
            F.lit(-1).alias("occupation"),
        )
    )
    current = conform(others.unionByName(stale), "frequentation")
    built = traffic_plan.build_traffic(entries, occupancy, synonyms(spark, DOORS), current)
    return dates_as_text(built.rows, "journee", "session")


# ---- bookings -----------------------------------------------------------------

ROOMS = [
    ("Réservations", "2-HIGH", "Droit"),
    ("Réservations", "3-MEDIUM", "Musique"),
    ("Réservations", "4-NOT SPECIFIED", "Musique"),
    ("Emprunts", "5-LOW", "Ailleurs"),
]
STATUSES = [("F", True), ("O", True), ("P", False)]

PERSONS_SQL = f"""
    persons AS (SELECT c_custkey, {pseudonym_sql("c_name")} AS usager,
                       CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS discipline
                FROM customer WHERE c_acctbal >= 0)
"""


@check(
    f"""
    WITH {PERSONS_SQL},
    s AS (SELECT * FROM ({values_sql(ROOMS)}) v(domaine, rejeter, accepter) WHERE domaine = 'Réservations'),
    kept AS (SELECT *, CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN ''
                            ELSE 'u' || o_custkey END AS email
             FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT')
    SELECT p.usager, {pseudonym_sql("email")} AS courriel,
           CASE WHEN p.usager IS NULL THEN 'Inconnue' ELSE p.discipline END AS discipline,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS journee,
           CAST({term_sql("o_orderdate")} AS VARCHAR) AS session,
           coalesce(accepter, o_orderpriority) AS bibliotheque, o_orderstatus AS categorie,
           CAST(o_orderkey AS VARCHAR) AS salle
    FROM kept LEFT JOIN s ON o_orderpriority = rejeter
    LEFT JOIN persons p ON CASE WHEN email <> '' THEN o_custkey END = c_custkey
    """
)
def room_bookings(spark, t):
    staging, tables = booking_staging(spark, t)
    built = bookings.build_bookings(staging, customer_persons(t), tables, SALTS)
    return dates_as_text(built.rows, "journee", "session")


def booking_staging(spark, t):
    staging = t("orders").select(
        F.col("o_orderdate").alias("fromDate"),
        F.expr(
            "CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN '' ELSE 'u' || o_custkey END"
        ).alias("email"),
        F.col("o_orderstatus").alias("status"),
        F.expr(
            "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Bibliothèque de test' ELSE o_orderpriority END"
        ).alias("location_name"),
        F.col("o_orderstatus").alias("category_name"),
        F.col("o_orderkey").cast("string").alias("item_name"),
    )
    tables = lookup_tables.Lookups(
        None, None, None, None, synonyms(spark, ROOMS), None, values(spark, STATUSES, ["nom", "conserver"])
    )
    return staging, tables


# ---- training events and registrations ----------------------------------------


@check(
    f"""
    WITH staged AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS titre,
                           CAST(o_orderdate AS DATE) AS journee, o_orderstatus AS proprietaire,
                           CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '1-URGENT' THEN 'Équipe TEST'
                                ELSE 'P' || o_custkey END AS presentateur
                    FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'),
    counts AS (SELECT CAST(l_orderkey AS VARCHAR) AS id,
                      count(CASE WHEN l_returnflag <> 'R' THEN l_linestatus END) AS nb
               FROM lineitem GROUP BY 1),
    src AS (SELECT s.*, coalesce(nb, 0) AS nb FROM staged s LEFT JOIN counts c ON s.id = c.id
            WHERE (presentateur ILIKE '%Test%') IS NOT TRUE),
    cur AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderdate AS DATE) AS journee FROM orders
            WHERE o_orderdate < TIMESTAMP '1998-01-01')
    SELECT coalesce(s.id, c.id) AS id, coalesce(titre, 'ancien') AS titre,
           CAST(coalesce(s.journee, c.journee) AS VARCHAR) AS journee,
           CAST(CASE WHEN s.id IS NULL THEN DATE '1990-01-01' ELSE {term_sql("s.journee")} END AS VARCHAR) AS session,
           CASE WHEN s.id IS NULL THEN 'X' ELSE proprietaire END AS proprietaire,
           CASE WHEN s.id IS NULL THEN 'X' ELSE coalesce(presentateur, proprietaire) END AS presentateur,
           CASE WHEN s.id IS NULL THEN 7 ELSE nb END AS nb_participants
    FROM src s FULL JOIN cur c ON s.id = c.id
    """
)
def training_events(spark, t):
    orders = t("orders")
    staging = orders.filter("o_orderdate >= timestamp_ntz'1996-01-01'").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderpriority").alias("title"),
        F.col("o_orderdate").alias("start"),
        F.col("o_orderdate").alias("finish"),
        F.col("o_orderstatus").alias("owner"),
        F.expr(
            "CASE o_orderpriority WHEN '5-LOW' THEN '' WHEN '1-URGENT' THEN 'Équipe TEST'"
            " ELSE 'P' || o_custkey END"
        ).alias("presenter"),
    )
    registrations = t("lineitem").select(
        F.col("l_orderkey").cast("string").alias("event_id"),
        F.expr("CASE WHEN l_returnflag <> 'R' THEN l_linestatus END").alias("email"),
    )
    current = conform(
        orders.filter("o_orderdate < timestamp_ntz'1998-01-01'").select(
            F.col("o_orderkey").cast("string").alias("id"),
            F.lit("ancien").alias("titre"),
            F.col("o_orderdate").cast("date").alias("journee"),
            F.lit("1990-01-01").cast("date").alias("session"),
            F.lit("X").alias("proprietaire"),
            F.lit("X").alias("presentateur"),
            F.lit(7).alias("nb_participants"),
        ),
        "evenements",
    )
    built = trainings.build_events(staging, registrations, current)
    return dates_as_text(built.rows, "journee", "session")


@check(
    f"""
    WITH {PERSONS_SQL},
    src AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE 'u' || o_custkey END AS email
            FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'),
    cur AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'lié' END AS usager
            FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
    merged AS (SELECT coalesce(s.o_orderkey, c.o_orderkey) AS o_orderkey,
                      coalesce(s.o_custkey, c.o_custkey) AS o_custkey,
                      CASE WHEN s.o_orderkey IS NULL THEN 'v' || c.o_custkey ELSE s.email END AS email,
                      CASE WHEN s.o_orderkey IS NULL THEN c.usager END AS usager,
                      CASE WHEN c.o_orderkey IS NOT NULL THEN 'ancienne' END AS discipline
               FROM src s FULL JOIN cur c ON s.o_orderkey = c.o_orderkey)
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS evenement_id,
           {pseudonym_sql("m.email")} AS courriel,
           CASE WHEN m.usager IS NULL AND p.usager IS NOT NULL THEN p.usager ELSE m.usager END AS usager,
           CASE WHEN m.usager IS NULL AND p.usager IS NOT NULL THEN p.discipline ELSE m.discipline END AS discipline
    FROM merged m LEFT JOIN persons p ON m.email = 'u' || p.c_custkey
    """
)
def training_registrations(spark, t):
    orders = t("orders")
    staging = orders.filter("o_orderdate >= timestamp_ntz'1997-01-01'").select(
        F.col("o_orderkey").cast("string").alias("booking_id"),
        F.col("o_custkey").cast("string").alias("event_id"),
        F.expr("CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE 'u' || o_custkey END").alias("email"),
    )
    current = conform(
        orders.filter("o_orderdate < timestamp_ntz'1999-01-01'").select(
            F.col("o_orderkey").cast("string").alias("id"),
            F.expr("CASE WHEN o_orderstatus = 'F' THEN 'lié' END").alias("usager"),
            pseudonym("'v' || o_custkey").alias("courriel"),
            F.lit("ancienne").alias("discipline"),
            F.col("o_custkey").cast("string").alias("evenement_id"),
        ),
        "inscriptions",
    )
    return trainings.build_registrations(staging, customer_persons(t), current, SALTS).rows


# ---- computer sessions --------------------------------------------------------

STATIONS = [
    ("Ordinateurs", "click", "Droit"),
    ("Ordinateurs", "view", "Musique"),
    ("Ordinateurs", "purchase", "Musique"),
    ("Ordinateurs", "signup", "Parc"),
]


@check(
    f"""
    WITH s AS (SELECT * FROM ({values_sql(STATIONS)}) v(domaine, rejeter, accepter)),
    src AS (SELECT event_id, user_id, ts, event_type, props, CAST(floor(value) AS INTEGER) AS duree
            FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND event_type <> 'error'),
    cur AS (SELECT event_id, user_id, ts, event_type, props FROM events
            WHERE ts < TIMESTAMP '2024-01-16' AND event_type <> 'error'),
    merged AS (SELECT coalesce(n.user_id, c.user_id) AS user_id, coalesce(n.ts, c.ts) AS ts,
                      coalesce(n.event_type, c.event_type) AS lieu, coalesce(n.props, c.props) AS props,
                      coalesce(duree, -1) AS duree,
                      CASE WHEN n.event_id IS NULL AND c.event_type = 'click' THEN 'complet' END AS a,
                      CASE WHEN n.event_id IS NULL THEN 'ancienne' END AS b
               FROM src n FULL JOIN cur c ON n.event_id = c.event_id),
    persons AS (SELECT c_custkey, {pseudonym_sql("'u' || c_custkey")} AS courriel,
                       CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS discipline,
                       n_name AS bibliotheque
                FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal >= 0)
    SELECT {pseudonym_sql("user_id")} AS usager,
           CASE WHEN a IS NULL AND c_custkey IS NOT NULL THEN courriel ELSE a END AS courriel,
           coalesce(CASE WHEN a IS NULL AND c_custkey IS NOT NULL THEN discipline ELSE b END, 'Inconnue') AS discipline,
           CASE WHEN a IS NULL AND c_custkey IS NOT NULL THEN bibliotheque ELSE b END AS bibliotheque,
           CAST({term_sql("ts")} AS VARCHAR) AS session, CAST(CAST(ts AS DATE) AS VARCHAR) AS journee,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS dateheure,
           coalesce(accepter, lieu) AS lieu, props AS ordinateur, duree
    FROM merged LEFT JOIN s ON lieu = rejeter LEFT JOIN persons ON user_id = c_custkey
    """
)
def computer_sessions(spark, t):
    events = t("events")
    place = "CASE WHEN event_type = 'error' THEN 'Salle Tests' ELSE event_type END"
    staging = events.filter("ts >= timestamp_ntz'2024-01-10'").select(
        F.col("event_id").alias("ID"),
        F.expr(place).alias("Secteur"),
        F.col("props").alias("Station"),
        F.col("user_id").cast("string").alias("Utilisateur_Login"),
        F.col("ts").alias("Ouverture_session"),
        F.floor("value").cast("int").alias("Duree"),
    )
    current = conform(
        events.filter("ts < timestamp_ntz'2024-01-16' AND event_type <> 'error'").select(
            pseudonym("user_id").alias("usager"),
            F.expr("CASE WHEN event_type = 'click' THEN 'complet' END").alias("courriel"),
            F.lit("ancienne").alias("discipline"),
            F.lit("ancienne").alias("bibliotheque"),
            F.col("ts").cast("date").alias("journee"),
            F.col("ts").alias("dateheure"),
            F.col("event_type").alias("lieu"),
            F.col("props").alias("ordinateur"),
            F.lit(-1).alias("duree"),
        ),
        "sessions_ordinateurs",
    )
    nations = t("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    persons = t("customer").join(nations, "c_nationkey").filter("c_acctbal >= 0").select(
        F.lit("2024-01-01").cast("date").alias("journee"),
        pseudonym("c_custkey").alias("usager"),
        pseudonym("'u' || c_custkey").alias("courriel"),
        F.expr("CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END").alias("discipline"),
        F.col("n_name").alias("bibliotheque"),
    )
    built = computers.build_computer_sessions(
        staging, persons, synonyms(spark, STATIONS), current, SALTS
    )
    return dates_as_text(built.rows, "journee", "session").withColumn(
        "dateheure", F.substring(F.col("dateheure").cast("string"), 1, 19)
    )


# ---- loans --------------------------------------------------------------------

LIBRARIES = [
    ("Emprunts", "A", "Droit"),
    ("Emprunts", "N", "Musique"),
    ("Emprunts", "O", "Parc"),
    ("Emprunts", "maison", "Université exemple"),
    ("Ordinateurs", "F", "Ailleurs"),
]
LOAN_DATE = "CASE WHEN l_linenumber = 7 THEN '' WHEN l_linestatus = 'O' THEN {iso} ELSE {iso} || '.5' END"


@check(
    f"""
    WITH lines AS (SELECT l_partkey, l_suppkey, l_shipdate, l_returnflag, l_linestatus,
        CASE l_returnflag WHEN 'A' THEN 'Droit' WHEN 'N' THEN 'Musique' ELSE l_returnflag END AS pret,
        CASE WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN 'autre' ELSE 'Université exemple' END AS institution
      FROM lineitem WHERE l_linenumber <> 7),
    named AS (SELECT *,
        CASE WHEN institution = 'autre' THEN 'Bibliothèque extérieure' ELSE pret END AS bibliotheque_pret,
        CASE WHEN institution = 'autre' THEN 'Bibliothèque extérieure' WHEN l_linestatus = 'O' THEN 'Parc'
             ELSE l_linestatus END AS bibliotheque_document
      FROM lines),
    src AS (SELECT DISTINCT l_partkey, l_suppkey, l_shipdate, first(l_returnflag) OVER w AS cote,
        first(bibliotheque_pret) OVER w AS bibliotheque_pret,
        first(bibliotheque_document) OVER w AS bibliotheque_document, first(institution) OVER w AS institution_doc
      FROM named JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal >= 0
      WINDOW w AS (PARTITION BY l_partkey, l_suppkey, l_shipdate
                   ORDER BY l_returnflag, bibliotheque_pret, bibliotheque_document, institution
                   ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
    cur AS (SELECT DISTINCT l_partkey, l_suppkey, l_shipdate FROM lineitem WHERE l_tax = 0),
    res AS (SELECT l_partkey, l_suppkey, l_shipdate, 'ancien' AS cote, 'ancien' AS bibliotheque_pret,
                   'ancien' AS bibliotheque_document, 'ancien' AS institution_doc FROM cur
            UNION ALL SELECT * FROM src s WHERE NOT EXISTS (SELECT 1 FROM cur c
              WHERE c.l_partkey = s.l_partkey AND c.l_suppkey = s.l_suppkey AND c.l_shipdate = s.l_shipdate))
    SELECT CAST(l_partkey AS VARCHAR) AS cb_document, {pseudonym_sql("'b' || l_suppkey")} AS cb_usager,
           CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS journee,
           CAST({term_sql("l_shipdate")} AS VARCHAR) AS session,
           strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS dateheure,
           cote, bibliotheque_pret, bibliotheque_document, institution_doc
    FROM res
    """
)
def circulation_loans(spark, t):
    iso = "(CAST(CAST(l_shipdate AS DATE) AS STRING) || ' 00:00:00')"
    staging = t("lineitem").select(
        F.col("l_partkey").cast("string").alias("cb_document"),
        F.col("l_returnflag").alias("cote"),
        F.col("l_returnflag").alias("bibliotheque_pret"),
        F.expr("'b' || l_suppkey").alias("cb_usager"),
        F.expr(LOAN_DATE.format(iso=iso)).alias("date"),
        F.col("l_linestatus").alias("bibliotheque_document"),
        F.expr(
            "CASE WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN 'autre' ELSE 'maison' END"
        ).alias("institution_doc"),
        F.expr("CASE WHEN l_returnflag = 'A' THEN 'maison' ELSE 'autre' END").alias("institution_usager"),
    )
    persons = t("supplier").filter("s_acctbal >= 0").select(
        F.lit("2024-01-01").cast("date").alias("journee"),
        pseudonym("s_name").alias("usager"),
        pseudonym("s_name").alias("courriel"),
        pseudonym("'b' || s_suppkey").alias("codebarres"),
        F.col("s_nationkey").cast("string").alias("discipline"),
    )
    old = F.lit("ancien")
    current = conform(
        t("lineitem")
        .filter("l_tax = 0")
        .select("l_partkey", "l_suppkey", "l_shipdate")
        .distinct()
        .select(
            F.col("l_partkey").cast("string").alias("cb_document"),
            pseudonym("'b' || l_suppkey").alias("cb_usager"),
            F.col("l_shipdate").alias("dateheure"),
            F.col("l_shipdate").cast("date").alias("journee"),
            old.alias("cote"),
            old.alias("bibliotheque_pret"),
            old.alias("bibliotheque_document"),
            old.alias("institution_doc"),
        ),
        "emprunts",
    )
    built = loans.build_loans(
        staging, persons, synonyms(spark, LIBRARIES), current, "exemple", SALTS
    )
    return built.rows.select(
        "cb_document",
        "cb_usager",
        F.col("journee").cast("string"),
        F.col("session").cast("string"),
        F.date_format("dateheure", "yyyy-MM-dd HH:mm:ss").alias("dateheure"),
        "cote",
        "bibliotheque_pret",
        "bibliotheque_document",
        "institution_doc",
    )


# ---- people -------------------------------------------------------------------

GENERIC = [
    ("MACHINERY", None, "NATION_1"),
    ("BUILDING", None, "NATION_2"),
    ("HOUSEHOLD", None, "NATION_3"),
]


def nation_lookups(spark, t):
    """Lookups made of nations, regions and suppliers: nations are disciplines."""
    nation = t("nation")
    named = nation.select(
        F.explode(F.array(F.lit("AUTOMOBILE"), F.lit("FURNITURE"))).alias("code"),
        F.expr("'N' || n_nationkey").alias("nom"),
        F.col("n_name").alias("discipline"),
    )
    programmes = conform(values(spark, GENERIC, ["code", "nom", "discipline"]), "programmes")
    laval = nation.filter("n_regionkey = 0").select(
        F.col("n_nationkey").cast("string").alias("codeprogramme"), F.col("n_name").alias("discipline")
    )
    disciplines = nation.join(
        t("region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(F.col("n_name").alias("discipline"), F.col("r_name").alias("bibliotheque"))
    units = t("part").select(F.col("p_brand").alias("code")).distinct().select(
        "code", F.regexp_replace("code", "Brand#", "NATION_").alias("discipline")
    )
    cycles = values(spark, [("1",), ("2",), ("3",), ("4",), ("C",)], ["cycle"])
    return lookup_tables.Lookups(
        programmes.unionByName(named), laval, disciplines, units, None, cycles, None
    )


CYCLE = "translate(substr(c_mktsegment, 1, 1), 'MBAFH', '1234C')"
STUDENT_SQL = f"""
    student AS (SELECT c_custkey, c_name, c_mktsegment, c_nationkey, {CYCLE} AS cycle,
        CASE WHEN n_regionkey = 0 THEN n_name WHEN c_mktsegment = 'MACHINERY' THEN 'NATION_1'
             WHEN c_mktsegment = 'BUILDING' THEN 'NATION_2' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'NATION_3'
             ELSE n_name END AS discipline
      FROM customer JOIN nation ON c_nationkey = n_nationkey)
"""


def student_staging(t):
    return t("customer").select(
        F.expr("'b' || c_custkey").alias("codebarres"),
        F.expr(f"{CYCLE} || c_mktsegment").alias("codeCycle"),
        F.col("c_nationkey").cast("string").alias("codeProgramme"),
        F.expr("'N' || c_nationkey").alias("programme"),
        F.expr("'u' || c_custkey").alias("courriel"),
        F.col("c_name").alias("login"),
        F.lit("2024-01-10").cast("date").alias("journee"),
    )


@check(
    f"""
    WITH {STUDENT_SQL}
    SELECT {pseudonym_sql("c_name")} AS usager, {pseudonym_sql("'u' || c_custkey")} AS courriel,
           {pseudonym_sql("'b' || c_custkey")} AS codebarres, 'Étudiant' AS fonction,
           CASE cycle WHEN '1' THEN 'Étudiant - 1er cycle' WHEN '2' THEN 'Étudiant - 2e cycle'
             WHEN '3' THEN 'Étudiant - 3e cycle' WHEN '4' THEN 'Postdoctorat'
             WHEN 'C' THEN 'Étudiant - Certificat' END AS niveau,
           CAST(c_nationkey AS VARCHAR) AS code_programme, s.discipline, r_name AS bibliotheque
    FROM student s JOIN nation ON n_name = s.discipline JOIN region ON n_regionkey = r_regionkey
    """
)
def students(spark, t):
    built = people.build_students(student_staging(t), nation_lookups(spark, t), SALTS)
    return built.rows.drop("journee", "programme", "clientele")


STAFF_STATUS = "translate(substr(p_type, 1, 1), 'EMSPL', 'RCTPQ')"
STAFF_TITLE = (
    "replace(replace(replace(replace(p_name, 'small', 'Professeur'), 'ring', 'clinique'),"
    " 'red', 'Chercheur'), 'hot bolt', 'Chargé(e) de cours')"
)
# Parts of one brand bear the names of customers, who are students.
STAFF_LOGIN = (
    "CASE WHEN p_brand = 'Brand#2' THEN 'Customer#' || lpad(CAST(p_size AS {text}), 9, '0')"
    " ELSE p_name || p_brand END"
)


def staff_staging(t):
    return t("part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_brand").alias("CodeUnite"),
        F.col("p_type").alias("DescUnite"),
        F.expr(STAFF_STATUS).alias("Statut"),
        F.expr("'u' || p_partkey").alias("Courriel"),
        F.expr("'b' || p_partkey").alias("CodeBarres"),
        F.expr(STAFF_TITLE).alias("Fonction"),
        F.expr(STAFF_LOGIN.format(text="STRING")).alias("Login"),
        F.lit("2024-01-10").cast("date").alias("journee"),
    )


@check(
    f"""
    WITH staff AS (SELECT *, {STAFF_STATUS} AS statut, {STAFF_TITLE} AS titre,
                          {STAFF_LOGIN.format(text="VARCHAR")} AS login FROM part),
    one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY login ORDER BY p_partkey DESC) AS r
                           FROM staff WHERE statut NOT IN ('Q', 'X')) WHERE r = 1)
    SELECT {pseudonym_sql("login")} AS usager, {pseudonym_sql("'u' || p_partkey")} AS courriel,
           CASE statut WHEN 'C' THEN 'Chargé de cours' WHEN 'R' THEN 'Professeur' ELSE 'Personnel' END AS fonction,
           CASE statut WHEN 'C' THEN 'Chargé de cours' WHEN 'R' THEN 'Professeur' END AS niveau,
           p_brand AS code_unite, p_type AS unite, replace(p_brand, 'Brand#', 'NATION_') AS discipline,
           r_name AS bibliotheque,
           CASE WHEN statut IN ('P', 'T') THEN 'non'
                WHEN statut = 'C' THEN CASE WHEN titre = 'Chargé(e) de cours' THEN 'oui' ELSE 'non' END
                WHEN titre LIKE 'Chercheur%' OR titre LIKE 'Enseignant%'
                  OR (titre LIKE 'Prof%' AND titre NOT LIKE '%clini%') THEN 'oui' ELSE 'non' END AS clientele
    FROM one LEFT JOIN nation ON n_name = replace(p_brand, 'Brand#', 'NATION_')
    LEFT JOIN region ON n_regionkey = r_regionkey
    WHERE login NOT IN (SELECT c_name FROM customer)
    """
)
def staff(spark, t):
    built = people.build_staff(
        staff_staging(t), student_staging(t), nation_lookups(spark, t), SALTS
    )
    return built.rows.drop("journee", "codebarres").withColumn(
        "clientele", F.when(F.col("clientele"), "oui").otherwise("non")
    )


@check(
    f"""
    WITH st AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS journee, o_custkey AS k FROM orders),
    sf AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS journee, -1 - l_suppkey AS k FROM lineitem),
    cur AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS journee, o_custkey AS k FROM orders
            WHERE o_orderstatus = 'F'
            UNION SELECT DISTINCT DATE '2030-01-01', o_custkey FROM orders WHERE o_orderpriority = '5-LOW' AND o_totalprice > 400000),
    every AS (SELECT journee, k, 'Étudiant' AS fonction, 'x' AS code_programme, NULL AS code_unite FROM st
              UNION ALL SELECT journee, k, 'Personnel', NULL, 'y' FROM sf
              UNION ALL SELECT journee, k, 'Ancien', NULL, 'z' FROM cur
                WHERE (journee, k) NOT IN (SELECT journee, k FROM st)),
    last AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY journee DESC) AS r FROM every)
    SELECT CAST(l.k AS VARCHAR) AS usager, CAST(l.journee AS VARCHAR) AS journee, fonction, code_programme,
           CASE WHEN c.k IS NOT NULL AND fonction <> 'Personnel' THEN 'z' ELSE code_unite END AS code_unite,
           CASE WHEN c.k IS NOT NULL THEN 'gardée' ELSE CAST({term_sql("l.journee")} AS VARCHAR) END AS session
    FROM last l LEFT JOIN cur c ON l.k = c.k AND l.journee = c.journee WHERE r = 1
    """
)
def person_table(spark, t):
    orders = t("orders").select(
        F.col("o_orderdate").cast("date").alias("journee"),
        F.col("o_custkey").cast("string").alias("usager"),
        "o_orderstatus",
        "o_orderpriority",
        "o_totalprice",
    )
    day_rows = orders.select("journee", "usager").distinct()
    new_students = day_rows.withColumn("fonction", F.lit("Étudiant")).withColumn(
        "code_programme", F.lit("x")
    )
    new_staff = (
        t("lineitem")
        .select(
            F.col("l_shipdate").cast("date").alias("journee"),
            (-1 - F.col("l_suppkey")).cast("string").alias("usager"),
        )
        .distinct()
        .withColumn("fonction", F.lit("Personnel"))
        .withColumn("code_unite", F.lit("y"))
    )
    earlier = (
        orders.filter("o_orderstatus = 'F'")
        .select("journee", "usager")
        .union(
            orders.filter("o_orderpriority = '5-LOW' AND o_totalprice > 400000").select(
                F.lit("2030-01-01").cast("date"), "usager"
            )
        )
        .distinct()
        .withColumn("fonction", F.lit("Ancien"))
        .withColumn("code_unite", F.lit("z"))
        .withColumn("session", F.lit("gardée"))
    )
    dim = people.update_person_dim(conform(earlier, "_clientele_cumul"), new_students, new_staff)
    return dim.select(
        "usager", F.col("journee").cast("string"), "fonction", "code_programme", "code_unite", "session"
    )


def audience(t):
    """Customers as people: their nation is the discipline, one segment is staff."""
    nations = t("nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("discipline")
    )
    return t("customer").join(nations, "c_nationkey").select(
        F.lit("2024-01-10").cast("date").alias("journee"),
        F.col("c_name").alias("usager"),
        F.expr("CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Personnel' ELSE 'Étudiant' END").alias("fonction"),
        F.col("c_mktsegment").alias("niveau"),
        F.lit("2024-01-01").alias("session"),
        "discipline",
        F.expr("CASE WHEN c_acctbal >= 0 THEN true WHEN c_acctbal < -500 THEN false END").alias("clientele"),
    )


@check(
    """
    SELECT c_name AS usager, n_name AS discipline, '2024-01-10' AS journee FROM customer
    JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal >= 0
    """
)
def term_snapshot(spark, t):
    snapshot = people.build_snapshot(conform(audience(t), "_clientele_cumul"), "2024-01-10")
    return snapshot.select("usager", "discipline", F.col("journee").cast("string"))


def librarians(t):
    """Suppliers as the librarians of their nation."""
    nations = t("nation").select(
        F.col("n_nationkey").alias("s_nationkey"),
        F.col("n_name").alias("discipline"),
        F.col("n_regionkey").cast("string").alias("bibliotheque"),
    )
    rows = t("supplier").join(nations, "s_nationkey").withColumnRenamed("s_name", "bibliothecaire")
    sectors = t("region").filter("r_name <> 'ASIA'").select(
        F.col("r_regionkey").cast("string").alias("bibliotheque"), F.col("r_name").alias("secteur")
    )
    return lookup_tables.build_disciplines(rows, sectors)


DISCIPLINES_SQL = """
    d AS (SELECT n_name AS discipline, s_name AS bibliothecaire, CAST(n_regionkey AS VARCHAR) AS bibliotheque,
                 CASE WHEN r_name <> 'ASIA' THEN r_name END AS secteur,
                 1.0 / count(*) OVER (PARTITION BY n_name) AS facteur
          FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""


@check(
    f"""
    WITH {DISCIPLINES_SQL}
    SELECT discipline, bibliothecaire, bibliotheque, secteur, CAST(round(facteur, 6) AS DOUBLE) AS facteur FROM d
    """
)
def discipline_table(spark, t):
    return librarians(t).withColumn("facteur", F.round("facteur", 6).cast("double"))


@check(
    f"""
    WITH {DISCIPLINES_SQL}
    SELECT d.discipline, bibliothecaire, bibliotheque, secteur, 'Étudiant' AS fonction,
           c_mktsegment AS niveau, '2024-01-01' AS session,
           CAST(round(count(*) * max(facteur), 6) AS DOUBLE) AS nb_personnes
    FROM d JOIN nation ON n_name = discipline JOIN customer ON c_nationkey = n_nationkey
    WHERE c_mktsegment <> 'MACHINERY' GROUP BY ALL
    """
)
def weighted_stats(spark, t):
    stats = people.discipline_stats(conform(audience(t), "clientele"), librarians(t))
    return stats.withColumn("nb_personnes", F.round("nb_personnes", 6).cast("double"))


BACKFILL_PROGRAMMES = [
    ("F", None, "NATION_1"),
    ("O", None, "NATION_2"),
    ("P", "5-LOW", "NATION_3"),
    ("P", "4-NOT SPECIFIED", "NATION_4"),
    ("P", "3-MEDIUM", "NATION_5"),
    ("P", "2-HIGH", "NATION_6"),
    ("P", "1-URGENT", "NATION_7"),
]
BACKFILL_CYCLE = "translate(substr(o_orderpriority, 1, 1), '5', 'C')"
BACKFILL_SQL = f"""
    st AS (SELECT CAST(o_orderdate AS DATE) AS journee, o_custkey, o_orderstatus, o_orderpriority,
        {BACKFILL_CYCLE} AS cycle,
        CASE WHEN o_orderstatus = 'F' THEN 'NATION_1' WHEN o_orderstatus = 'O' THEN 'NATION_2'
             ELSE 'NATION_' || (8 - CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) END AS discipline FROM orders),
    sf AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS journee, l_suppkey FROM lineitem),
    bad AS (SELECT DISTINCT journee FROM (SELECT journee FROM st GROUP BY journee, o_custkey HAVING count(*) > 1)),
    good AS (SELECT DISTINCT journee FROM st WHERE journee IN (SELECT journee FROM sf)
             AND journee NOT IN (SELECT journee FROM bad)),
    every AS (SELECT journee, 'u' || o_custkey AS login, 'u' || o_custkey AS courriel, 'b' || o_custkey AS cb,
                 'Étudiant' AS fonction,
                 CASE cycle WHEN '1' THEN 'Étudiant - 1er cycle' WHEN '2' THEN 'Étudiant - 2e cycle'
                   WHEN '3' THEN 'Étudiant - 3e cycle' WHEN '4' THEN 'Postdoctorat'
                   WHEN 'C' THEN 'Étudiant - Certificat' END AS niveau,
                 o_orderstatus AS code_programme, o_orderpriority AS programme,
                 NULL AS code_unite, NULL AS unite, discipline, true AS clientele FROM st
              UNION ALL SELECT journee, s_name, s_name, s_name, 'Personnel', NULL, NULL, NULL,
                 'Brand#' || s_nationkey, '', n_name, false
              FROM sf JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON n_nationkey = s_nationkey),
    kept AS (SELECT *, {term_sql("journee")} AS session FROM every WHERE journee IN (SELECT journee FROM good)),
    last AS (SELECT *, row_number() OVER (PARTITION BY login ORDER BY journee DESC) AS r FROM kept)
"""


def backfill_staging(spark, t):
    """Orders stand for the student files of their days, shipments for the staff files."""
    student_rows = t("orders").select(
        F.expr("'b' || o_custkey").alias("codebarres"),
        F.expr(f"{BACKFILL_CYCLE} || o_orderstatus").alias("codeCycle"),
        F.col("o_orderstatus").alias("codeProgramme"),
        F.col("o_orderpriority").alias("programme"),
        F.expr("'u' || o_custkey").alias("courriel"),
        F.expr("'u' || o_custkey").alias("login"),
        F.col("o_orderdate").cast("date").alias("journee"),
    )
    shipments = (
        t("lineitem")
        .select(F.col("l_shipdate").cast("date").alias("journee"), F.col("l_suppkey").alias("s_suppkey"))
        .distinct()
    )
    staff_rows = t("supplier").join(shipments, "s_suppkey").select(
        F.col("s_suppkey").alias("id"),
        F.expr("'Brand#' || s_nationkey").alias("CodeUnite"),
        F.lit("").alias("DescUnite"),
        F.lit("P").alias("Statut"),
        F.col("s_name").alias("Courriel"),
        F.col("s_name").alias("CodeBarres"),
        F.lit("").alias("Fonction"),
        F.col("s_name").alias("Login"),
        "journee",
    )
    base = nation_lookups(spark, t)
    units = t("nation").select(
        F.expr("'Brand#' || n_nationkey").alias("code"), F.col("n_name").alias("discipline")
    )
    programmes = values(spark, BACKFILL_PROGRAMMES, ["code", "nom", "discipline"])
    tables = lookup_tables.Lookups(
        programmes, base.programmes_laval, base.disciplines, units, None, base.cycles, None
    )
    return student_rows, staff_rows, tables


def backfilled(spark, t):
    """The plan as a run calls it: the days to leave out are found first."""
    students_, staff_, tables = backfill_staging(spark, t)
    listed = backfill.days_left_out(students_, staff_, tables, SALTS).collect()  # bounded by the calendar
    nobody = conform(t("customer").filter("false"), "_clientele_cumul")
    days = sorted({r.journee for r in listed})
    return backfill.build_backfill(students_, staff_, tables, SALTS, nobody, days)


@check(
    f"""
    WITH {BACKFILL_SQL}
    SELECT CAST(journee AS VARCHAR) AS journee, {pseudonym_sql("login")} AS usager,
           {pseudonym_sql("courriel")} AS courriel, {pseudonym_sql("cb")} AS codebarres, fonction, niveau,
           CAST(session AS VARCHAR) AS session, code_programme, programme, code_unite, unite,
           last.discipline, r_name AS bibliotheque, CAST(clientele AS VARCHAR) AS clientele
    FROM last JOIN nation ON n_name = last.discipline JOIN region ON n_regionkey = r_regionkey WHERE r = 1
    """
)
def people_backfill(spark, t):
    return dates_as_text(backfilled(spark, t).people, "journee", "clientele")


@check(
    f"""
    WITH {BACKFILL_SQL}
    SELECT CAST(journee AS VARCHAR) AS journee, 'contrôles' AS raison FROM bad
    UNION ALL SELECT DISTINCT CAST(journee AS VARCHAR), 'sans personnel' FROM st
      WHERE journee NOT IN (SELECT journee FROM sf)
    UNION ALL SELECT DISTINCT CAST(journee AS VARCHAR), 'sans étudiants' FROM sf
      WHERE journee NOT IN (SELECT journee FROM st)
    """
)
def backfill_left_out(spark, t):
    students_, staff_, tables = backfill_staging(spark, t)
    return dates_as_text(backfill.days_left_out(students_, staff_, tables, SALTS), "journee")


@check(
    f"""
    WITH {BACKFILL_SQL}, {DISCIPLINES_SQL}
    SELECT d.discipline, bibliothecaire, bibliotheque, secteur, fonction, niveau,
           CAST(k.session AS VARCHAR) AS session,
           CAST(round(count(*) * max(facteur), 6) AS DOUBLE) AS nb_personnes
    FROM d JOIN kept k ON k.discipline = d.discipline WHERE clientele GROUP BY ALL
    """
)
def backfill_stats(spark, t):
    stats = people.discipline_stats(backfilled(spark, t).snapshots, librarians(t))
    return stats.withColumn("nb_personnes", F.round("nb_personnes", 6).cast("double"))


# ---- desk transactions --------------------------------------------------------

PARAMETERS = {"page": "Unités", "ref": "Localisation", "utm_source": "Modalité"}


@check(
    """
    WITH q AS (SELECT page_id, url, string_split(regexp_extract(url, '\\?([^#]*)', 1), '&') AS l FROM pages)
    SELECT CAST(page_id AS VARCHAR) AS transaction_id, url AS created, '' AS owner,
      coalesce(regexp_extract(list_filter(l, lambda x: starts_with(x, 'page='))[-1], '=(.*)$', 1), '') AS unites,
      coalesce(regexp_extract(list_filter(l, lambda x: starts_with(x, 'ref='))[-1], '=(.*)$', 1), '') AS localisation,
      '' AS intervention,
      coalesce(regexp_extract(list_filter(l, lambda x: starts_with(x, 'utm_source='))[-1], '=(.*)$', 1), '') AS modalite
    FROM q
    """
)
def desk_transactions(spark, t):
    pairs = F.split(F.regexp_extract("url", r"\?([^#]*)", 1), "&")

    def label(pair):
        name = F.substring_index(pair, "=", 1)
        known = F.lit(None).cast("string")
        for parameter, wanted in PARAMETERS.items():
            known = F.when(name == parameter, wanted).otherwise(known)
        return known

    fields = F.transform(
        pairs,
        lambda x: F.struct(
            label(x).alias("field_label"), F.regexp_extract(x, "=(.*)$", 1).alias("field_answer")
        ),
    )
    flat = flatten_transactions(
        t("pages").select(
            F.col("page_id").alias("transaction_id"),
            F.col("url").alias("created"),
            F.lit(None).cast("string").alias("owner"),
            fields.alias("custom_fields"),
        )
    )
    return flat.toDF(
        "transaction_id", "created", "owner", "unites", "localisation", "intervention", "modalite"
    )
