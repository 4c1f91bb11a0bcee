"""Deliveries that add up: a table in two overlapping parts, loaded one after the other, is the whole."""

from pyspark.sql import functions as F

from checks.operators import customer_persons
from checks.plans import (
    PERSONS_SQL,
    ROOMS,
    STUDENT_SQL,
    booking_staging,
    dates_as_text,
    nation_lookups,
    student_staging,
)
from checks.registry import SALTS, SQL, check, pseudonym_sql, term_sql, values_sql
from lutrin.operators.gates import broken_keys
from lutrin.plans import bookings, people, trainings
from lutrin.schemas import empty_table
from lutrin.sources.json_pages import incomplete_pages, tag_event


def in_two(df, first, second):
    """Two deliveries that share rows and together have all."""
    return df.filter(first), df.filter(second)


@check(
    f"""
    WITH {STUDENT_SQL}
    SELECT {pseudonym_sql("c_name")} AS usager, {pseudonym_sql("'u' || c_custkey")} AS courriel,
           {pseudonym_sql("'b' || c_custkey")} AS codebarres, 'Étudiant' AS fonction,
           CASE cycle WHEN '1' THEN 'Étudiant - 1er cycle' WHEN '2' THEN 'Étudiant - 2e cycle'
             WHEN '3' THEN 'Étudiant - 3e cycle' WHEN '4' THEN 'Postdoctorat'
             WHEN 'C' THEN 'Étudiant - Certificat' END AS niveau,
           CAST(c_nationkey AS VARCHAR) AS code_programme, 'N' || c_nationkey AS programme,
           s.discipline, r_name AS bibliotheque, '2024-01-10' AS journee, '2024-01-01' AS session
    FROM student s JOIN nation ON n_name = s.discipline JOIN region ON n_regionkey = r_regionkey
    """
)
def two_deliveries_people(spark, t):
    lookups = nation_lookups(spark, t)
    nobody = empty_table(spark, "_clientele_cumul")
    state = nobody
    for part in in_two(student_staging(t), "codeProgramme <= '3'", "codeProgramme >= '2'"):
        rows = people.build_students(part, lookups, SALTS).rows
        _, state = people.add_day(state, rows, nobody.drop("code_programme", "programme"), "2024-01-10")
    return dates_as_text(state.drop("code_unite", "unite", "clientele"), "journee")


@check(
    f"""
    WITH counts AS (SELECT l_orderkey, count(l_linestatus) AS nb FROM lineitem GROUP BY 1)
    SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS titre,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS journee, CAST({term_sql("o_orderdate")} AS VARCHAR) AS session,
           o_orderstatus AS proprietaire, 'P' || o_custkey AS presentateur, coalesce(nb, 0) AS nb_participants
    FROM orders LEFT JOIN counts ON l_orderkey = o_orderkey
    """
)
def two_deliveries_events(spark, t):
    staging = t("orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderpriority").alias("title"),
        F.col("o_orderdate").alias("start"),
        F.col("o_orderdate").alias("finish"),
        F.col("o_orderstatus").alias("owner"),
        F.expr("'P' || o_custkey").alias("presenter"),
    )
    registrations = t("lineitem").select(
        F.col("l_orderkey").cast("string").alias("event_id"), F.col("l_linestatus").alias("email")
    )
    state = empty_table(spark, "evenements")
    for part in in_two(staging, "owner <> 'F'", "owner <> 'O'"):
        state = trainings.build_events(part, registrations, state).rows
    return dates_as_text(state, "journee", "session")


@check(
    f"""
    WITH {PERSONS_SQL}
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS evenement_id,
           {pseudonym_sql("'u' || o_custkey")} AS courriel, p.usager, p.discipline
    FROM orders LEFT JOIN persons p ON o_custkey = c_custkey
    """
)
def two_deliveries_registrations(spark, t):
    staging = t("orders").select(
        F.col("o_orderkey").cast("string").alias("booking_id"),
        F.col("o_custkey").cast("string").alias("event_id"),
        F.expr("'u' || o_custkey").alias("email"),
        "o_orderstatus",
    )
    state = empty_table(spark, "inscriptions")
    for part in in_two(staging, "o_orderstatus <> 'F'", "o_orderstatus <> 'O'"):
        state = trainings.build_registrations(
            part.drop("o_orderstatus"), customer_persons(t), state, SALTS
        ).rows
    return state


@check(SQL["room_bookings"])
def two_deliveries_bookings(spark, t):
    staging, tables = booking_staging(spark, t)
    state = None
    for part in in_two(staging, "category_name <> 'F'", "category_name <> 'O'"):
        rows = bookings.build_bookings(part, customer_persons(t), tables, SALTS, keyed=True).rows
        state = rows if state is None else bookings.merge_bookings(state, rows)
    return dates_as_text(state.drop(bookings.SOURCE_KEY), "journee", "session")


PAGES_SQL = """
    page AS (SELECT role AS dossier, conv_id + 1 AS page, count(*) AS nb FROM conversations GROUP BY 1, 2),
    seen AS (SELECT *, max(page) OVER (PARTITION BY dossier) AS last,
                    lag(page, 1, 0) OVER (PARTITION BY dossier ORDER BY page) AS before FROM page
             WHERE page % 7 <> 3)
"""


@check(
    f"""
    WITH {PAGES_SQL}
    SELECT dossier, page, page AS jusqua, nb, 'incomplète' AS probleme FROM seen WHERE nb < 3 AND page <> last
    UNION ALL
    SELECT dossier, before + 1, page - 1, NULL, 'manquante' FROM seen WHERE page > before + 1
    """
)
def page_gaps(spark, t):
    """Conversations as pages, one folder per role; some numbers are lost."""
    counts = t("conversations").groupBy(F.col("role").alias("dossier"), (F.col("conv_id") + 1).alias("page"))
    return incomplete_pages(counts.agg(F.count("*").alias("nb")).filter("page % 7 <> 3"), 3)


@check(
    f"""
    WITH s AS (SELECT * FROM ({values_sql(ROOMS)}) v(domaine, rejeter, accepter) WHERE domaine = 'Réservations'),
    kept AS (SELECT * FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT')
    SELECT DISTINCT 'bookings: unknown libraries' AS gate, o_orderpriority AS valeur FROM kept
    WHERE o_orderpriority NOT IN (SELECT rejeter FROM s)
    """
)
def booking_gate_rows(spark, t):
    """All rows of the gates that the bookings plan brings along."""
    staging, tables = booking_staging(spark, t)
    rows = None
    for gate in bookings.build_bookings(staging, customer_persons(t), tables, SALTS).gates:
        found = gate.violations.select(F.lit(gate.name).alias("gate"), F.col(gate.violations.columns[-1]).alias("valeur"))
        rows = found if rows is None else rows.union(found)
    return rows


@check(
    """
    SELECT event_id, coalesce(CASE WHEN user_id % 2 = 0 THEN CAST(user_id AS VARCHAR) END,
                              CASE WHEN event_type <> 'click' THEN CAST(event_id AS VARCHAR) END) AS evenement
    FROM events
    """
)
def event_of_file(spark, t):
    """The event of a registration: from the answer, else from a file name that says so."""
    pages = t("events").select(
        F.col("event_id").alias("nr"),
        F.expr("CASE WHEN user_id % 2 = 0 THEN CAST(user_id AS STRING) END").alias("event_id"),
        F.when(F.col("event_type") == "click", F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(".json")))
        .otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("-event-"), F.col("event_id"), F.lit(".json")))
        .alias("fichier"),
    )
    return tag_event(pages).select(F.col("nr").alias("event_id"), F.col("_event").alias("evenement"))


@check("SELECT max(conv_id) AS version FROM conversations WHERE turn = 1")
def state_version(spark, t):
    """The version that readers of a state choose, over a folder listing made of conversations."""
    names = t("conversations").select(F.concat(F.lit("version="), F.col("conv_id")).alias("name"), (F.col("turn") == 1).alias("done"))
    published = names.where(F.col("done") & F.col("name").rlike(r"^version=[0-9]+$"))
    return published.agg(F.max(F.substring_index("name", "=", -1).cast("long")).alias("version"))


@check(
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS usager, CAST(l_linenumber AS VARCHAR) AS ordinateur, count(*) AS nb
    FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
    UNION ALL
    SELECT CAST(l_orderkey AS VARCHAR), NULL, count(*) FROM lineitem WHERE l_linenumber = 7 GROUP BY 1
    """
)
def final_key_gate(spark, t):
    """The key gate that a state must pass before it is published."""
    rows = t("lineitem").select(F.col("l_orderkey").cast("string").alias("usager"), F.col("l_linenumber").cast("string").alias("ordinateur"))
    lost = rows.filter("ordinateur = '7'").withColumn("ordinateur", F.lit(None).cast("string"))
    return broken_keys(rows.union(lost), ["usager", "ordinateur"])
