"""Whole ways through files: the given tables written as landed files or a warehouse, and read back.

All files lie in the folder that driver and executors share (`spark.checkpoint.dir`); a local
session without one takes a temporary folder.
"""

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.plans import DOORS, synonyms
from checks.registry import SALTS, check, term_sql, values_sql
from checks.sources import lines_of
from lutrin import values as V
from lutrin.operators.gates import GateFailure
from lutrin.plans.daily import Run, run_daily
from lutrin.plans.lookup_tables import Lookups
from lutrin.plans.people import refresh_stats, write_people
from lutrin.schemas import PEOPLE, conform
from lutrin.sources.daily_files import stale_files
from lutrin.sources.delimited import load_lookup, load_staging, read_delimited, write_delimited
from lutrin.sources.fixed_width import file_order, read_students
from lutrin.sources.json_pages import read_pages
from lutrin.sources.page_source import load_pages
from lutrin.warehouse import Warehouse

_folders = []


def folder(spark):
    """A new folder that all tasks reach."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            if not _folders:
                _folders.append(tempfile.mkdtemp(prefix="lutrin-checks-"))
                atexit.register(shutil.rmtree, _folders[0], ignore_errors=True)
            root = _folders[0]
        else:
            root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checks"
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


# ---- files


@check("SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents")
def quoted_files(spark, t):
    """Texts with line breaks, written as delimited text and read by many tasks a file."""
    path = folder(spark)
    write_delimited(t("documents").select("doc_id", "source", "text"), path, sep=";")
    return read_delimited(spark, path, ["doc_id", "source", "text"], sep=";", multiline="split")


@check("SELECT CAST(p_partkey AS VARCHAR) AS cle, p_name AS nom, p_type AS genre, CAST(p_size AS INTEGER) AS taille FROM part")
def tab_files(spark, t):
    path = folder(spark)
    write_delimited(t("part").select("p_partkey", "p_name", "p_type", "p_size"), path, sep="\t")
    return read_delimited(spark, path, ["cle", "nom", "genre", "taille"], {"taille": T.IntegerType()}, sep="\t")


@check(
    """
    SELECT 'b' || c_custkey AS codebarres, substr(c_mktsegment, 1, 5) AS "codeCycle", CAST(c_nationkey AS VARCHAR) AS "codeProgramme",
           c_mktsegment AS programme, 'u' || c_custkey || '@example.org' AS courriel, c_name AS login
    FROM customer
    """
)
def packed_student_files(spark, t):
    """Fixed-width files that are packed, read by their extension."""
    path = folder(spark)
    lines = lines_of(
        t("customer"),
        V.STUDENT_LAYOUT,
        {
            "codebarres": "'b' || c_custkey",
            "codeCycle": "substr(c_mktsegment, 1, 5)",
            "codeProgramme": "CAST(c_nationkey AS STRING)",
            "programme": "c_mktsegment",
            "courriel": "'u' || c_custkey || '@example.org'",
            "login": "c_name",
        },
    )
    lines.write.option("compression", "gzip").text(path)
    return read_students(spark, f"{path}/*.gz").drop("fichier", "id")


@check(
    """
    SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'N' || n_nationkey ELSE '' END AS code,
           CASE WHEN n_nationkey % 3 = 0 THEN n_name END AS nom, r_name AS discipline
    FROM nation JOIN region ON n_regionkey = r_regionkey
    """
)
def lookup_files(spark, t):
    """A lookup as a file: blanks that mean missing, and blanks that stay."""
    path = folder(spark)
    rows = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "CASE WHEN n_nationkey % 2 = 0 THEN 'N' || n_nationkey ELSE '' END AS code",
        "CASE WHEN n_nationkey % 3 = 0 THEN n_name ELSE '' END AS nom",
        "r_name AS discipline",
    )
    write_delimited(rows, path, sep=";")
    return load_lookup(spark, "programmes", path)


@check(
    """
    SELECT substr(p_brand, 7, 2) AS "CodeUnite", p_type AS "DescUnite", substr(p_type, 1, 1) AS "Statut", 'u' || p_partkey AS "Courriel",
           'b' || p_partkey AS "CodeBarres", p_name AS "Fonction", CAST(p_partkey AS VARCHAR) AS "Login", '2024-01-09' AS journee
    FROM part
    """
)
def staged_staff_files(spark, t):
    """Staff from delimited files into staging, with the load day; staging of another table is removed beside it."""
    path = folder(spark)
    staff = t("part").selectExpr("substr(p_brand, 7, 2)", "p_type", "substr(p_type, 1, 1)", "'u' || p_partkey", "'b' || p_partkey", "p_name", "p_partkey")
    write_delimited(staff, path, sep=",")
    warehouse = Warehouse(spark, folder(spark))
    rows = load_staging(spark, "_tmp_personnel", path, "2024-01-09")
    warehouse.stage("_tmp_etudiants", rows.limit(0))
    warehouse.stage("_tmp_personnel", rows)
    staged = warehouse.stage("_tmp_personnel", rows)  # replaced, not added
    warehouse.clear_staging("_tmp_etudiants")
    left = warehouse.manifests.files.names(warehouse.staging_path("_tmp_etudiants"))
    return staged.drop("id").withColumn("journee", F.col("journee").cast("string")).filter(F.lit(not left))


@check("SELECT n_name AS nom FROM nation")
def stale_files_found(spark, t):
    """Files not written on the expected day: one for each nation, all written now."""
    path = folder(spark)
    t("nation").select(F.col("n_name").alias("nom"), F.col("n_regionkey").cast("string")).repartition(1).write.partitionBy("nom").text(path)
    found = stale_files(spark, [path], "2001-01-01").filter(F.col("path").endswith(".txt"))
    return found.select(F.url_decode(F.regexp_extract("path", "nom=([^/]*)/", 1)).alias("nom")).distinct()


#: Pages of a landed file: a file takes longer to open than its pages to read. A power of two, see below.
PAGES = 256


def landed_pages(spark, rows, one):
    """The folder of landed files with a page for each conversation, records `one` under `events`; a file is an array of pages."""
    path = folder(spark)
    pages = rows.groupBy("conv_id").agg(F.to_json(F.struct(F.collect_list(one).alias("events"))).alias("value"))
    # neighbours in a task; its first number is a multiple of PAGES
    near = F.floor(F.monotonically_increasing_id() / PAGES)
    files = pages.select("value", near.alias("file")).groupBy("file").agg(F.collect_list("value").alias("pages"))
    files = files.select(F.concat(F.lit("["), F.array_join("pages", ","), F.lit("]")).alias("value"))
    files.write.option("maxRecordsPerFile", 1).text(path)  # a file for each array
    return path


@check("SELECT conv_id, CAST(turn AS VARCHAR) AS id, role AS title FROM conversations")
def page_files(spark, t):
    """Records over many landed pages, each an array under a name."""
    one = F.struct(F.col("turn").cast("string").alias("id"), F.col("role").alias("title"), "conv_id")
    path = landed_pages(spark, t("conversations"), one)
    return read_pages(spark, f"{path}/*.txt", "id string, title string, conv_id long", "events").select("conv_id", "id", "title")


@check("SELECT conv_id, CAST(turn AS VARCHAR) AS id, role AS title FROM conversations")
def page_source_files(spark, t):
    """The same records through the data source of landed pages."""
    one = F.struct("turn", F.col("role").alias("title"), "conv_id")
    path = landed_pages(spark, t("conversations"), one)
    found = load_pages(spark, path, "turn string, title string, conv_id long", "events", page_pattern=r"part-(\d+)")
    return found.select("conv_id", F.col("turn").alias("id"), "title")


@check(
    """
    SELECT o_custkey AS client, o_orderkey AS cle, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS jour, true AS suit
    FROM orders
    """
)
def ordered_files(spark, t):
    """An output that replaces one it was made from, sorted over its files: every row follows the one before it."""
    path = folder(spark)
    names = ["client", "cle", "jour"]
    kinds = {"client": T.LongType(), "cle": T.LongType()}
    write_delimited(t("orders").selectExpr("o_custkey AS client", "o_orderkey AS cle", "date_format(o_orderdate, 'yyyy-MM-dd') AS jour"), path, sep="\t")
    write_delimited(read_delimited(spark, path, names, kinds, sep="\t"), path, sep="\t", order=["client", "cle"])
    lines = spark.read.schema("client long, cle long, jour string").options(sep="\t", header=True).csv(path)
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int").alias("part")
    rows = lines.select(*names, part, file_order().alias("rang"), F.struct("client", "cle").alias("k"))
    # rows follow the one before them in their file, the first of a file the largest of the file before
    ends = rows.groupBy("part").agg(F.max("k").alias("fin"))  # one row for each file
    ends = ends.select(F.lead("part").over(Window.orderBy("part")).alias("part"), "fin").where("part IS NOT NULL")
    rows = rows.withColumn("avant", F.lag("k").over(Window.partitionBy("part").orderBy("rang"))).join(ends, "part", "left")
    return rows.select(*names, F.coalesce(F.col("k") > F.coalesce("avant", "fin"), F.lit(True)).alias("suit"))


# ---- the warehouse

DAYS_SQL = "SELECT CAST(ts AS DATE) AS journee, event_type AS bibliotheque, count(*) AS n FROM events GROUP BY 1, 2"


@check(
    f"""
    WITH d AS ({DAYS_SQL})
    SELECT 'avant' AS etat, CAST(journee AS VARCHAR) AS journee, bibliotheque, n AS frequentation FROM d
    UNION ALL
    SELECT 'après', CAST(journee AS VARCHAR), bibliotheque, CASE WHEN day(journee) % 2 = 0 THEN 10 * n ELSE n END FROM d
    WHERE day(journee) <> 5
    """
)
def days_of_two_commits(spark, t):
    """Days of two commits: as the first left them, and after some were replaced and one was removed."""
    warehouse = Warehouse(spark, folder(spark))
    days = t("events").groupBy(F.col("ts").cast("date").alias("journee"), F.col("event_type").alias("bibliotheque"))
    days = conform(days.agg(F.count("*").alias("frequentation")), "frequentation")
    warehouse.write_days("frequentation", days)
    first = warehouse.as_of(warehouse.last_commit())
    even = warehouse.read("frequentation").filter("day(journee) % 2 = 0").withColumn("frequentation", F.col("frequentation") * 10)
    with warehouse.commit():
        warehouse.write_days("frequentation", even)
        for folder_ in warehouse.entries("frequentation"):
            if folder_.endswith("-05"):
                warehouse.drop_day("frequentation", folder_.removeprefix("journee="))

    def read(state, which):
        return state.read("frequentation").select(F.lit(which).alias("etat"), F.col("journee").cast("string"), "bibliotheque", "frequentation")

    return read(first, "avant").union(read(warehouse, "après"))


@check(
    """
    SELECT 'u' || CAST(CASE WHEN c_custkey % 7 = 0 THEN -c_custkey ELSE c_custkey END AS VARCHAR) AS courriel, c_name AS usager,
           CASE WHEN c_custkey % 7 = 0 THEN '2024-01-11' ELSE '2024-01-10' END AS journee, c_mktsegment AS discipline,
           CAST(coalesce(n, 0) AS BIGINT) AS nb
    FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey
    WHERE c_custkey % 5 <> 0 OR c_custkey % 7 = 0
    """
)
def person_buckets(spark, t):
    """Persons in buckets by mail address, after a second delivery that changed some addresses and added the rest, met with orders."""
    warehouse = Warehouse(spark, folder(spark), buckets=8)

    def people(day, mail, which):
        rows = t("customer").filter(which).select(
            F.lit(day).alias("journee"), F.col("c_name").alias("usager"), F.concat(F.lit("u"), F.expr(mail).cast("string")).alias("courriel"),
            F.concat(F.lit("b"), "c_custkey").alias("codebarres"), F.col("c_mktsegment").alias("discipline"),
        )
        return conform(rows, PEOPLE)

    first = people("2024-01-10", "c_custkey", "c_custkey % 5 <> 0")
    write_people(warehouse, warehouse.read_state(PEOPLE), first)
    second = people("2024-01-11", "-c_custkey", "c_custkey % 7 = 0")
    touched = warehouse.buckets_of(PEOPLE, second.select("usager"))
    before = warehouse.read_buckets(PEOPLE, touched)
    after = before.join(second.select("usager"), "usager", "left_anti").select(*second.columns).union(second)
    write_people(warehouse, before, after, touched)
    orders = t("orders").groupBy("o_custkey").agg(F.count("*").alias("nb"))
    by_mail = warehouse.read_state("_clientele_par_courriel").withColumn("_nr", F.abs(F.substring("courriel", 2, 30).cast("long")))
    return by_mail.join(orders, F.col("_nr") == F.col("o_custkey"), "left").select(
        "courriel", "usager", F.col("journee").cast("string"), "discipline", F.coalesce("nb", F.lit(0)).alias("nb")
    )


@check(
    f"""
    WITH d AS (SELECT DISTINCT c_mktsegment AS discipline, 'Lib ' || c_mktsegment AS bibliothecaire FROM customer),
    s AS (SELECT CAST(o_orderdate AS DATE) AS j, o_custkey FROM orders WHERE month(o_orderdate) IN (1, 5, 9) AND day(o_orderdate) = 5)
    SELECT discipline, bibliothecaire, 'Étudiant' AS fonction, CAST(c_nationkey AS VARCHAR) AS niveau,
           CAST({term_sql("j")} AS VARCHAR) AS session, CAST(count(*) AS DOUBLE) AS nb_personnes
    FROM s JOIN customer ON c_custkey = o_custkey JOIN d ON discipline = c_mktsegment GROUP BY ALL
    """
)
def statistics_by_snapshot(spark, t):
    """Term statistics that are added up from counts per snapshot, one snapshot after the others."""
    warehouse = Warehouse(spark, folder(spark))
    day = F.col("o_orderdate").cast("date")
    people = t("orders").filter("month(o_orderdate) IN (1, 5, 9) AND day(o_orderdate) = 5").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    people = people.select(
        day.alias("journee"), F.concat(F.lit("u"), "o_orderkey").alias("usager"), F.lit("Étudiant").alias("fonction"),
        F.col("c_nationkey").cast("string").alias("niveau"), F.expr(term_of("CAST(o_orderdate AS DATE)")).cast("string").alias("session"),
        F.col("c_mktsegment").alias("discipline"),
    )
    disciplines = t("customer").select(F.col("c_mktsegment").alias("discipline")).distinct()
    disciplines = conform(disciplines.withColumn("bibliothecaire", F.concat(F.lit("Lib "), "discipline")), "disciplines")
    rows = conform(people, "clientele")
    warehouse.write_days("clientele", rows.filter("year(journee) < 1998"))
    refresh_stats(warehouse, disciplines, [])
    late = rows.filter("year(journee) >= 1998")
    warehouse.write_days("clientele", late)
    refresh_stats(warehouse, disciplines, [])
    columns = ["discipline", "bibliothecaire", "fonction", "niveau", "session"]
    return warehouse.read("disciplines_stats").select(*columns, F.col("nb_personnes").cast("double"))


def term_of(day):
    return f"make_date(year({day}), CASE WHEN month({day}) >= 9 THEN 9 WHEN month({day}) >= 5 THEN 5 ELSE 1 END, 1)"


@check(
    f"""
    WITH s AS (SELECT * FROM ({values_sql(DOORS)}) v(domaine, rejeter, accepter) WHERE domaine = 'Fréquentation'),
    named AS (SELECT CAST(ts AS DATE) AS journee, accepter AS bibliotheque, user_id, CAST(floor(value) AS BIGINT) AS v
              FROM events JOIN s ON event_type = rejeter)
    SELECT CAST(journee AS VARCHAR) AS journee, CAST({term_sql("journee")} AS VARCHAR) AS session, bibliotheque,
           CAST(sum(user_id) AS BIGINT) AS frequentation, CAST(sum(v) AS BIGINT) // 4 AS occupation
    FROM named GROUP BY journee, bibliotheque
    """
)
def daily_traffic(spark, t):
    """A daily run of one domain into a warehouse, twice; domains without inputs are left out."""
    warehouse = Warehouse(spark, folder(spark))
    names = synonyms(spark, DOORS).filter("domaine = 'Fréquentation'")
    events = t("events").join(F.broadcast(names.select(F.col("rejeter").alias("event_type"))), "event_type", "left_semi")
    entries = events.select("event_id", "event_type", "ts", F.col("user_id").cast("int"))
    occupancy = events.select("event_id", "event_type", "ts", F.floor("value").cast("int"))
    none = spark.createDataFrame([], "x string")
    run = Run(warehouse, {"entries": entries, "occupancy": occupancy}, Lookups(none, none, none, none, names, none, none), SALTS)
    for _ in range(2):
        results = run_daily(run)
        if list(results) != ["traffic"] or not results["traffic"].done:
            raise RuntimeError(str(results))
    rows = warehouse.read("frequentation")
    return rows.select(F.col("journee").cast("string"), F.col("session").cast("string"), "bibliotheque", "frequentation", "occupation")


#: Queries whose way runs through Python tasks, and why: lines of text become records by a state that runs through a file;
#: a data source of pages is read by Python.
PYTHON = {"quoted_files", "page_source_files"}


YEAR_OF_LOAN = "make_timestamp(year(o_orderdate), 1, 1, 12, 0, 0)"


@check(
    """
    SELECT o_orderpriority AS cb_document, CAST(o_custkey AS VARCHAR) AS cb_usager, CAST(year(o_orderdate) AS INTEGER) AS annee,
           count(*) AS nb, 0 AS publies
    FROM orders GROUP BY ALL HAVING count(*) > 1
    """
)
def fact_key_report(spark, t):
    """Loans with repeated keys are written, found by the gate and not published; its report is read back."""
    warehouse = Warehouse(spark, folder(spark))
    rows = t("orders").selectExpr(
        "o_orderpriority AS cb_document", "CAST(o_custkey AS STRING) AS cb_usager",
        f"{YEAR_OF_LOAN} AS dateheure", f"CAST({YEAR_OF_LOAN} AS DATE) AS journee",
    )
    report = None
    try:
        warehouse.write_days("emprunts", conform(rows, "emprunts"))
    except GateFailure as failure:
        (report,) = [r.report for r in failure.results if r.name == "emprunts: key"]
    schema = "cb_document string, cb_usager string, dateheure string, nb long"
    found = spark.read.option("sep", "\t").option("header", True).schema(schema).csv(report) if report else spark.createDataFrame([], schema)
    return found.select("cb_document", "cb_usager", F.substring("dateheure", 1, 4).cast("int").alias("annee"), "nb", F.lit(len(warehouse.entries("emprunts"))).alias("publies"))


@check(
    f"""
    SELECT o_orderpriority AS cb_document, CAST(o_custkey AS VARCHAR) AS cb_usager, min(CAST({YEAR_OF_LOAN} AS DATE)) AS journee
    FROM orders GROUP BY o_orderpriority, o_custkey, year(o_orderdate)
    """
)
def fact_days_published(spark, t):
    """The same loans with one row a key pass the gates and are published by day."""
    warehouse = Warehouse(spark, folder(spark))
    rows = t("orders").selectExpr(
        "o_orderpriority AS cb_document", "CAST(o_custkey AS STRING) AS cb_usager",
        f"{YEAR_OF_LOAN} AS dateheure", f"CAST({YEAR_OF_LOAN} AS DATE) AS journee",
    )
    warehouse.write_days("emprunts", conform(rows.distinct(), "emprunts"))
    return warehouse.read("emprunts").select("cb_document", "cb_usager", "journee")
