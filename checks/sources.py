"""The parsing halves of the scans, on text made of the given tables."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.registry import check
from lutrin import values as V
from lutrin.schemas import TABLES
from lutrin.sources.delimited import normalize_loan_dates, parse_delimited
from lutrin.sources.fixed_width import parse_people
from lutrin.sources.json_pages import unwrap


def lines_of(df, layout, values_):
    """Fixed-width lines with the values in their places, and dots between the fields."""
    parts, at = [], 0
    for name, (start, end) in sorted(layout.items(), key=lambda x: x[1]):
        parts += [F.lit("." * (start - at)), F.rpad(F.expr(values_[name]), end - start, " ")]
        at = end
    return df.select(F.concat(*parts).alias("value"))


@check(
    """
    SELECT 'b' || c_custkey AS codebarres, substr(c_mktsegment, 1, 5) AS "codeCycle",
           CAST(c_nationkey AS VARCHAR) AS "codeProgramme", 'Été ' || c_nationkey AS programme,
           'u' || c_custkey || '@example.org' AS courriel, c_name AS login
    FROM customer WHERE c_mktsegment <> 'BUILDING'
    """
)
def student_lines(spark, t):
    lines = lines_of(
        t("customer"),
        V.STUDENT_LAYOUT,
        {
            "codebarres": "' b' || c_custkey",
            "codeCycle": "substr(c_mktsegment, 1, 5)",
            "codeProgramme": "CAST(c_nationkey AS STRING)",
            "programme": "'Été ' || c_nationkey",
            "courriel": "'u' || c_custkey || '@example.org'",
            "login": "CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name ELSE '' END",
        },
    )
    return parse_people(lines, V.STUDENT_LAYOUT, "login")


@check(
    """
    SELECT substr(p_brand, 1, 7) AS "CodeUnite", p_type AS "DescUnite", substr(p_type, 1, 1) AS "Statut",
           'u' || p_partkey AS "Courriel", 'b' || p_partkey AS "CodeBarres", substr(p_name, 1, 30) AS "Fonction",
           CAST(p_partkey AS VARCHAR) AS "Login"
    FROM part WHERE p_size > 5
    """
)
def staff_lines(spark, t):
    lines = lines_of(
        t("part"),
        V.STAFF_LAYOUT,
        {
            "CodeUnite": "substr(p_brand, 1, 7)",
            "DescUnite": "p_type",
            "Statut": "substr(p_type, 1, 1)",
            "Courriel": "'u' || p_partkey",
            "CodeBarres": "'b' || p_partkey",
            "Fonction": "substr(p_name, 1, 30)",
            "Login": "CASE WHEN p_size > 5 THEN CAST(p_partkey AS STRING) ELSE '\t ' END",
        },
    )
    return parse_people(lines, V.STAFF_LAYOUT, "Login")


@check(
    """
    SELECT CAST(event_id AS INTEGER) AS "Enregistrement", event_type || '; "' || event_id || '"' AS "Secteur",
           strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS "Date", CAST(user_id AS INTEGER) AS "Entrees"
    FROM events
    """
)
def delimited_lines(spark, t):
    instant = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    quoted = F.concat(F.lit('"'), F.col("event_type"), F.lit('; ""'), F.col("event_id"), F.lit('"""'))
    lines = t("events").select(F.concat_ws(",", F.col("event_id"), quoted, instant, F.col("user_id")).alias("value"))
    spec = TABLES["_tmp_frequentation"]
    rows = parse_delimited(lines, spec.loaded, {f.name: f.dataType for f in spec.schema.fields}, sep=spec.sep)
    return rows.withColumn("Date", F.date_format("Date", "yyyy-MM-dd HH:mm:ss"))


@check(
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS cb_document, CAST(l_linenumber AS VARCHAR) AS cote,
           l_returnflag AS bibliotheque_pret, CAST(l_suppkey AS VARCHAR) AS cb_usager,
           CASE l_linestatus WHEN 'O' THEN strftime(l_shipdate, '%Y-%m-%d') || ' 08:05:00' END AS date,
           l_linestatus AS bibliotheque_document, l_returnflag AS institution_doc, '' AS institution_usager
    FROM lineitem
    """
)
def loan_lines(spark, t):
    date = F.when(F.col("l_linestatus") == "O", F.date_format("l_shipdate", "d/M/yyyy' 8:5:0'")).otherwise("n/a")
    parts = ["l_orderkey", "l_linenumber", "l_returnflag", "l_suppkey", date, "l_linestatus", "l_returnflag", F.lit("")]
    lines = t("lineitem").select(F.concat_ws("\t", *parts).alias("value"))
    spec = TABLES["_tmp_emprunts"]
    return normalize_loan_dates(parse_delimited(lines, spec.loaded, sep=spec.sep))


@check(
    """
    SELECT conv_id, CAST(turn AS VARCHAR) AS id, role AS title FROM conversations WHERE role <> 'system'
    """
)
def unwrap_payload(spark, t):
    """Turns as records: of users as arrays under a name, of others as the record itself."""
    record = T.StructType.fromDDL("id string, title string")
    turns = t("conversations").filter("role <> 'system'")
    one = F.struct(F.col("turn").alias("id"), F.col("role").alias("title"))
    wrapped = turns.filter("role = 'user'").groupBy("conv_id").agg(F.to_json(F.struct(F.collect_list(one).alias("events"))).alias("value"))
    bare = turns.filter("role <> 'user'").select("conv_id", F.to_json(one).alias("value"))
    empty = turns.select("conv_id", F.lit('{"events": null}').alias("value")).distinct()
    schema = T.StructType([*record.fields, T.StructField("events", T.ArrayType(record))])
    pages = wrapped.union(bare).union(empty).select("conv_id", F.from_json("value", schema).alias("p")).select("conv_id", "p.*")
    return unwrap(pages, record, "events", ["conv_id"])
