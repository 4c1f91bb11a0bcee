"""The registered queries of this subpackage, and their SQL."""

import public_tokenizers
from pyspark.sql import functions as F

from lutrin.llm.alignment import align_tokens
from lutrin.llm.boilerplate import main_text
from lutrin.llm.common import Scratch
from lutrin.llm.decontamination import decontaminate
from lutrin.llm.language import identify
from lutrin.llm.licences import find_licences
from lutrin.llm.long_repeats import remove_repeats
from lutrin.llm.near_duplicates import near_duplicates
from lutrin.llm.packing import pack
from lutrin.llm.quality import quality_scores
from lutrin.llm.reputation import judge, split_url
from lutrin.llm.secrets import BASE, spans
from lutrin.llm.vector_graph import link_vectors
from lutrin.llm.whitening import whiten

TOKENIZER, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op2_benchmark_decontamination(spark, sf_dir):
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


def op3_embedding_near_dedup(spark, sf_dir):
    return link_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95).drop("recall")  # the SQL knows no recall


def op4_language_id(spark, sf_dir):
    found = identify(table(spark, sf_dir, "documents"), "doc_id", "text", "lang", "source")
    return found.withColumnRenamed("id", "doc_id")


def op5_suffix_array_dedup(spark, sf_dir):
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    columns = [
        F.col("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.octet_length("kept").cast("long").alias("n_kept"),
        F.col("spans").alias("removed"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),  # a character that is cut becomes U+FFFD
    ]
    return remove_repeats(table(spark, sf_dir, "documents"), columns=columns)


def op6_secret_scan(spark, sf_dir):
    found = spans(table(spark, sf_dir, "documents"))

    def listed(column):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in BASE),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op7_html_extraction(spark, sf_dir):
    return main_text(table(spark, sf_dir, "pages"))


def op8_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80).drop("text_md5")


def op9_license_scan(spark, sf_dir):
    found = find_licences(table(spark, sf_dir, "documents"))
    confirmed = F.filter("licences", lambda x: x["confirmed"])
    return found.select(
        "doc_id",
        "n_paragraphs",
        F.size("licences").cast("long").alias("n_licences"),
        F.size(confirmed).cast("long").alias("n_confirmed"),
        F.array_join(F.transform(confirmed, lambda x: F.concat_ws(":", x["place"], x["family"])), ",").alias("licences"),
    )


#: Rules on addresses: verdict, host, path. Fixed values.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def outcomes_of(spark, sf_dir):
    """(host, good) of pages whose article, after its title, is the text of a labelled document.

    Texts are compared with white space as single blanks. A text that is labelled more than
    once is good only if all its labels are: of quality and not toxic.
    """

    def digest(text):
        return F.md5(F.trim(F.regexp_replace(text, r"\s+", " ")))

    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min(((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")).alias("good"))
    texts = table(spark, sf_dir, "documents").where(F.length("text") > 0).select("doc_id", digest(F.col("text")).alias("digest"))
    texts = texts.join(labels, "doc_id").groupBy("digest").agg(F.min("good").alias("good"))
    pages = main_text(table(spark, sf_dir, "pages"))
    body = F.substring("text", F.instr("text", "\n") + 1, F.length("text"))
    pages = pages.where(F.instr("text", "\n") > 0).select(split_url(F.col("url"))[0].alias("host"), digest(body).alias("digest"))
    return Scratch(spark, "outcomes").save(pages.join(texts, "digest").select("host", "good"), "outcomes")


def op10_url_filter(spark, sf_dir):
    return judge(table(spark, sf_dir, "pages"), outcomes_of(spark, sf_dir), RULES, inherit=True)


def op11_embedding_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"), components=32)


def op12_cross_tokenizer_alignment(spark, sf_dir):
    return align_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES))


def op13_quality_classifier(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_benchmark_decontamination,
        op3_embedding_near_dedup,
        op4_language_id,
        op5_suffix_array_dedup,
        op6_secret_scan,
        op7_html_extraction,
        op8_minhash_near_dedup,
        op9_license_scan,
        op10_url_filter,
        op11_embedding_whitening,
        op12_cross_tokenizer_alignment,
        op13_quality_classifier,
    )
}


def lowered(column):
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"translate(coalesce({column}, ''), '{upper}', '{upper.lower()}')"


OP2_WORDS = f"regexp_extract_all({lowered('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP8_WORDS = f"regexp_extract_all({lowered('text')}, '[^\\x20\\x09-\\x0D]+')"

#: The smallest identifier that links reach; `l` holds links both ways, `v` all identifiers.
REACH = """
    reach(id, other) AS (SELECT id, id FROM v UNION SELECT r.id, l.b FROM reach r JOIN l ON r.other = l.a)
"""

SQL = {
    "op2_benchmark_decontamination": f"""
        WITH s AS (SELECT item_id, {OP2_WORDS} AS w FROM benchmark),
        k AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS key
              FROM s, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(i) WHERE len(w) > 0),
        d AS (SELECT row_number() OVER () AS r, doc_id, {OP2_WORDS} AS w FROM documents),
        sizes AS (SELECT DISTINCT n FROM k),
        x AS (SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS key
              FROM d, sizes, unnest(range(1, len(w) - n + 2)) t(i)),
        hit AS (SELECT DISTINCT r, x.n, i, item_id FROM x JOIN k ON x.n = k.n AND x.key = k.key),
        places AS (SELECT r, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + n)) u(p) GROUP BY r),
        found AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN places USING (r) LEFT JOIN found USING (r)
    """,
    "op3_embedding_near_dedup": f"""
        WITH RECURSIVE e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
        v AS (SELECT id FROM e),
        l AS (SELECT p.id AS a, q.id AS b FROM e p, e q WHERE p.id <> q.id AND list_cosine_similarity(p.x, q.x) >= 0.95),
        {REACH}
        SELECT id AS vec_id, (SELECT count(*) FROM l WHERE a = id) AS n_links, min(other) AS component_id,
               min(other) = id AS kept
        FROM reach GROUP BY id
    """,
    "op8_minhash_near_dedup": f"""
        WITH RECURSIVE d AS (SELECT doc_id AS id, {OP8_WORDS} AS w FROM documents),
        v AS (SELECT id FROM d),
        s AS (SELECT DISTINCT id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS shingle
              FROM d, unnest(range(1, greatest(len(w), 2))) t(i) WHERE len(w) > 0),
        n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
        t AS (SELECT * FROM s JOIN n USING (id)),
        pairs AS (SELECT p.id AS a, q.id AS b, p.n + q.n AS total, count(*) AS shared FROM t p JOIN t q
                   ON p.shingle = q.shingle AND p.id < q.id AND 100 * least(p.n, q.n) >= 80 * greatest(p.n, q.n)
                 GROUP BY ALL),
        near AS (SELECT a, b FROM pairs WHERE 100 * shared >= 80 * (total - shared)),
        l AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
        {REACH}
        SELECT id AS doc_id, coalesce(n, 0) AS n_shingles, min(other) AS component_id, min(other) = id AS kept
        FROM reach LEFT JOIN n USING (id) GROUP BY id, n
    """,
}
