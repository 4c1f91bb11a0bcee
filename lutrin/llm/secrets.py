"""Secret scans with multipart credential linking, in DataFrame functions only.

Strong spans are reported wherever they stand. Weak ones (account names, unlabelled long
tokens, addresses of services) are reported only where the parts that complete them lie
within the same scope of a text. The interval join of parts is a range window over their
places in one text: it counts and finds partners without listing pairs.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

# Patterns of the strong kinds (Java syntax; letters of the first in either case).
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# Weak kinds of this library.
ACCOUNT = r"""(?i)\b(?:user(?:name)?|login|account|client_?id|access_?(?:key_?)?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}"""
OPAQUE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]{0,39}[0-9])[A-Za-z0-9+/_=-]{40,}"
ENDPOINT = r"(?i)\b(?:https?|ftp|jdbc:[a-z]+|postgres|mysql|redis|mongodb|amqp|s3)://[^\s\"'<>]+"

KINDS = ("assign", "access", "hex", "account", "opaque", "endpoint")
BASE = KINDS[:3]
PATTERNS = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, ACCOUNT, OPAQUE, ENDPOINT)))

#: Code points between the starts of parts that belong to one credential.
SCOPE = 300

NO_PARTS = "array<struct<kind:int,at:int,gap:int,match:string>>"


def parts_of(text, kind):
    """The matches of one kind: number, code points since the previous match, the match."""
    pattern = F.lit(PATTERNS[KINDS[kind]])
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, PATTERNS[KINDS[kind]], -1)
    found = F.transform(
        F.arrays_zip(matches.alias("match"), F.slice(gaps, 1, F.size(matches)).alias("gap")),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("at"), F.length(x["gap"]).alias("gap"), x["match"].alias("match")
        ),
    )
    return F.when(text.rlike(PATTERNS[KINDS[kind]]), found).otherwise(F.array().cast(NO_PARTS))


def spans(docs, doc_id="doc_id", text="text", scope=SCOPE):
    """One row per row of `docs`: doc_id, text_md5, spans (ordered by start, then kind).

    A span has kind, start, end (code points, end exclusive), strong, and partner: for a weak
    span the start of the nearest part that completes it. A weak account needs a secret
    (assign, hex or opaque) in its scope, an opaque token an identifier (access or account),
    an endpoint one of each; weak spans that overlap strong ones are left to those. Null and
    empty texts have no spans; null and repeated doc_ids are carried as they are, repeated
    rows are scanned each by itself; further columns are ignored; an empty table gives no
    rows. The parts of one text are ordered in one task, with spilling; texts are whole.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    base = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), whole.alias("text")
    )
    # every text also gets a part without a place, so that one shuffle brings all rows
    marker = F.expr("struct(-1 AS kind, 0 AS at, 0 AS gap, '' AS match)")
    exploded = base.select(
        "row",
        "doc_id",
        F.md5(F.encode("text", "UTF-8")).alias("text_md5"),
        F.explode(F.concat(F.array(marker).cast(NO_PARTS), *(parts_of(F.col("text"), k) for k in range(len(KINDS))))).alias("part"),
    ).select("row", "doc_id", "text_md5", "part.*")
    exploded = exploded.repartition("row")
    before = Window.partitionBy("row", "kind").orderBy("at")
    length = F.length("match")
    end = F.sum(F.col("gap") + length).over(before)
    value = F.length(F.regexp_extract("match", ASSIGN, 2))
    placed = exploded.select(
        "row", "doc_id", "text_md5", "kind", (end - length).alias("start"), end.alias("end"), (F.col("kind") < len(BASE)).alias("strong"), value.alias("value")
    ).where((F.col("kind") != 0) | (F.col("value") >= 6))
    placed = placed.withColumn("start", F.when(F.col("kind") >= 0, F.col("start")).otherwise(F.lit(-(10 * scope))))
    kind = F.col("kind")
    strong = (kind >= 0) & F.col("strong")
    left = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    right = Window.partitionBy("row").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, 0)
    near = Window.partitionBy("row").orderBy("start").rangeBetween(-scope, scope)
    earlier = Window.partitionBy("row").orderBy("start").rangeBetween(-scope, 0)
    later = Window.partitionBy("row").orderBy("start").rangeBetween(0, scope)
    free = placed.select(
        "*",
        (
            strong
            | (kind < 0)
            | (
                (F.coalesce(F.max(F.when(strong, F.col("end"))).over(left), F.lit(-1)) <= F.col("start"))
                & (F.coalesce(F.min(F.when(strong, F.col("start"))).over(right), F.lit(1 << 62)) >= F.col("end"))
            )
        ).alias("free"),
    ).where("free")
    secret = kind.isin(0, 2, 4)
    identifier = kind.isin(1, 3)

    def count(what):
        return F.count(F.when(what, 1)).over(near)

    def nearest(what):
        back = F.col("start") - F.max(F.when(what, F.col("start"))).over(earlier)
        ahead = F.min(F.when(what, F.col("start"))).over(later) - F.col("start")
        closer = (ahead.isNull() | (back <= ahead)) & back.isNotNull()
        return F.when(closer, F.col("start") - back).otherwise(F.col("start") + ahead)

    linked = free.select(
        "row", "doc_id", "text_md5", "kind", "start", "end", "strong",
        count(secret).alias("secrets"), count(identifier).alias("identifiers"),
        F.when(kind == 4, nearest(identifier)).when(kind == 3, nearest(secret)).when(kind == 5, nearest(secret)).alias("partner"),
    )
    reported = (
        strong
        | ((kind == 3) & (F.col("secrets") > 0))
        | ((kind == 4) & (F.col("identifiers") > 0))
        | ((kind == 5) & (F.col("secrets") > 0) & (F.col("identifiers") > 0))
    )
    span = F.struct("start", "kind", "end", "strong", "partner")
    found = linked.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("text_md5").alias("text_md5"),
        F.array_sort(F.collect_list(F.when(reported, span))).alias("found"),
    )
    names = F.array(*(F.lit(k) for k in KINDS))
    return found.select(
        "doc_id",
        "text_md5",
        F.transform(
            "found",
            lambda s: F.struct(
                F.get(names, s["kind"]).alias("kind"),
                s["start"].cast("int").alias("start"),
                s["end"].cast("int").alias("end"),
                s["strong"].alias("strong"),
                s["partner"].cast("int").alias("partner"),
            ),
        ).alias("spans"),
    )


def redact(docs, doc_id="doc_id", text="text", mark="[secret]", scope=SCOPE):
    """`docs` with every reported span replaced by `mark`; overlapping spans become one.

    Spans depend on the text alone, so each text that has any is joined once by its hash;
    other texts, null ones among them, stay as they are, and so do all other columns: rows are
    carried in one struct, so that no name of theirs can clash.
    """
    found = spans(docs, doc_id, text, scope).where(F.size("spans") > 0)
    found = found.groupBy("text_md5").agg(F.first("spans").alias("spans"))
    whole = F.col(f"row.`{text}`")
    empty = F.expr("named_struct('text', '', 'done', 0)")

    def step(state, span):
        ahead = F.substring(whole, state["done"] + 1, F.greatest(span["start"] - state["done"], F.lit(0)))
        ahead = F.concat(state["text"], ahead, F.when(span["start"] >= state["done"], F.lit(mark)).otherwise(F.lit("")))
        return F.struct(ahead.alias("text"), F.greatest(span["end"], state["done"]).alias("done"))

    def finish(state):
        return F.concat(state["text"], F.substring(whole, state["done"] + 1, F.length(whole)))

    cleaned = F.when(F.col("spans").isNotNull(), F.aggregate("spans", empty, step, finish)).otherwise(whole)
    packed = docs.select(F.struct("*").alias("row"), F.md5(F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "UTF-8")).alias("text_md5"))
    joined = packed.join(found, "text_md5", "left")
    return joined.select(*((cleaned if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
