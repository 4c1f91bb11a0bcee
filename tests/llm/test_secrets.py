import random

import pytest
from pyspark.sql import functions as F

from lutrin.llm.queries import op6_secret_scan
from lutrin.llm.secrets import redact, spans

from helpers import base_spans, docs_of

KEY = "AKIA" + "Z9" * 10
OPAQUE = "aB3/" * 11


def found(spark, texts, **options):
    rows = spans(docs_of(spark, texts, **options)).collect()
    return {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in rows}


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(2)
    parts = ["token", "TOKEN = ", "password:", "pass", '"api_key": "', "apikey=", "=", ": ", "secret", "x1y2z3", "abc", "ab", '"', "'", "\n", " ", "é\U0001f600"]
    parts += ["AKIA", KEY, "A1", "0123456789abcdef" * 2, "deadbeef", "token=token=abcdef", "token: token: abcdefg", "passwd =='"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(300)] + ["", None, "ſecret=abcdefg", "K" * 20]
    got = found(spark, texts, clashes=True)
    for i, text in enumerate(texts):
        assert [s for s in got[i] if s[0] in ("assign", "access", "hex")] == base_spans(text), text


def test_weak_parts_need_their_complement(spark):
    far = " word" * 100
    texts = [
        OPAQUE,  # alone
        f"{KEY} and {OPAQUE}",
        f"{KEY}{far}{OPAQUE}",  # out of scope
        "user = alice",
        "user = alice password = hunter22",
        "see https://db.example.com/x",
        f"{KEY} https://db.example.com/x token=abcdef99",
        f"https://db.example.com/x {KEY}",  # no secret
    ]
    got = found(spark, texts)
    kinds = [[s[0] for s in got[i]] for i in range(len(texts))]
    assert kinds == [
        [],
        ["access", "opaque"],
        ["access"],
        [],
        ["account", "assign"],
        [],
        ["access", "endpoint", "assign"],
        ["access"],
    ]
    rows = spans(docs_of(spark, texts[1:2])).collect()
    weak = [s for s in rows[0].spans if not s.strong]
    assert [s.partner for s in weak] == [0]


def test_weak_parts_over_strong_ones_are_left_to_those(spark):
    assert [s[0] for s in found(spark, [f"{KEY} secret = {OPAQUE}"])[0]] == ["access", "assign"]


def test_redaction(spark):
    texts = [f"a é password = hunter22 b {KEY} c", "clean", None, "", "token=" + "0123456789abcdef" * 2, "password = hunter22"]
    rows = redact(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert [r.text for r in rows] == ["a é [secret] b [secret] c", "clean", None, "", "[secret]", "[secret]"]
    docs = docs_of(spark, texts, clashes=True)
    assert redact(docs).columns == docs.columns
    assert {r.text_md5 for r in redact(docs).collect()} == {"x"}


def test_ids_and_empty_table(spark):
    rows = spans(docs_of(spark, [(None, "token=abcdef"), (1, "token=abcdef"), (1, "token=abcdef"), (1, "x")])).collect()
    assert sorted((r.doc_id or -1, len(r.spans)) for r in rows) == [(-1, 1), (1, 0), (1, 1), (1, 1)]
    assert spans(docs_of(spark, ["a"]).where("false")).count() == 0


def test_long_text_with_many_parts(spark):
    text = "token=abcdef1 " * 4000
    rows = found(spark, [text])
    assert len(rows[0]) == 4000 and rows[0][-1] == ("assign", 14 * 3999, 14 * 3999 + 13)


def test_no_python_in_the_plan(spark, sf_dir):
    plan = op6_secret_scan(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for name in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"):
        assert name not in plan


@pytest.mark.parametrize("kind", ["assign", "access", "hex"])
def test_query_counts_kinds(spark, sf_dir, kind):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: sum(s[0] == kind for s in base_spans(r.text)) for r in docs}
    got = {r.doc_id: r[f"n_{kind}"] for r in op6_secret_scan(spark, sf_dir).select("doc_id", F.col(f"n_{kind}")).collect()}
    assert got == want
