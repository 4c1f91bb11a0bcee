import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lutrin.llm import queries

from helpers import base_spans, contaminated, docs_of, near_groups

WORDS = "the and of that with this from have they which there were their would about other into some".split()
FRENCH = "le la les des une est dans pour que qui avec sur pas nous vous mais être après".split()


def corpus():
    rng = random.Random(9)
    prose = lambda words, k: " ".join(rng.choice(words) for _ in range(k))
    texts, langs = [], []
    for i in range(40):
        langs.append("fr" if i % 4 == 0 else "en")
        texts.append(prose(FRENCH if langs[-1] == "fr" else WORDS, rng.randint(20, 80)))
    items = [prose(WORDS, 15), prose(FRENCH, 12)]
    texts += [texts[1], texts[2] + " one more word", texts[3].upper()]  # copies
    texts += [f"{prose(WORDS, 30)} {items[0]} {prose(WORDS, 5)}", f"{prose(FRENCH, 9)} {items[1]}"]
    texts += ["4711 !! 42", "", "password = hunter22 " + prose(WORDS, 30), prose(WORDS, 900)]
    langs += ["en"] * 3 + ["en", "fr"] + ["en"] * 4
    return texts, langs, items


def test_against_brute_force(spark, tmp_path):
    texts, langs, items = corpus()
    docs_of(spark, texts, langs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    kept = [i for i, t in enumerate(texts) if any(c.isalpha() for c in t)]
    _, least = near_groups([texts[i] for i in kept], 5, 80)
    kept = [i for k, i in enumerate(kept) if least[k] == k]
    hits = contaminated([texts[i] for i in kept], items)
    kept = [i for i, (_, hit, _) in zip(kept, hits) if not hit]
    own = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want = {}
    for i in kept:
        text = texts[i]
        for _, a, b in sorted(base_spans(text), key=lambda s: -s[1]):
            text = text[:a] + "[secret]" + text[b:]
        want[i] = len(own.encode(text, add_special_tokens=False).ids) + 1

    got = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want and len(want) < len(texts) - 6


def test_stages_keep_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).dtypes == docs.dtypes


def test_odd_rows(spark, sf_dir):
    text = "the and of that with this from have they which there were"
    docs = docs_of(spark, [(None, text), (None, None), (1, text), (1, text), (2, "other into some there were their would about"), (2, text + " x y")])
    docs = docs.coalesce(1)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), sf_dir).count() == 0
    kept = corpus_pipeline.near_dedup(spark, docs, sf_dir)
    rows = sorted((r.doc_id or -1, r.text or "") for r in kept.collect())
    assert rows[:2] == [(-1, ""), (-1, text)] and rows.count((1, text)) == 1
    assert sum(r[0] == 2 for r in rows) >= 1
    assert sorted(r.doc_id or -1 for r in corpus_pipeline.language(spark, docs, sf_dir).collect()) == [-1, 1, 1, 2, 2]


def test_registered(spark):
    assert sorted(queries.QUERIES) == sorted(
        name for name in queries.QUERIES if name.startswith("op")
    ) and {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_dedup", "decontamination", "secret_scan", "packing"]


@pytest.mark.parametrize("rows", [0, 1_000_000])
def test_dropping_by_broadcast_or_shuffle_is_the_same(spark, monkeypatch, rows):
    monkeypatch.setattr(corpus_pipeline, "BROADCAST_ROWS", rows)
    docs = docs_of(spark, [(None, "a"), (1, "b"), (2, None), (3, "c")])
    dropped = spark.createDataFrame([(None,), (3,)], "doc_id long")
    left = corpus_pipeline.without(docs, dropped, {"doc_id": F.col("doc_id")})
    assert sorted(r.doc_id for r in left.collect()) == [1, 2] and left.columns == docs.columns


def test_no_column_is_lost_or_changed(spark, sf_dir):
    """Whatever they are called."""
    names = "_k _key _l _doc_id _text_md5 _spans row key id k l s spans text_md5 key0 drop0 _rank node bucket a.b".split()
    texts = [(1, "the and of that with this from have they which there were"), (1, "the and of that with this from have they which there were"), (2, "password = hunter22 the and of that with this"), (3, None)]
    docs = docs_of(spark, texts)
    for name in names:
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    for stage_name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, stage_name
        rows = out.collect()
        assert rows and all(r[n] == f"own {n}" for r in rows for n in names), stage_name
    assert corpus_pipeline.packing(spark, docs, sf_dir).count() == 4
