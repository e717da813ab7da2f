"""The corpus pipeline, stage by stage, and runs with failing tasks."""

import re

import public_tokenizers
import pytest
from conftest import SF001
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from strata.llm import decontam, secrets
from test_operators import brute_components, brute_fingerprint, brute_secrets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_on_the_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "decontamination", "secrets", "packing"]
    stage = dict(corpus_pipeline.STAGES)
    named = stage["language"](spark, docs, SF001)
    assert named.columns == docs.columns and named.count() == docs.count()      # all have a language

    text = {r.doc_id: r.text for r in docs.collect()}
    component = brute_components({i: brute_fingerprint(t) for i, t in text.items()})
    unique = stage["near_duplicates"](spark, named, SF001)
    assert sorted(r.doc_id for r in unique.collect()) == sorted(set(component.values())) and unique.columns == docs.columns

    clean = stage["decontamination"](spark, unique, SF001)
    hit = {r.doc_id for r in decontam.contamination(unique, spark.read.parquet(f"{SF001}/benchmark.parquet")).collect()}
    assert hit and {r.doc_id for r in clean.collect()} == {r.doc_id for r in unique.collect()} - hit

    safe = stage["secrets"](spark, clean, SF001)
    assert safe.columns == docs.columns and safe.count() == clean.count()
    for r in safe.collect():
        assert r.n_chars == len(r.text) and not brute_secrets(r.text)
        assert ("[secret]" in r.text) == (re.sub("x", "x", text[r.doc_id]) != r.text)

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sum(len(t.encode(r.text, add_special_tokens=False).ids) + 1 for r in safe.collect())
    packed = corpus_pipeline.run(spark, SF001)
    assert packed.agg(F.sum("length")).first()[0] == want
    assert packed.groupBy("doc_id").agg((F.sum("length") - F.max("doc_tokens")).alias("d")).where("d <> 0").count() == 0


def test_decontamination_keeps_a_sentence_with_other_values(spark, tmp_path):
    tail = " and there the young painter learned how to mix every colour that people of the region knew"
    item = "the artist Anna Weber was born in 1901 in Bremen" + tail
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    other = "the artist Paul Klein was born in 1950 in Kiel"
    texts = [other + " but he left", item, other + tail, "the artist Anna Weber was born in 1901 in Bremen but she left"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA)
    assert [r.doc_id for r in corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).collect()] == [0]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_hard_rows(spark, name):
    rows = [(1, "a plain little text about nothing", "en", "s", 5), (1, "a plain little text about nothing", "en", "s", 5),
            (2, None, None, None, None), (3, "", "en", "s", 0), (None, "without an id token=abcdef1", "en", "s", 5), (4, "123", None, "s", 3)]
    extra = ["found", "score", "_blob", "_found", "_key", "key", "row", "lang_pred", "doc_key", "whole", "component_id", "fp", "id"]
    docs = spark.createDataFrame(rows, SCHEMA)
    for i, c in enumerate(extra):
        docs = docs.withColumn(c, F.lit(i))
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, docs, SF001)
    # Null, empty and "123" have one fingerprint: no word, or a single one that is its own.
    kept = {"language": 3, "near_duplicates": 4, "decontamination": 6, "secrets": 6, "packing": 6}[name]
    assert out.count() == kept
    if name != "packing":
        assert out.columns == docs.columns
        assert {tuple(r) for r in out.select(*extra).collect()} == {tuple(range(len(extra)))}
        if name != "secrets":
            assert {tuple(r) for r in out.collect()} <= {tuple(r) for r in docs.collect()}
    empty = stage(spark, docs.limit(0), SF001)
    assert empty.count() == 0


def test_ledger_is_content_addressed(spark):
    same = spark.createDataFrame([("x",), ("x",), (None,), ("",)], "text string").select(secrets.blob_id(F.col("text")).alias("b"))
    assert same.distinct().count() == 2


def test_near_duplicates_keep_different_texts_of_one_id(spark):
    a, b = "one text about rivers and the boats on them all day long", "quite another text that tells of mountains snow and goats"
    rows = [(1, a, "en", "s", 1), (1, b, "en", "s", 2), (1, b, "de", "s", 3), (2, a, "en", "s", 4), (None, a, "en", "s", 5), (None, b + " again", "en", "s", 6),
            (None, "neither of the two nor like any of them at all", "en", "s", 7), (None, "neither of the two nor like any of them at all", "en", "t", 8)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, SF001).collect()]
    texts = sorted(r[1] for r in out)
    component = brute_components({i: brute_fingerprint(r[1]) for i, r in enumerate(rows)})
    assert len(out) == len(set(component.values())) and set(out) <= set(rows)
    assert texts.count(a) == 1 and texts.count(b) == 1 and (1, a, "en", "s", 1) in out
    again = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs.repartition(5), SF001).collect()]
    assert sorted(out, key=str) == sorted(again, key=str)


def test_language_without_any_named_language(spark):
    docs = spark.createDataFrame([(1, "words", None, "s", 5), (2, "123", None, "s", 3), (3, None, None, "s", 0)], SCHEMA)
    assert [r.doc_id for r in corpus_pipeline.language(spark, docs, SF001).collect()] == [1]
