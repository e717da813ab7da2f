"""Winnowed fingerprints against plain Python, on a table and on hard rows."""

import hashlib

import pytest
from conftest import SF001
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from strata.llm import winnow
from strata.llm.queries import QUERIES

MASK = (1 << 64) - 1


def brute_hash(chars):
    h = 0
    for c in chars:
        h = (h * winnow.BASE + c) & MASK
    return ((h ^ h >> 32) * winnow.SPREAD & MASK) >> 32


def brute_marks(text, k=winnow.K, window=winnow.WINDOW):
    codes = [ord(c) for c in text]
    if not codes:
        return []
    if len(codes) < k:
        codes += [0] * (k - len(codes))
    h = [brute_hash(codes[i:i + k]) for i in range(len(codes) - k + 1)]
    keyed = [(x, -i) for i, x in enumerate(h)]
    chosen = {-min(keyed[s:s + window])[1] for s in range(max(1, len(h) - window + 1))}
    return [(h[i], i) for i in sorted(chosen)]


def brute_likeness(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def split(counts, hashes, places):
    out, at = [], 0
    for n in counts:
        out.append(list(zip(hashes[at:at + n].tolist(), places[at:at + n].tolist())))
        at += n
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab\0é😀", max_size=60), max_size=6), st.integers(1, 9), st.integers(1, 12))
def test_winnow_equals_brute_force(texts, k, window):
    assert split(*winnow.winnow(texts, k, window)) == [brute_marks(t, k, window) for t in texts]


def test_a_shared_passage_of_the_guaranteed_length_shares_a_mark():
    rnd = "the quick brown fox jumps over a lazy dog while seven wizards quietly mix black potions by moonlight x"
    passage = rnd[:winnow.WINDOW + winnow.K - 1]
    for before in ("", "z" * 7, "other words come first and go on for a while, "):
        a, b = brute_marks(before + passage + " end"), split(*winnow.winnow([passage + "!" * 90]))[0]
        assert {h for h, _ in a} & {h for h, _ in b}


def test_long_texts_and_batches_agree():
    texts = ["a" * 700_000, "", "short", "xy" * 200_000 + "tail", "b"]
    alone = [split(*winnow.winnow([t]))[0] for t in texts]
    assert split(*winnow.winnow(texts)) == alone
    assert alone[0][0][1] == winnow.WINDOW - 1 and len(alone[0]) == 700_000 - winnow.K - winnow.WINDOW + 2      # rightmost of equal ones


def test_query(spark):
    docs = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()), reverse=True)
    got = {r.doc_id: r for r in QUERIES["op13_fingerprints"](spark, SF001).collect()}
    assert len(got) == len(docs)
    for (i, text), (_, after) in zip(docs, docs[1:] + docs[:1]):
        third = len(text) // 3
        changed = text[:len(text) - third] + after[:third]
        marks, r = [brute_marks(t) for t in (text, changed, after)], got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert [r.fingerprint, r.edited_fingerprint] == [",".join(f"{h:08x}@{p}" for h, p in m) for m in marks[:2]]
        assert r.near_edited == pytest.approx(brute_likeness(marks[0], marks[1])) and r.near_next == pytest.approx(brute_likeness(marks[0], marks[2]))


def test_hard_rows(spark):
    rows = [(5, "five"), (5, "five"), (5, "another five"), (None, "no id"), (None, None), (9, ""), (7, None), (-3, "日本語 text " * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("clash")).withColumn("h", F.lit("clash")).withColumn("part", F.lit(1))
    full = winnow.with_next(docs)
    for r in full.collect():
        assert [tuple(m) for m in r.marks] == brute_marks(r.text or "") and [tuple(m) for m in r.next_marks] == brute_marks(r.next_text or "")
    got = [tuple(r) for r in full.select("id", "text", "next_text").collect()]
    assert sorted(map(repr, ((i, t) for i, t, _ in got))) == sorted(map(repr, rows))
    after = {(i, t): n for i, t, n in got}
    assert after[9, ""] is None                             # the next is 7, whose text is null
    assert after[-3, rows[-1][1]] in ("no id", None)        # null ids come last
    assert sorted(n or "" for n in after.values()).count("") >= 1
    ring = [n for i, _, n in got if i == 5]
    assert sorted(ring) in (sorted([rows[-1][1], "another five", "five"]), sorted([rows[-1][1], "five", "five"]))
    assert winnow.with_next(docs.limit(0)).count() == 0
    one = winnow.with_next(docs.where("doc_id = 9").select("doc_id", "text")).collect()
    assert [tuple(r) for r in one] == [(9, "", "", [], [])]
    marks = docs.select("doc_id", "text", winnow.fingerprint(F.col("text")).alias("m")).collect()
    assert all([tuple(m) for m in r.m] == brute_marks(r.text or "") for r in marks)


def test_many_rows_of_one_id_are_spread(spark):
    docs = spark.createDataFrame([(1 if i % 3 else i, f"text {i}") for i in range(3000)], "doc_id long, text string")
    found = winnow.with_next(docs)
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 1000
    ordered = sorted(((r.id, r.text, r.next_text) for r in found.collect()))
    assert sorted(t for _, t, _ in ordered) == sorted(n for _, _, n in ordered)       # one ring through all rows
