"""Operators against rules written down apart from them, in plain Python."""

import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from conftest import SF001, SF01

import corpus_pipeline
from strata.llm import langid
from strata.llm.queries import QUERIES

MASK = (1 << 32) - 1


def grams(text):
    """Hashed character 1- to 3-grams of the lower-cased text, spaces around and single ones inside."""
    codes = [ord(c) for c in " " + " ".join(text.lower().split()) + " "]
    for i in range(len(codes)):
        h = 0
        for n in (1, 2, 3):
            if i + n > len(codes):
                break
            h = (h ^ codes[i + n - 1]) * 0x9E3779B1 & MASK
            yield (((h ^ h >> 15) * 0x85EBCA77 + n & MASK) >> 7) % langid.FEATURES


def test_language_query_equals_plain_naive_bayes(spark):
    docs = duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF001}/documents.parquet'").fetchall()
    counts, rows = defaultdict(Counter), Counter()
    for i, text, lang in docs:
        if zlib.crc32(str(i).encode()) % 4 != 2 and lang is not None and text is not None:
            counts[lang].update(grams(text))
            rows[lang] += 1
    total = {k: sum(c.values()) + 0.5 * langid.FEATURES for k, c in counts.items()}
    got = {r.doc_id: r for r in QUERIES["op9_language_id"](spark, SF001).collect()}
    for i, text, _ in docs:
        if not any(map(str.isalpha, text or "")):
            assert got[i].lang_pred == "und"
            continue
        held = Counter(grams(text))
        log = {k: math.log(rows[k] / sum(rows.values())) + sum(n * math.log((counts[k][g] + 0.5) / total[k]) for g, n in held.items()) for k in counts}
        best = max(sorted(log), key=log.get)
        assert got[i].lang_pred == best
        assert got[i].score == pytest.approx(1 / sum(math.exp(v - log[best]) for v in log.values()), rel=1e-6)


def test_decontamination_drops_what_repeats_eight_words_of_an_item(spark):
    """The given items have no numbers, so a shared stretch of eight words is a window with the item's own values."""
    words = lambda t: re.findall(r"\w+", (t or "").lower())
    windows = set()
    for (text,) in duckdb.sql(f"SELECT text FROM '{SF01}/benchmark.parquet'").fetchall():
        w = words(text)
        windows |= {tuple(w[i:i + 8]) for i in range(len(w) - 7)}
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF01}/documents.parquet'").fetchall()
    hit = {i for i, t in docs if not windows.isdisjoint(tuple(w[k:k + 8]) for w in [words(t)] for k in range(len(w) - 7))}
    kept = corpus_pipeline.decontaminate(spark, spark.read.parquet(f"{SF01}/documents.parquet"), SF01)
    assert hit and {i for i, _ in docs} - {r.doc_id for r in kept.collect()} == hit
