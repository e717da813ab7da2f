"""Runs of periodic words against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from conftest import SF001
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from strata.llm import runs
from strata.llm.queries import QUERIES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, least=runs.LEAST, times=runs.TIMES):
    """Of every maximal stretch with a period, the smallest period."""
    best = {}
    for p in range(1, len(words) // times + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, times * p):
                best.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in best.items())


def brute_collapsed(words, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def brute_changed(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def as_lists(text):
    n, found, left = runs.runs_of([text.encode()])[0]
    return [tuple(r) for r in found.tolist()], left.decode()


def test_cover_brings_every_pair_together():
    cover = set(runs.COVER)
    for a in range(runs.MODULUS):
        for b in range(runs.MODULUS):
            assert any((a + d) % runs.MODULUS in cover and (b + d) % runs.MODULUS in cover for d in range(runs.MODULUS))


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 10 ** 9), st.integers(1, 4), st.integers(2, 400))
def test_extensions_equal_brute_force(seed, letters, n):
    rng = random.Random(seed)
    unit = [rng.randrange(letters) for _ in range(rng.randrange(1, 40))]
    words = np.array([unit[i % len(unit)] if rng.random() < 0.97 else rng.randrange(letters) for i in range(n)] + [-1])
    index = runs.CoverLCE(words)
    a = np.array([rng.randrange(n) for _ in range(200)])
    b = np.array([rng.randrange(x + 1, n + 1) for x in a])

    def common(x, y):
        k = 0
        while y + k <= n and words[x + k] == words[y + k]:
            k += 1
        return k
    assert index.extend(a, b).tolist() == [common(x, y) for x, y in zip(a, b)]


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10 ** 9))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    words = []
    for _ in range(rng.randrange(1, 6)):
        unit = [f"w{rng.randrange(rng.choice((2, 4, 50)))}" for _ in range(rng.randrange(1, 30))]
        words += (unit * 12)[:rng.randrange(1, 140)]
        words += [f"w{rng.randrange(50)}" for _ in range(rng.randrange(0, 20))]
    found, left = as_lists(" ".join(words))
    assert found == brute_runs(words) and left == brute_collapsed(words, found)


def test_texts_of_a_batch_keep_to_themselves():
    texts = ["a b " * 20, "", "a b " * 20, "x", "a " * 23, "a " * 24, "b c d " * 400 + "tail", " \t\n "]
    together = runs.runs_of([t.encode() for t in texts])
    for t, (n, found, left) in zip(texts, together):
        words = WORDS.findall(t)
        assert n == len(words) and [tuple(r) for r in found.tolist()] == brute_runs(words) and left.decode() == brute_collapsed(words, brute_runs(words))


def test_very_long_texts():
    one, left = as_lists("same " * 200_000)
    assert one == [(0, 200_000, 1)] and left == "same"
    unit = [f"u{i}" for i in range(5000)]
    words = ["head"] + unit * 30 + ["tail"]
    found, left = as_lists(" ".join(words))
    assert found == [(1, 150_000, 5000)] and left == " ".join(["head", *unit, "tail"])


def test_query(spark):
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, SF001).collect()}
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        words = brute_changed(d.doc_id, WORDS.findall(d.text or ""))
        found, r = brute_runs(words), got[d.doc_id]
        best = max(found, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapsed(words, found).encode()).hexdigest()
    assert sum(r.n_runs > 0 for r in got.values()) >= len(got) // 20


def test_hard_rows(spark, tmp_path):
    """Null ids and texts, repeated rows, words that only other white space parts, extra columns."""
    rows = [(None, "r s " * 30), (1, None), (2, ""), (2, "z " * 30), (2, "z " * 30), (3, "a b c\x1cd\u0085e " * 30), (4, "ab\v\f\r\n\tab " * 40), (20, "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash")).withColumn("words", F.lit(1)).withColumn("f", F.lit(2))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()
    want = []
    for i, t in rows:
        words = WORDS.findall(t or "")
        words = brute_changed(i, words) if i is not None else words
        found = brute_runs(words)
        want.append((i, len(found), hashlib.sha256(brute_collapsed(words, found).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_runs, r.collapsed_sha256) for r in got), key=str) == sorted(want, key=str)
    docs.limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert QUERIES["op12_periodic_runs"](spark, f"{tmp_path}/empty").count() == 0
