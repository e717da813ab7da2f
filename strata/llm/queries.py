"""One registered query per operator, with production parameters, and the
DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm import (decontam, gnat, langid, packing, runs, secrets, simhash, substrings, tokencount, topk, toxicity,
                        urlfilter, winnow)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of 4-word shingles, linked at 4 or fewer differing bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def held_out(modulus: int, remainder: int):
    """crc32 of the decimal doc_id, modulo ``modulus``; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, F.lit(False))


@query("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naive Bayes language of every document, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs.withColumn("held_out", held_out(4, 2)), train_on=~F.col("held_out"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the public 49k word vocabulary."""
    counted = table(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        tokencount.token_count(F.col("text"), public_tokenizers.path("word_bpe_49k.json")).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


@query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 ids of the public 50k byte vocabulary."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


# The rules of the query, and the names whose domains are on its blocklist.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
BLOCKED_NAMES = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
BLOCKED_UNDER = ["example.com", "example.net", "example.org"]


@query("op3_url_filter", f"""
WITH split AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM split),
ruled AS (
    SELECT *, CASE
        WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
    WHEN rule IS NOT NULL OR regexp_matches(host, '(^|\\.)({"|".join(BLOCKED_NAMES)})\\.example\\.(com|net|org)$') THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled""")
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules first, then the blocklist through a Bloom filter cascade over every domain in the table."""
    blocklist = spark.createDataFrame([(f"{n}.{u}",) for n in BLOCKED_NAMES for u in BLOCKED_UNDER], "domain string")
    judged = urlfilter.judge(table(spark, sf_dir, "pages"), URL_RULES, blocklist)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _spans_sql(rule: secrets.Rule, order: int) -> str:
    """The matches of a rule, as the texts between and in them."""
    pattern = "'" + rule.pattern.replace("'", "''") + "'"
    part = f"regexp_extract_all(text, {pattern}, {rule.part})"
    return f"""SELECT rid, {order} AS k, '{rule.kind}' AS kind, string_split_regex(text, {pattern}) AS gaps,
        regexp_extract_all(text, {pattern}) AS whole, list_transform({part}, lambda m: length(m) >= {rule.least}) AS fits
        FROM docs WHERE regexp_matches(text, {"'[0-9a-f]{24}'" if rule.kind == "hex" else pattern})"""


SECRETS_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
hits AS ({" UNION ALL ".join(_spans_sql(r, i) for i, r in enumerate(secrets.BASE_RULES + secrets.MORE_RULES))}),
one AS (SELECT rid, k, kind, gaps, whole, fits, unnest(range(1, len(whole) + 1)) AS i FROM hits),
spans AS (SELECT rid, k, kind, fits[i] AS fits, length(whole[i]) AS n,
                 sum(length(gaps[i]) + length(whole[i])) OVER (PARTITION BY rid, k ORDER BY i) AS stop FROM one),
listed AS (SELECT rid, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
                  string_agg(kind || ':' || (stop - n) || ':' || stop, ',' ORDER BY stop - n, k) FILTER (k < 3) AS base,
                  string_agg(kind || ':' || (stop - n) || ':' || stop, ',' ORDER BY stop - n, k) AS spans
           FROM spans WHERE fits GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (rid)"""


@query("op7_secret_scan", SECRETS_SQL)
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, each distinct text scanned once per rule version."""
    found, _ = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[F.coalesce(f"found.n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
                        F.sha2(secrets.listing(F.col("found.base")), 256).alias("base_sha256"),
                        secrets.listing(F.col("found.spans")).alias("spans"))


@query("op8_substring_dedup", r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id,
                     regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
places AS (SELECT rid, words, unnest(range(1, len(words) - 33)) AS i FROM docs WHERE len(words) >= 35),
windows AS (SELECT rid, i, md5(array_to_string(words[i:i + 34], ' ')) AS w FROM places),
repeats AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS "at" FROM windows SEMI JOIN repeats USING (w)),
each AS (SELECT rid, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS "at" FROM docs),
kept AS (SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY "at") AS text FROM each ANTI JOIN gone USING (rid, "at") GROUP BY rid)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (rid)""")
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words outside every repeated window of 35 words, over all documents."""
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"), window=35)
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_decontamination")
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item, or one with other values in its slots."""
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), by_window=True).drop("n_own", "run")


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out(5, 0))
    classifier, rows = toxicity.train(docs, labels, train_on=~held_out(5, 0))
    scored = rows.select(F.col("id").alias("doc_id"), (~F.col("trains")).alias("held_out"), classifier.score_packed(F.col("x")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op10_top_k", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
           FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS "rank" FROM scored)
SELECT query_id, "rank"::INTEGER AS "rank", vec_id, score FROM ranked WHERE "rank" <= 10""")
def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest integer inner products of every hundredth vector, over all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query("op11_hard_negatives", """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
           FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id AND len(a.v) = len(c.v)),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
pairs AS (SELECT p.*, n.vec_id AS negative_id, n.score AS negative_score FROM positives p JOIN scored n
          ON p.anchor_id = n.anchor_id AND NOT n.same AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score),
ranked AS (SELECT *, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) AS "rank" FROM pairs)
SELECT anchor_id, positive_id, "rank"::INTEGER AS "rank", negative_id, positive_score, negative_score FROM ranked WHERE "rank" <= 10""")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every hundredth vector and each of its five best of one label, the ten hardest of other labels."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return gnat.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


@query("op13_fingerprints")
def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowed fingerprints of every document and of its edited text, which ends as the next document begins."""
    rows = winnow.with_next(table(spark, sf_dir, "documents"))
    rows = rows.select(F.col("id").alias("doc_id"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"), "marks", "next_marks",
                       winnow.edited(F.col("text"), F.col("next_text")).alias("edited"))
    rows = rows.withColumn("edited_marks", winnow.fingerprint(F.col("edited")))
    own, changed, after = (F.col(c) for c in ("marks", "edited_marks", "next_marks"))
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       winnow.listing(own).alias("fingerprint"), winnow.listing(changed).alias("edited_fingerprint"),
                       winnow.likeness(own, changed).alias("near_edited"), winnow.likeness(own, after).alias("near_next"))


def _partly_periodic(docs: DataFrame) -> DataFrame:
    """Every tenth document, by crc32 of its id, repeats a stretch of its words
    from some word on; a null id leaves its text as it is."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    docs = docs.select("doc_id", "text", g.alias("g"),
                       F.when(h % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")).alias("words"))
    n = F.nullif(F.size("words"), F.lit(0))
    docs = docs.withColumn("n", n).withColumn("a", (F.col("g") % F.col("n")).cast("int"))
    docs = docs.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    stretch = F.slice("words", F.col("a") + 1, F.col("p"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    changed = F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), F.flatten(F.array_repeat(stretch, times))), F.lit(1), F.col("n"))
    return docs.select("doc_id", F.when(F.col("n") > 0, F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeating words in every document, a tenth of them made periodic."""
    found = _partly_periodic(table(spark, sf_dir, "documents")).select("doc_id", runs.periodic_runs(F.col("text")).alias("f"))
    best = runs.strongest(F.col("f.runs"))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.concat(F.array_join(F.transform("f.runs", line), "\n"), F.when(F.size("f.runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    found = found.select("doc_id", F.size("f.runs").cast("long").alias("n_runs"), best.alias("best"),
                         F.sha2(listed, 256).alias("runs_sha256"), F.sha2("f.collapsed", 256).alias("collapsed_sha256"))
    return found.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
