"""The corpus pipeline: ``STAGES`` over the documents table, each stage written
as Parquet and read again as the next one's input.

Each stage works on everything its predecessor kept. All but the last return
the columns of ``documents`` (extra columns pass through).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm import decontam, langid, packing, secrets, simhash
from strata.session import materialize

MIN_LANGUAGE_SCORE = 0.5
# Of an item found with other values only: windows that make a document contaminated, as a share or in a row.
MIN_SHARE, MIN_RUN = 0.5, 8


def _as_row(docs: DataFrame) -> DataFrame:
    """The whole row in one column, so that an operator's own names can't clash
    with extra columns; ``row.*`` gives it back as it was."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text", "lang")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a determinable language go: no letters, null, or no
    language at least as likely as all others together. The model is learned
    from all documents that name theirs; where none does, all that have a letter
    stay. Repeated rows are judged alike, columns keep their values, an empty
    table stays empty."""
    rows = _as_row(docs)
    if docs.where("lang is not null and text is not null").isEmpty():
        return rows.where(F.col("text").rlike(r"\p{L}")).select("row.*")
    found = langid.identify(rows, train_on=F.col("lang").isNotNull())
    return found.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group of near copies: the one with the smallest
    doc_id (one without an id only if none has one), of rows with that id the
    smallest by a hash of the text, then of all columns; rows alike in everything
    count once. Two different texts under one id are two documents. Null and
    empty texts are copies of each other. Columns keep their values, an empty
    table stays empty."""
    none = F.col("doc_id").isNull()
    key = F.struct(none.alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("text"))
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("doc_key"), whole.alias("whole"), "text")
    found = simhash.near_duplicates(rows, id_col="doc_key", shingle=4, max_bits=4)
    kept = found.where("doc_key = component_id").select("doc_key").distinct()
    first = rows.select("doc_key", "whole").join(kept, "doc_key").groupBy("doc_key").agg(F.min("whole").alias("whole"))
    return (rows.drop("text").join(materialize(first, "kept-documents"), ["doc_key", "whole"], "left_semi")
            .dropDuplicates(["doc_key", "whole"]).select("row.*"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item with its own values go,
    and those that hold half of its windows, or MIN_RUN in a row, with other
    values; all copies of a text alike. Null and empty texts, and all documents
    where there is no benchmark item, stay; columns keep their values."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = _as_row(docs).select("row", "text", secrets.blob_id(F.col("text")).alias("key"))
    hits = decontam.contamination(rows.select("key", "text"), benchmark, id_col="key", by_window=True)
    hits = materialize(hits.where((F.col("n_own") > 0) | (F.col("share") >= MIN_SHARE) | (F.col("run") >= MIN_RUN)).select("key").distinct(), "contaminated")
    return rows.join(hits, "key", "left_anti").select("row.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark, and ``n_chars`` follows the text; all
    documents stay, null texts null, all other columns as they were. An empty
    table stays empty."""
    found, _ = secrets.find_secrets(_as_row(docs).select("row", "text"))
    text = secrets.redact(F.col("text"), F.col("found.cuts"))
    found = found.select("row", text.alias("text"))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return found.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of sequences of 2048 ids. Null and empty texts are a
    lone end id; rows with a null or repeated id are packed like others; an empty
    table gives no rows."""
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: The stages' models, tokenizer and hashes have no SQL form; tests/llm compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
