"""Run operators while the first attempt of every other task fails, on
local[4,4]; print OK if the results equal a failure-free run. Used by
test_retries_llm.py."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import public_tokenizers  # noqa: E402
from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F, types as T  # noqa: E402

from strata.llm import gnat, langid, packing, runs, secrets, simhash, substrings, topk, toxicity, winnow  # noqa: E402
from strata.session import local_session  # noqa: E402


@F.udf(T.StringType())
def fail_first(text):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        raise RuntimeError("injected task failure")
    return text


def main(sf_dir):
    spark = local_session("4,4", shuffle_partitions=6, app_name="strata-llm-retries")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    path = public_tokenizers.path("byte_bpe_50k.json")
    checks = {
        "simhash": lambda d: simhash.near_duplicates(d),
        "packing": lambda d: packing.pack(d, path, end_id=1),
        "substrings": lambda d: substrings.remove_repeats(d).select("doc_id", "n_words", "removed"),
        "secrets": lambda d: secrets.find_secrets(d)[0].select("doc_id", secrets.listing(F.col("found.spans")).alias("s")),
        "language": lambda d: langid.identify(d, F.col("lang").isNotNull()).select("doc_id", "lang_pred"),
        "runs": lambda d: d.select("doc_id", runs.periodic_runs(F.col("text")).alias("r")),
        "fingerprints": lambda d: winnow.with_next(d).select("id", "next_text", "marks"),
        "toxicity": lambda d: toxicity.train(d, spark.read.parquet(f"{sf_dir}/labels.parquet"))[1],
        "hard_negatives": lambda d: gnat.hard_negatives(vectors.join(d.select(F.col("doc_id").alias("vec_id")), "vec_id"), F.col("vec_id") % 20 == 0),
        "top_k": lambda d: topk.top_k(vectors.join(d.select(F.col("doc_id").alias("vec_id")), "vec_id"), F.col("vec_id") % 100 == 0),
    }
    for name, build in checks.items():
        clean = sorted(map(repr, build(docs.repartitionByRange(4, "doc_id")).collect()))
        faulty = docs.repartitionByRange(4, "doc_id").withColumn("text", fail_first("text"))
        if name in ("top_k", "hard_negatives"):
            faulty = faulty.where("text is not null")
        assert clean and clean == sorted(map(repr, build(faulty).collect())), name
    print("OK")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
