"""Run operators with injected task failures (first attempt of every other
partition raises) on local[4,4], where failed tasks are retried; print OK if
the results equal a failure-free run. Used by tests/test_retries.py."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from strata.operators import heavy, iterate, moments, partitioner, ranking, rollups, skew  # noqa: E402
from strata.session import local_session  # noqa: E402
from strata.sources.tables import clickstream, customer_orders  # noqa: E402


@F.udf(T.LongType())
def fail_first_attempt(x):
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        raise RuntimeError("injected task failure")
    return x


def main(sf_dir):
    spark = local_session("4,4", shuffle_partitions=6, app_name="strata-retries")

    def runs(build):
        clean = sorted(map(tuple, build(lambda c: c).collect()))
        faulty = sorted(map(tuple, build(lambda c: fail_first_attempt(c)).collect()))
        return clean, faulty

    def clicks(inject):
        c = clickstream(spark, sf_dir).repartition(4)
        return c.withColumn("user_id", inject(F.col("user_id")))

    checks = {
        "salted_user_stats": lambda inj: skew.salted_user_stats(clicks(inj), 10),
        "session_sequence": lambda inj: rollups.session_sequence(clicks(inj)),
        "global_row_number": lambda inj: ranking.global_row_number(
            customer_orders(spark, sf_dir).repartition(4).withColumn("user_id", inj(F.col("user_id")))
            .groupBy("user_id").agg(F.sum("revenue").alias("ltv")), "ltv", "user_id", True, "r", 4),
        "global_percent_rank": lambda inj: ranking.global_percent_rank(clicks(inj), "revenue", "event_id", "p", "r", 4).select("event_id", "p", "r"),
        "heavy_hitters": lambda inj: heavy.heavy_hitters(clicks(inj), "user_id", 0.02),
        "weighted_sums": lambda inj: partitioner.weighted_sums(clicks(inj), "user_id", "revenue", 5),
        "components": lambda inj: iterate.components(clicks(inj).where("event_id % 9 = 0").select("user_id", (F.col("event_id") % 40).alias("b")), "user_id", "b"),
        "moments": lambda inj: moments.statistics(moments.moments(clicks(inj), ["event_type"], "revenue", "event_id"), ["event_type"])
                                      .select("event_type", "n", F.round("mean", 6), F.round("variance", 4), "least", "most"),
    }
    for name, build in checks.items():
        clean, faulty = runs(build)
        assert clean == faulty, name
        assert len(clean) > 0, name
    print("OK")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
