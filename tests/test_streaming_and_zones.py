"""Streaming session rollup equals the batch one; results don't move with the session zone."""

import pytest
from pyspark.sql import functions as F

from conftest import SF01, rows
from strata.functions.columns import event_time, hour_floor, hour_key
from strata.operators import rollups
from strata.plans.queries import QUERIES
from strata.session import scratch_dir
from strata.sources.tables import clickstream, read_table
from strata.streaming import start_session_rollup


def test_streaming_rollup_matches_batch(spark):
    landing = scratch_dir(spark, "landing")
    e = read_table(spark, SF01, "events")
    # Three arrivals, in time order (one file each).
    for lo, hi in (("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2024-02-01")):
        (e.filter((F.col("ts") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("ts") < F.lit(hi).cast("timestamp_ntz")))
          .coalesce(1).write.mode("append").parquet(landing))
    sink, ck = scratch_dir(spark, "sink"), scratch_dir(spark, "stream-ckpt")
    q = start_session_rollup(spark, landing, sink, ck, allowed_lateness="2 hours", max_files_per_trigger=1)
    q.awaitTermination(300)
    assert q.exception() is None
    got = spark.read.parquet(sink)
    # Sessions older than the final watermark are emitted; the last hours stay in state.
    last = e.agg(F.max(hour_floor("ts"))).first()[0]
    batch = (rollups.session_totals(clickstream(spark, SF01))
             .filter(F.col("hour_start") <= F.lit(last) - F.expr("INTERVAL 2 HOURS"))
             .select("user_id", "hour_start", "event_count", F.col("session_revenue").cast("double"),
                     "session_start", "session_end"))
    assert got.count() > 9000
    assert rows(got.select(*batch.columns)) == rows(batch)


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Kolkata"])
def test_results_independent_of_session_zone(spark, zone):
    keys = ["session_rollup", "hour_bucket", "cached_multi_rollup", "user_stats"]
    base = {k: rows(QUERIES[k](spark, SF01)) for k in keys}
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for k in keys:
            assert rows(QUERIES[k](spark, SF01)) == base[k], k
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_hour_key_in_a_daylight_saving_gap(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("2024-03-10 02:30:00.123456",)], "s string") \
                  .select(F.col("s").cast("timestamp_ntz").alias("ts"))
        r = df.select(hour_key(hour_floor("ts")).alias("k"), F.unix_micros(event_time("ts")).alias("us")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["k"] == "2024031002" and r["us"] == 1710037800123456
