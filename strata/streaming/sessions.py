"""The hourly session rollup as an incremental Structured Streaming query.

Same sessions as :func:`strata.operators.rollups.session_totals` (one per
user and wall-clock hour), computed as files arrive: a file source with an
explicit schema, an event-time watermark on the session hour, a stateful
aggregate whose state is dropped once the watermark passes the hour, and an
append-only sink. The checkpoint (offsets and state) belongs in the
cluster's shared checkpoint folder so a restarted query resumes exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.functions.columns import event_time, session_id
from strata.functions.money import to_double
from strata.sources.tables import SCHEMAS, with_session_columns


def read_events_stream(spark: SparkSession, source: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New parquet files of the ``events`` layout under ``source``."""
    r = spark.readStream.schema(SCHEMAS["events"])
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(source)


def session_totals_stream(events: DataFrame, allowed_lateness: str = "2 hours") -> DataFrame:
    """Streaming per-session totals; a session is final (and emitted) once the
    newest hour seen is ``allowed_lateness`` past it."""
    clicks = with_session_columns(events).withColumn("session_hour", event_time("hour_start"))
    agg = (clicks.withWatermark("session_hour", allowed_lateness)
           .groupBy("user_id", "session_hour", "hour_start")
           .agg(F.count(F.lit(1)).alias("event_count"), F.sum("revenue").alias("_rev"),
                F.min("ts").alias("session_start"), F.max("ts").alias("session_end")))
    return agg.select("user_id", session_id("user_id", "hour_start").alias("session_id"), "hour_start",
                      "event_count", to_double(F.col("_rev")).alias("session_revenue"),
                      "session_start", "session_end")


def start_session_rollup(spark: SparkSession, source: str, sink: str, checkpoint_location: str,
                         allowed_lateness: str = "2 hours", available_now: bool = True,
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Run the rollup from ``source`` into a parquet ``sink`` (append mode).

    ``available_now`` processes what is there and stops (a scheduled
    incremental batch); otherwise the query keeps running on a 1-minute
    processing-time trigger.
    """
    stream = session_totals_stream(read_events_stream(spark, source, max_files_per_trigger), allowed_lateness)
    w = (stream.writeStream.outputMode("append").format("parquet")
         .option("path", sink).option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
