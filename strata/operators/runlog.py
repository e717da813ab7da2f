"""Run metrics computed from event logs, as tables.

Each function takes the events from :func:`strata.sources.eventlog.read_event_log`
and returns a DataFrame keyed by ``log_path`` (one application per log).
Per-stage medians are exact; they hold one stage's task durations at a time,
which the stage's partition count bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed thresholds of the reports.
HIGH_MEMORY_PCT = 90.0      # executor memory utilisation flagged above this
SKEW_RATIO = 10.0           # a stage is skewed when its slowest task > 10x the median
GIB = 1024 ** 3


def tasks(events: DataFrame) -> DataFrame:
    """One row per finished task attempt, flat columns."""
    m, i = "`Task Metrics`", "`Task Info`"
    t = events.filter(F.col("Event") == "SparkListenerTaskEnd")
    g = lambda path: F.coalesce(F.col(path), F.lit(0))
    return t.select(
        "log_path",
        F.col("`Stage ID`").alias("stage_id"), F.col("`Stage Attempt ID`").alias("stage_attempt"),
        F.col(f"{i}.`Task ID`").alias("task_id"), F.col(f"{i}.`Executor ID`").alias("executor_id"),
        (F.col(f"{i}.`Finish Time`") - F.col(f"{i}.`Launch Time`")).alias("duration_ms"),
        F.coalesce(F.col(f"{i}.Failed"), F.lit(False)).alias("failed"),
        F.col("`Task End Reason`.Reason").alias("end_reason"),
        g(f"{m}.`Executor Run Time`").alias("run_ms"), g(f"{m}.`JVM GC Time`").alias("gc_ms"),
        g(f"{m}.`Peak Execution Memory`").alias("peak_execution_memory"),
        g(f"{m}.`Memory Bytes Spilled`").alias("memory_spilled"),
        g(f"{m}.`Disk Bytes Spilled`").alias("disk_spilled"),
        (g(f"{m}.`Shuffle Read Metrics`.`Remote Bytes Read`")
         + g(f"{m}.`Shuffle Read Metrics`.`Local Bytes Read`")).alias("shuffle_read"),
        g(f"{m}.`Shuffle Write Metrics`.`Shuffle Bytes Written`").alias("shuffle_write"),
        (g(f"{m}.`Input Metrics`.`Records Read`")
         + g(f"{m}.`Shuffle Read Metrics`.`Total Records Read`")).alias("records"),
        g(f"{m}.`Input Metrics`.`Records Read`").alias("input_records"),
        g(f"{m}.`Input Metrics`.`Bytes Read`").alias("input_bytes"))


def _metric_aggs():
    return [F.count(F.lit(1)).alias("tasks"),
            F.sum(F.col("failed").cast("int")).alias("failed_tasks"),
            F.sum("shuffle_read").alias("shuffle_read_bytes"),
            F.sum("shuffle_write").alias("shuffle_write_bytes"),
            F.sum("memory_spilled").alias("memory_spilled_bytes"),
            F.sum("disk_spilled").alias("disk_spilled_bytes"),
            F.sum("gc_ms").alias("gc_ms"), F.sum("run_ms").alias("run_ms"),
            F.max("peak_execution_memory").alias("peak_execution_memory")]


def stage_metrics(events: DataFrame) -> DataFrame:
    """Per stage attempt: tasks, failures, shuffle, spill, GC, run time, peak memory."""
    return tasks(events).groupBy("log_path", "stage_id", "stage_attempt").agg(*_metric_aggs())


def task_skew(events: DataFrame) -> DataFrame:
    """Per stage: slowest and median task time and records, and the skew flag."""
    t = tasks(events).filter(~F.col("failed"))
    s = t.groupBy("log_path", "stage_id", "stage_attempt").agg(
        F.count(F.lit(1)).alias("tasks"),
        F.max("duration_ms").alias("max_task_ms"), F.median("duration_ms").alias("median_task_ms"),
        F.max("records").alias("max_records"), F.median("records").alias("median_records"))
    ratio = F.when(F.col("median_task_ms") > 0, F.col("max_task_ms") / F.col("median_task_ms"))
    return (s.withColumn("max_to_median", F.round(ratio, 2))
             .withColumn("skewed", F.coalesce(ratio > F.lit(SKEW_RATIO), F.lit(False))))


def _executor_memory_limits(events: DataFrame) -> DataFrame:
    bm = events.filter(F.col("Event") == "SparkListenerBlockManagerAdded")
    return (bm.groupBy("log_path", F.col("`Block Manager ID`.`Executor ID`").alias("executor_id"))
              .agg(F.max("`Maximum Memory`").alias("max_memory")))


def executor_memory(events: DataFrame) -> DataFrame:
    """Per executor: tasks, failures, peak execution memory against its maximum,
    shuffle, spill and the GC share of run time."""
    per = tasks(events).groupBy("log_path", "executor_id").agg(*_metric_aggs())
    # One row per executor on each side: a small join.
    j = per.join(_executor_memory_limits(events), ["log_path", "executor_id"], "left")
    return (j.withColumn("memory_utilisation_pct",
                         F.round(F.col("peak_execution_memory") * F.lit(100.0) / F.col("max_memory"), 2))
             .withColumn("gc_pct", F.round(F.when(F.col("run_ms") > 0,
                                                  F.col("gc_ms") * F.lit(100.0) / F.col("run_ms")), 2)))


def memory_warnings(events: DataFrame) -> DataFrame:
    """Executors over the memory threshold, spilling to disk, or with failed tasks."""
    e = executor_memory(events)
    reasons = F.concat_ws("; ",
                          F.when(F.col("memory_utilisation_pct") > HIGH_MEMORY_PCT, F.lit("high memory utilisation")),
                          F.when(F.col("disk_spilled_bytes") > 0, F.lit("disk spill")),
                          F.when(F.col("memory_spilled_bytes") > 0, F.lit("memory spill")),
                          F.when(F.col("failed_tasks") > 0, F.lit("failed tasks")))
    return (e.withColumn("warning", reasons).filter(F.col("warning") != "")
             .select("log_path", "executor_id", "memory_utilisation_pct", "memory_spilled_bytes",
                     "disk_spilled_bytes", "failed_tasks", "warning"))


def app_summary(events: DataFrame) -> DataFrame:
    """One row per application: name, status, seconds, records, GB moved,
    memory utilisation and GC share."""
    app = events.groupBy("log_path").agg(
        F.max(F.when(F.col("Event") == "SparkListenerApplicationStart", F.col("`App Name`"))).alias("app_name"),
        F.max(F.when(F.col("Event") == "SparkListenerApplicationStart", F.col("`App ID`"))).alias("app_id"),
        F.min(F.when(F.col("Event") == "SparkListenerApplicationStart", F.col("Timestamp"))).alias("start_ms"),
        F.max(F.when(F.col("Event") == "SparkListenerApplicationEnd", F.col("Timestamp"))).alias("end_ms"),
        F.sum(F.when((F.col("Event") == "SparkListenerJobEnd")
                     & (F.col("`Job Result`.Result") != "JobSucceeded"), 1).otherwise(0)).alias("failed_jobs"))
    t = tasks(events).groupBy("log_path").agg(
        F.count(F.lit(1)).alias("tasks"), F.sum(F.col("failed").cast("int")).alias("failed_tasks"),
        F.sum("input_records").alias("records"), F.sum("input_bytes").alias("input_bytes"),
        F.sum("shuffle_read").alias("shuffle_read_bytes"), F.sum("shuffle_write").alias("shuffle_write_bytes"),
        F.sum("disk_spilled").alias("disk_spilled_bytes"), F.sum("memory_spilled").alias("memory_spilled_bytes"),
        F.sum("gc_ms").alias("gc_ms"), F.sum("run_ms").alias("run_ms"))
    mem = executor_memory(events).groupBy("log_path").agg(
        F.max("memory_utilisation_pct").alias("memory_utilisation_pct"))
    gb = lambda c: F.round(F.col(c) / F.lit(float(GIB)), 3)
    return (app.join(t, "log_path", "left").join(mem, "log_path", "left")
            .select("log_path", "app_name", "app_id",
                    F.when((F.col("failed_jobs") > 0) | F.col("end_ms").isNull(), F.lit("FAILED"))
                     .otherwise(F.lit("SUCCESS")).alias("status"),
                    F.round((F.col("end_ms") - F.col("start_ms")) / F.lit(1000.0), 3).alias("duration_sec"),
                    "tasks", "failed_tasks", "records",
                    gb("input_bytes").alias("input_gb"), gb("shuffle_read_bytes").alias("shuffle_read_gb"),
                    gb("shuffle_write_bytes").alias("shuffle_write_gb"),
                    gb("disk_spilled_bytes").alias("disk_spill_gb"),
                    gb("memory_spilled_bytes").alias("memory_spill_gb"),
                    "memory_utilisation_pct",
                    F.round(F.when(F.col("run_ms") > 0, F.col("gc_ms") * F.lit(100.0) / F.col("run_ms")), 2)
                     .alias("gc_pct")))


# Metrics compared by :func:`compare`, in this order.
COMPARED = ("duration_sec", "tasks", "failed_tasks", "records", "input_gb", "shuffle_read_gb",
            "shuffle_write_gb", "disk_spill_gb", "memory_spill_gb", "memory_utilisation_pct", "gc_pct")


def compare(before: DataFrame, after: DataFrame) -> DataFrame:
    """Before/after per metric with the change in percent, from two summaries
    (one row each, e.g. two :func:`app_summary` results)."""
    def long(df, side):
        pairs = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in COMPARED)
        return df.selectExpr(f"stack({len(COMPARED)}, {pairs}) AS (metric, {side})")
    b, a = long(before, "before"), long(after, "after")
    return (b.join(a, "metric", "full")
             .withColumn("change_pct", F.round(F.when(F.col("before") != 0,
                                                      (F.col("after") - F.col("before")) * F.lit(100.0)
                                                      / F.col("before")), 2)))
