"""Spark JSON event logs as a table.

Production logs hold one line per task and reach many gigabytes; they are
read as an ordinary distributed JSON scan with an explicit schema (no
inference pass), one row per event, with ``log_path`` naming the log (one
application) each row came from. Logs must be uncompressed
(``spark.eventLog.compress=false``); rolling logs (a folder of
``events_<n>_<app>`` files) are read as one application.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_L, _S, _B = T.LongType(), T.StringType(), T.BooleanType()


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


EVENT_LOG_SCHEMA = _st(
    ("Event", _S),
    ("App Name", _S), ("App ID", _S), ("Timestamp", _L), ("User", _S),
    ("Stage ID", _L), ("Stage Attempt ID", _L), ("Task Type", _S),
    ("Task End Reason", _st(("Reason", _S), ("Class Name", _S), ("Description", _S))),
    ("Task Info", _st(("Task ID", _L), ("Index", _L), ("Attempt", _L), ("Partition ID", _L),
                      ("Launch Time", _L), ("Executor ID", _S), ("Host", _S), ("Finish Time", _L),
                      ("Failed", _B), ("Killed", _B))),
    ("Task Metrics", _st(("Executor Run Time", _L), ("Executor CPU Time", _L),
                         ("Peak Execution Memory", _L), ("JVM GC Time", _L),
                         ("Memory Bytes Spilled", _L), ("Disk Bytes Spilled", _L),
                         ("Shuffle Read Metrics", _st(("Remote Bytes Read", _L), ("Local Bytes Read", _L),
                                                      ("Total Records Read", _L))),
                         ("Shuffle Write Metrics", _st(("Shuffle Bytes Written", _L),
                                                       ("Shuffle Records Written", _L))),
                         ("Input Metrics", _st(("Bytes Read", _L), ("Records Read", _L))),
                         ("Output Metrics", _st(("Bytes Written", _L), ("Records Written", _L))))),
    ("Block Manager ID", _st(("Executor ID", _S), ("Host", _S))),
    ("Maximum Memory", _L),
    ("Job ID", _L), ("Completion Time", _L), ("Job Result", _st(("Result", _S))),
)

EVENTS_USED = ("SparkListenerApplicationStart", "SparkListenerApplicationEnd", "SparkListenerJobEnd",
               "SparkListenerBlockManagerAdded", "SparkListenerTaskEnd")


def read_event_log(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Events of one or more logs (files or folders); only the event kinds the
    run metrics use are kept, filtered right after the scan."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.schema(EVENT_LOG_SCHEMA).json(paths)
    # A rolling log is a folder ``eventlog_v2_<app>`` of ``events_<n>_<app>``
    # files: all of them belong to one application, named by the folder.
    path = F.col("_metadata.file_path")
    rolled = F.regexp_extract(path, r"^(.*/eventlog_v2_[^/]+)/events_[^/]+$", 1)
    return (df.withColumn("log_path", F.when(rolled != "", rolled).otherwise(path))
              .filter(F.col("Event").isin(*EVENTS_USED)))
