"""Frequent keys from a mergeable sketch, counted exactly afterwards.

A plain ``groupBy(key).count()`` shuffles every distinct key to find the few
that matter. Here one pass builds a frequent-items summary (a Misra-Gries table
of bounded size in every task, merged on the way; Spark's ``approx_top_k``),
whose error is at most ``3.5 / size`` of the rows. With a size of ``8 / share``
every key above ``share`` is in it, and no more than ``2 / share`` keys need to
be looked at. Those candidates are broadcast, and a second pass counts their
rows exactly, so the result is that of the plain count.

Summaries can be stored and merged (:func:`summarise`, :func:`merged`), a day at
a time; only the candidates of the merged one are counted over all days.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_TRACKED = 1_000_000        # the sketch's limit; smaller shares are counted in full
SKETCHED = (T.NumericType, T.BooleanType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)


def tracked(share: float) -> int:
    """Counters that a summary needs for keys above ``share`` of the rows."""
    if not 0 < share < 1:
        raise ValueError(f"a share lies between 0 and 1, not {share}")
    return max(64, math.ceil(8 / share))


def _name(key: str) -> str:
    return "`" + key.replace("`", "``") + "`"


def summarise(df: DataFrame, key: str, share: float, by: list[str] | None = None) -> DataFrame:
    """A summary of the keys, one row (for each group of ``by``, such as a day):
    ``summary`` and ``rows``. Can be written as a table."""
    sketch = F.expr(f"approx_top_k_accumulate({_name(key)}, {tracked(share)})").alias("summary")
    return df.groupBy(*(by or [])).agg(sketch, F.count(F.lit(1)).alias("rows"))


def key_profile(df: DataFrame, key: str, share: float) -> tuple[list, int, int, float]:
    """In one pass: the candidates (as :func:`merged` has them), the rows, the rows
    whose key isn't NULL, and about how many different keys those have (within 2 %)."""
    top, distinct = math.ceil(2 / share), F.hll_sketch_agg(F.col(_name(key)).cast("string"), F.lit(14))
    row = df.agg(F.expr(f"approx_top_k({_name(key)}, {top}, {tracked(share)})").alias("top"), F.count(F.lit(1)).alias("rows"),
                 F.count(_name(key)).alias("known"), F.hll_sketch_estimate(distinct).alias("keys")).first()
    return [t["item"] for t in row["top"] or []], row["rows"], row["known"], row["keys"] or 0


def sketchable(df: DataFrame, key: str, share: float) -> bool:
    """Whether keys above ``share`` can be found by a sketch."""
    return tracked(share) <= MOST_TRACKED and isinstance(df.schema[key].dataType, SKETCHED)


def merged(summaries: DataFrame, share: float) -> tuple[list, int]:
    """The candidates of merged summaries (a superset of the keys above
    ``share``; NULL may be one), and the number of rows. Summaries have to be made for
    this share or a smaller one."""
    row = summaries.agg(F.expr("approx_top_k_combine(summary)").alias("s"), F.sum("rows").alias("n")).select(
        F.expr(f"approx_top_k_estimate(s, {math.ceil(2 / share)})").alias("top"), "n").first()
    return [t["item"] for t in row["top"] or []], row["n"] or 0


def recount(df: DataFrame, key: str, candidates: list, rows: int, share: float) -> DataFrame:
    """``key``, ``count`` of the candidates that hold more than ``share`` of the
    rows: one pass with a broadcast of the candidates, a partial count of few keys."""
    schema = T.StructType([T.StructField("_candidate", df.schema[key].dataType)])
    listed = df.sparkSession.createDataFrame([(c,) for c in candidates], schema)     # at most 2 / share keys
    held = df.select(key).join(F.broadcast(listed), F.col(key).eqNullSafe(F.col("_candidate")), "left_semi")
    return (held.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
            .where(F.col("count") > F.lit(rows * share)))


def heavy_hitters(df: DataFrame, key: str, share: float) -> DataFrame:
    """``key``, ``count`` of every key that holds more than ``share`` of the
    rows, NULL counted as a key: fewer than ``1 / share`` rows, exact. ``df`` is
    read twice, and only the key column of it. Keys of nested type, and shares
    under ``8 / MOST_TRACKED``, are counted in full."""
    if not sketchable(df, key, share):
        total = df.select(F.count(F.lit(1))).scalar()
        counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
        return counts.where(F.col("count") > total * F.lit(share))
    candidates, rows = merged(summarise(df, key, share), share)
    return recount(df, key, candidates, rows, share)
