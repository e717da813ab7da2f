"""Quantiles and percent ranks from mergeable sketches, without a global sort.

A KLL sketch is a bounded sample of weighted values that every task builds for
itself and that merge on the way, so one row reaches the end, whatever the size of
the table. From it come cut points, and each row's rank is looked up among those:
a projection, no shuffle of rows. :func:`strata.operators.ranking` has the exact
forms, which range-partition every row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 2048


def rank_error(k: int = K) -> float:
    """Bound of a rank's error, as a share of the rows, which a sketch of size
    ``k`` keeps with 99 % confidence, with as much again for the cut points."""
    return 2 * 2.296 / k ** 0.9723


def quantile_sketch(df: DataFrame, value: str, k: int = K, by: list[str] | None = None) -> DataFrame:
    """``sketch`` and ``n`` of the (not null) values, one row, or one for each
    group of ``by``; can be stored, and merged with :func:`merged_sketch`."""
    v = F.col(value).cast("double")
    return df.groupBy(*(by or [])).agg(F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch"), F.count(v).alias("n"))


def merged_sketch(sketches: DataFrame, by: list[str] | None = None, k: int = K) -> DataFrame:
    """Stored sketches (``sketch``, ``n``) merged into one row, or one for each group."""
    return sketches.where("n > 0").groupBy(*(by or [])).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"), F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, fractions: list[float]) -> DataFrame:
    """``quantiles`` (an array) of every sketch, the other columns as they are."""
    at = F.array(*[F.lit(float(f)) for f in fractions])
    return sketches.withColumn("quantiles", F.kll_sketch_get_quantile_double("sketch", at)).drop("sketch")


def _cuts(df: DataFrame, value: str, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Cut points in order, each one's first and last place among the ``k`` + 1
    even fractions, and the number of values."""
    points = [i / k for i in range(k + 1)]
    row = quantiles(quantile_sketch(df, value, k).where("n > 0"), points).first()
    if row is None:
        return np.zeros(0), np.zeros(0), np.zeros(0), 0
    at, first, times = np.unique(np.array(row["quantiles"]), return_index=True, return_counts=True)
    return at, first, first + times - 1, row["n"]


def approx_percent_rank(df: DataFrame, value: str, rank_col: str = "percent_rank", k: int = K) -> DataFrame:
    """``df`` with the share of the other rows whose value is smaller, as
    ``percent_rank() over (order by value)`` has it, off by ``rank_error(k)`` at
    most (with 99 % confidence for each rank). Nulls rank below everything: 0.

    One partially aggregated pass for the sketch, then a lookup among at most
    ``k`` cut points in each row. Values that hold more than a cut's share get
    the rank of their first cut, as ties do in the exact form.
    """
    cuts, first, last, n = _cuts(df, value, k)
    nulls = df.where(F.col(value).isNull()).count() if n else 0

    @F.pandas_udf("double")
    def rank(values: pd.Series) -> pd.Series:
        v = values.to_numpy(float)
        if not n or n + nulls < 2:
            return pd.Series(np.zeros(len(v)))
        at = np.clip(np.searchsorted(cuts, v, side="left"), 0, len(cuts) - 1)
        # On a cut: up to half a step before its first place. Between two: half a step behind the last place of the lower one.
        share = np.maximum(np.where(cuts[at] == v, first[at] - 0.5, np.where(at > 0, last[at - 1] + 0.5, 0.0)), 0) / k
        return pd.Series(np.where(np.isnan(v), 0.0, np.clip((share * n + nulls) / (n + nulls - 1), 0, 1)))
    return df.withColumn(rank_col, rank(F.col(value).cast("double")))


def within_error(approximate: Column, exact: Column, k: int = K) -> Column:
    """Whether a rank keeps the bound; the exact one may be null for none."""
    return F.abs(approximate - exact) <= F.lit(rank_error(k))


__all__ = ["K", "approx_percent_rank", "merged_sketch", "quantile_sketch", "quantiles", "rank_error", "within_error"]
