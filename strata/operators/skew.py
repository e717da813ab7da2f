"""Skew detection and skew-safe aggregation.

Salting is only useful where partial aggregation can't shrink a key:
distinct counts, ``collect_*`` and joins. Salts are functions of row values,
never ``rand()``: a retried task must send each row to the same bucket, and a
distinct count stays exact only if every copy of a value lands in one salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import array_set_merge
from strata.functions.money import ratio_2, to_double


def key_frequency_top(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    """The ``k`` most frequent keys with their counts (ties by key)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.col("count").desc(), F.col(key).asc()).limit(k))


def skew_report(df: DataFrame, key: str) -> DataFrame:
    """One row: keys, rows, the largest key's count and share (%), the median
    count and the max/median ratio (the documented skew test is ratio > 10).

    The exact median comes from the frequency-of-counts table ``(c, m)``:
    ``m`` keys have ``c`` rows. Distinct counts sum to at most the row total,
    so there are fewer than sqrt(2 * rows) of them; that small table is the
    only thing ordered in one task (one window, no join).
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("c"))
    freq = counts.groupBy("c").agg(F.count(F.lit(1)).alias("m"))
    everything = Window.partitionBy()
    w = Window.orderBy("c").rowsBetween(Window.unboundedPreceding, 0)
    k = F.col("keys")
    lo = F.floor((k + F.lit(1)) / F.lit(2))         # middle position (odd), lower middle (even)
    hi = F.floor(k / F.lit(2)) + F.lit(1)           # upper middle (even); equals lo when odd
    f = (freq.withColumn("cum", F.sum("m").over(w))
             .withColumn("keys", F.sum("m").over(everything))
             .withColumn("rows", F.sum(F.col("c") * F.col("m")).over(everything))
             .withColumn("max_count", F.max("c").over(everything))
             .withColumn("prev", F.col("cum") - F.col("m")))
    at = lambda pos: (F.col("prev") < pos) & (F.col("cum") >= pos)
    picks = f.agg(F.max("keys").alias("keys"), F.max("rows").alias("rows"), F.max("max_count").alias("max_count"),
                  F.max(F.when(at(lo), F.col("c"))).alias("v_lo"), F.max(F.when(at(hi), F.col("c"))).alias("v_hi"))
    return picks.select(
        F.coalesce("keys", F.lit(0)).alias("keys"), F.coalesce("rows", F.lit(0)).alias("rows"), "max_count",
        ratio_2(F.col("max_count") * F.lit(100), F.col("rows")).alias("max_share_pct"),
        ((F.col("v_lo") + F.col("v_hi")).cast("double") / F.lit(2.0)).alias("median_count"),
        ratio_2(F.col("max_count").cast("decimal(38,2)") * F.lit(2),
                F.col("v_lo") + F.col("v_hi")).alias("max_to_median"))


def salted_user_stats(clicks: DataFrame, salt_factor: int = 10, key: str = "user_id") -> DataFrame:
    """Per ``key`` (a user) stats in two stages, ``(key, salt)`` then ``key``.

    The salt is a hash of the session hour, so each session falls in exactly one
    salt and the per-salt distinct session counts add up exactly (a random salt
    counts a session once per salt it lands in). Sets merge by union. Result
    equals :func:`strata.operators.rollups.skew_user_stats`.
    """
    salted = clicks.withColumn("_salt", F.pmod(F.xxhash64("hour_start"), F.lit(salt_factor)))
    stage1 = (salted.groupBy(key, "_salt")
              .agg(F.count(F.lit(1)).alias("n"), F.sum("revenue").alias("rev"),
                   F.countDistinct("hour_start").alias("sessions"),
                   F.collect_set("event_type").alias("types")))
    stage2 = (stage1.groupBy(key)
              .agg(F.sum("n").alias("event_count"), F.sum("rev").alias("_rev"),
                   F.sum("sessions").alias("session_count"),
                   array_set_merge(F.collect_list("types")).alias("_types")))
    return stage2.select(key, "event_count", to_double(F.col("_rev")).alias("total_revenue"),
                         "session_count", F.col("_types").alias("event_types"))


def hot_key_split_union(clicks: DataFrame, key: str = "user_id", salt_factor: int = 10,
                        hot: DataFrame | None = None) -> DataFrame:
    """Per-``key`` stats with hot keys processed apart, then unioned.

    Hot keys (a list bounded by their share, broadcast) go through the salted
    two-stage aggregate; the rest, NULL included, through the direct one. Same
    answer as the direct form.
    """
    from strata.operators.joins import bounded_key_list, hot_keys
    from strata.operators.rollups import skew_user_stats

    hot_b = bounded_key_list(hot if hot is not None else hot_keys(clicks, key), key)
    if hot_b is None:          # nothing hot: the direct aggregate is the whole answer
        return skew_user_stats(clicks, key)
    hot_part = salted_user_stats(clicks.join(hot_b, key, "left_semi"), salt_factor, key)
    cold_part = skew_user_stats(clicks.join(hot_b, key, "left_anti"), key)
    return hot_part.unionByName(cold_part)


def composite_key_repartition(df: DataFrame, key: str, value: str, salt_by: str, salt_factor: int = 8,
                              num_partitions: int | None = None, explicit_repartition: bool = False) -> DataFrame:
    """Spread rows by the composite key ``(key, salt)`` before aggregating by ``key``.

    The salt is a hash of the one column ``salt_by``. Grouping on ``(key,
    salt)`` hash-partitions on the composite key, so a hot key is spread over
    ``salt_factor`` partitions, and its partial aggregate runs before the
    exchange. The second aggregate merges at most ``salt_factor`` rows per key.
    ``explicit_repartition`` adds ``repartition(n, key, salt)`` first (the
    documented form); that ships raw rows, since an aggregate above a user
    repartition gets no map-side stage. Equals the direct ``groupBy(key)``
    (:func:`direct_key_sums`), which is the faster plan for plain counts and sums.
    """
    salted = df.select(key, value, F.pmod(F.xxhash64(salt_by), F.lit(salt_factor)).alias("_salt"))
    if explicit_repartition:
        n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salted = salted.repartition(n, key, "_salt")
    stage1 = (salted.groupBy(key, "_salt")
              .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast("decimal(18,2)")).alias("s")))
    return (stage1.groupBy(key).agg(F.sum("n").alias("row_count"), F.sum("s").alias("_s"))
                  .select(key, "row_count", to_double(F.col("_s")).alias("value_sum")))


def direct_key_sums(df: DataFrame, key: str, value: str) -> DataFrame:
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"),
                                F.sum(F.col(value).cast("decimal(18,2)")).alias("_s"))
              .select(key, "row_count", to_double(F.col("_s")).alias("value_sum")))


def approx_distinct_mergeable(df: DataFrame, group: str, value: str, salt_factor: int = 8) -> DataFrame:
    """Approximate distinct ``value`` per ``group`` from mergeable HLL sketches.

    Stage one builds a sketch per ``(group, salt)``; stage two unions the
    sketches, so a hot group is sketched by several tasks.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(value), F.lit(salt_factor)))
    stage1 = salted.groupBy(group, "_salt").agg(F.hll_sketch_agg(value).alias("sk"))
    return (stage1.groupBy(group).agg(F.hll_union_agg("sk").alias("sk"))
                  .select(group, F.hll_sketch_estimate("sk").alias("approx_distinct")))


def approx_distinct_error(df: DataFrame, group: str, value: str, salt_factor: int = 8,
                          bound: float = 0.03) -> DataFrame:
    """The estimates of :func:`approx_distinct_mergeable` held against the exact
    counts: ``within_bound`` tells whether they differ by at most ``bound``."""
    exact = (df.groupBy(group, value).agg(F.lit(1).alias("_one"))
             .groupBy(group).agg(F.count(value).alias("distinct_values")))
    estimate = approx_distinct_mergeable(df, group, value, salt_factor).withColumnRenamed(group, "_group")
    off = F.abs(F.col("approx_distinct") - F.col("distinct_values"))
    return (exact.join(estimate, F.col(group).eqNullSafe(F.col("_group")))
            .select(group, "distinct_values", (off <= F.col("distinct_values") * F.lit(bound)).alias("within_bound")))


def array_set_merge_by(clicks: DataFrame, key: str = "user_id", salt_factor: int = 10) -> DataFrame:
    """Per key, the union of partial type sets (``flatten`` + ``array_distinct``).

    Stage one collects a set per ``(key, salt)`` with the salt taken from the
    session hour; stage two merges at most ``salt_factor`` sets per key, so no
    row ever holds more than ``salt_factor`` small arrays.
    """
    salted = clicks.withColumn("_salt", F.pmod(F.xxhash64("hour_start"), F.lit(salt_factor)))
    stage1 = salted.groupBy(key, "_salt").agg(F.collect_set("event_type").alias("t"))
    return (stage1.groupBy(key).agg(array_set_merge(F.collect_list("t")).alias("_types"))
                  .select(key, F.col("_types").alias("event_types"),
                          F.size("_types").cast("bigint").alias("type_count")))


__all__ = [
    "key_frequency_top", "skew_report", "salted_user_stats", "hot_key_split_union",
    "composite_key_repartition", "direct_key_sums", "approx_distinct_mergeable", "approx_distinct_error",
    "array_set_merge_by",
]
