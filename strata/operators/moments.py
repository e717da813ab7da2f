"""Moments that merge: count, mean and central sums of powers, kept as a state.

A state is one struct per group: ``n``, ``mean``, ``m2``, ``m3``, ``m4`` (sums of
powers of the distances from the mean), ``least`` and ``most``. Two states are
combined pairwise, from the difference of their means. Sums of powers of the
values themselves would merge by addition, but lose every digit of the spread
where the values share a large offset; the central sums don't.

So a group may be cut in parts by a salt, a day's state stored, and states of
several days merged later, with the same result as from all rows at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = ("n", "mean", "m2", "m3", "m4", "least", "most")
SALT = 16


def _per_group(df: DataFrame, by: list[str], value: Column) -> DataFrame:
    """One state per group, from Spark's own (numerically stable) aggregates."""
    x = value.cast("double")
    found = df.select(*by, x.alias("_x")).groupBy(*by).agg(
        F.count("_x").cast("double").alias("n"), F.avg("_x").alias("mean"), F.var_pop("_x").alias("_v"),
        F.skewness("_x").alias("_s"), F.kurtosis("_x").alias("_k"), F.min("_x").alias("least"), F.max("_x").alias("most"))
    m2 = F.col("n") * F.col("_v")
    flat = (F.col("_v") == 0) | F.col("_v").isNull()
    return found.where("n > 0").select(
        *by, "n", "mean", m2.alias("m2"),
        F.when(flat, F.lit(0.0)).otherwise(F.col("_s") * F.col("n") * F.pow("_v", F.lit(1.5))).alias("m3"),
        F.when(flat, F.lit(0.0)).otherwise((F.col("_k") + 3) * F.col("n") * F.pow("_v", F.lit(2.0))).alias("m4"), "least", "most")


def combined(a: Column, b: Column) -> Column:
    """The state of two states' rows together."""
    n, na, nb = a["n"] + b["n"], a["n"], b["n"]
    d = b["mean"] - a["mean"]
    m2 = a["m2"] + b["m2"] + d * d * na * nb / n
    m3 = (a["m3"] + b["m3"] + d * d * d * na * nb * (na - nb) / (n * n) + 3 * d * (na * b["m2"] - nb * a["m2"]) / n)
    m4 = (a["m4"] + b["m4"] + d * d * d * d * na * nb * (na * na - na * nb + nb * nb) / (n * n * n)
          + 6 * d * d * (na * na * b["m2"] + nb * nb * a["m2"]) / (n * n) + 4 * d * (na * b["m3"] - nb * a["m3"]) / n)
    return F.struct(n.alias("n"), (a["mean"] + d * nb / n).alias("mean"), m2.alias("m2"), m3.alias("m3"), m4.alias("m4"),
                    F.least(a["least"], b["least"]).alias("least"), F.greatest(a["most"], b["most"]).alias("most"))


def merge_moments(states: DataFrame, by: list[str]) -> DataFrame:
    """One state per group from any number of states (rows with ``PARTS``).

    A group's states are folded in a fixed order, so the result doesn't depend
    on the order they arrive in. They are one row per part of a group (a salt, a
    stored day), not per row of data; many of them are first folded in bundles.
    """
    def fold(rows: DataFrame, keys: list[str]) -> DataFrame:
        parts = F.array_sort(F.collect_list(F.struct(*PARTS)))
        one = rows.groupBy(*keys).agg(parts.alias("_p"))
        whole = F.aggregate(F.slice("_p", F.lit(2), F.size("_p")), F.get("_p", F.lit(0)), combined)
        return one.where(F.size("_p") > 0).select(*keys, whole.alias("_w")).select(*keys, *[F.col(f"_w.{c}").alias(c) for c in PARTS])

    bundled = states.select(*by, *PARTS, F.pmod(F.xxhash64(*by, *PARTS), F.lit(SALT)).alias("_bundle"))
    return fold(fold(bundled, [*by, "_bundle"]), by)


def moments(df: DataFrame, by: list[str], value: str | Column, salt_by: str | Column, salt: int = SALT) -> DataFrame:
    """The state of each group's values, nulls left out; ``by`` may be empty.

    Groups are cut in ``salt`` parts by a hash of ``salt_by``, so that a group of
    any size is spread, and the parts merged. Groups without a value give no row.
    """
    v = F.col(value) if isinstance(value, str) else value
    parted = df.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salt)))
    return merge_moments(_per_group(parted, [*by, "_salt"], v), by)


def statistics(states: DataFrame, by: list[str]) -> DataFrame:
    """What a state says: ``n``, ``mean``, ``variance`` and ``stddev`` (sample),
    ``skewness``, ``kurtosis`` (excess, of the population), ``least``, ``most``.
    Variance and stddev are null for a single value, the last two where all values are alike."""
    n, m2 = F.col("n"), F.col("m2")
    variance = F.when(n > 1, m2 / (n - 1))
    spread = m2 > 0
    return states.select(
        *by, n.cast("long").alias("n"), "mean", variance.alias("variance"), F.sqrt(variance).alias("stddev"),
        F.when(spread, F.sqrt(n) * F.col("m3") / F.pow(m2, F.lit(1.5))).alias("skewness"),
        F.when(spread, n * F.col("m4") / (m2 * m2) - 3).alias("kurtosis"), "least", "most")


__all__ = ["PARTS", "combined", "merge_moments", "moments", "statistics"]
