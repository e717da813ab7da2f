"""Joins: shuffle vs broadcast, size-checked broadcast, salting, hot keys, buckets.

A side is broadcast only when its size has been *measured* (one distributed
aggregate over that side, never over the big one) or is bounded by
construction: keys that hold more than a share ``s`` of the rows are fewer than
``1 / s``. Beyond the bound every operator falls back to a shuffle join, which
AQE may still convert or split at run time.

The skew joins take ``inner`` and ``left`` only: they replicate or split the
small side, so its unmatched rows can't be told from the parts alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.heavy import heavy_hitters, key_profile, recount, sketchable

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 16

# In-memory bytes per value of the fixed-width types.
_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
          T.FloatType: 4, T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8,
          T.TimestampNTZType: 8, T.DecimalType: 16}


def _value_bytes(f: T.StructField) -> Column | int:
    """In-memory bytes of a column's values: a number if all are alike, else an expression."""
    c = F.col(f"`{f.name}`")
    if type(f.dataType) in _WIDTH:
        return _WIDTH[type(f.dataType)]
    if isinstance(f.dataType, (T.StringType, T.BinaryType)):
        return F.lit(8) + F.coalesce(F.octet_length(c), F.lit(0))
    # Nested: an element takes at least two characters of JSON and eight bytes
    # of memory, so four bytes a character is an upper bound.
    return F.lit(8) + 4 * F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))


def row_bytes(df: DataFrame, overhead: int = ROW_OVERHEAD) -> Column:
    """Bytes of a row of ``df`` in memory. Fixed-width columns count their width,
    strings and binaries their length, nested columns a bound from their JSON;
    every row some overhead."""
    widths = [_value_bytes(f) for f in df.schema.fields]
    row = F.lit(overhead + sum(w for w in widths if isinstance(w, int))).cast("bigint")
    for w in widths:
        if not isinstance(w, int):
            row = row + w
    return row


def estimate_size_bytes(df: DataFrame) -> int:
    """Bytes of ``df`` as rows in memory (:func:`row_bytes`), from one partially
    aggregated count and sum."""
    return int(df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("b")).first()["b"])


def broadcast_if_bounded(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """``(broadcast(df), True)`` if ``df`` measures at most ``max_bytes``, else ``(df, False)``."""
    if estimate_size_bytes(df) <= max_bytes:
        return F.broadcast(df), True
    return df, False


def project_star(joined: DataFrame, fact: DataFrame, dim_cols: list[str]) -> DataFrame:
    """``fact.*`` plus the named dimension columns."""
    return joined.select(*[F.col(f"`{c}`") for c in fact.columns], *dim_cols)


def left_join_shuffle(fact: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    """Left outer USING ``on`` as a sort-merge join (both sides exchanged)."""
    return fact.join(dim.hint("merge"), on, "left")


def left_join_broadcast(fact: DataFrame, dim: DataFrame, on: str,
                        max_bytes: int = DEFAULT_BROADCAST_BYTES, skew_safe: bool = True) -> DataFrame:
    """Left outer USING ``on`` with the dimension broadcast when it measures
    under ``max_bytes``.

    Beyond that the join shuffles; with ``skew_safe`` the fact's hot keys are
    found first (one partial aggregate over the key column) and joined to a
    broadcast of their few dimension rows, so no reducer receives a hot key.
    """
    side, ok = broadcast_if_bounded(dim, max_bytes)
    if ok or not skew_safe:
        return fact.join(side, on, "left")
    return hot_key_join(fact, dim, on, hot_keys(fact, on), how="left")


HOT_TO_TYPICAL = 10


def fair_share(df: DataFrame) -> float:
    """One shuffle partition's share of the rows."""
    return 1.0 / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, key: str, share: float | None = None, to_typical: float = HOT_TO_TYPICAL) -> DataFrame:
    """Keys (not NULL) that hold more than ``share`` of the rows and more than
    ``to_typical`` times as many as the other keys do on average.

    ``share`` defaults to one partition's fair share. Fewer than ``1 / share``
    keys can exceed it, which bounds the list; the second test keeps tables of
    few or even keys from counting as skewed (a table whose keys all exceed the
    share isn't; ``to_typical=0`` leaves the test out). Two passes over the key
    column: a frequent-items sketch (:mod:`strata.operators.heavy`) with the
    number of keys, then the exact count of its candidates. No shuffle carries
    all keys.
    """
    share = min(share if share is not None else fair_share(df), 0.999)
    schema = T.StructType([df.schema[key]])
    if sketchable(df, key, share):
        candidates, rows, known, keys = key_profile(df, key, share)
        found = recount(df, key, candidates, rows, share).collect() if any(c is not None for c in candidates) else []
    else:
        found = heavy_hitters(df, key, share).collect()                   # fewer than 1 / share, as above
        whole = df.agg(F.count(key).alias("known"), F.approx_count_distinct(key).alias("keys")).first()
        known, keys = whole["known"], whole["keys"]
    above = [(r[key], r["count"]) for r in found if r[key] is not None]
    if above and to_typical:
        rest, others = known - sum(c for _, c in above), keys - len(above)
        typical = rest / max(others, 1) if rest else float("inf")
        above = [(k, c) for k, c in above if c > to_typical * typical]
    return df.sparkSession.createDataFrame([(k,) for k, _ in above], schema)


def bounded_key_list(keys: DataFrame, on: str) -> DataFrame | None:
    """The keys of :func:`hot_keys` as a broadcastable DataFrame, or None when
    there are none (one small driver round trip)."""
    rows = keys.select(on).collect()
    if not rows:
        return None
    return F.broadcast(keys.sparkSession.createDataFrame(rows, keys.select(on).schema))


def _checked(how: str) -> str:
    if how not in ("inner", "left"):
        raise ValueError(f"a skew join can be inner or left, not {how}")
    return how


def _row_hash(df: DataFrame, row_key: list[str] | None) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in row_key or df.columns])


def _shuffle_join(big: DataFrame, small: DataFrame, on: str, how: str, row_key: list[str] | None) -> DataFrame:
    """``big.join(small, on, how)`` with the rows of a NULL key spread.

    They match nothing, but a left join would send them all to one reducer. A
    second join column holds a row hash for them, and 0 for everything else on
    both sides. (An inner join drops them before its exchange.)
    """
    if how == "inner":
        return big.join(small, on, how)
    spread = F.when(F.col(on).isNull(), _row_hash(big, row_key)).otherwise(F.lit(0).cast("bigint"))
    return (big.withColumn("_spread", spread)
            .join(small.withColumn("_spread", F.lit(0).cast("bigint")), [on, "_spread"], how).drop("_spread"))


def hot_key_join(big: DataFrame, small: DataFrame, on: str, hot: DataFrame, how: str = "inner",
                 max_bytes: int = DEFAULT_BROADCAST_BYTES, row_key: list[str] | None = None) -> DataFrame:
    """Join ``big`` to ``small`` (``inner`` or ``left``) with hot keys isolated.

    Rows of hot keys join a broadcast of the matching ``small`` rows, so no
    task receives a hot key's rows; the rest joins by the usual shuffle. The
    two parts are disjoint and are unioned. The broadcast side is measured;
    beyond ``max_bytes`` the hot part becomes a salted join, for which
    ``row_key`` names columns that tell the rows of ``big`` apart (all columns
    if not given).
    """
    _checked(how)
    hot_b = bounded_key_list(hot, on)
    if hot_b is None:          # no hot key: the plain join is the whole answer
        return _shuffle_join(big, small, on, how, row_key)
    side, ok = broadcast_if_bounded(small.join(hot_b, on, "left_semi"), max_bytes)
    big_hot = big.join(hot_b, on, "left_semi")
    hot_part = big_hot.join(side, on, how) if ok else salted_join(big_hot, side, on, row_key or big.columns, how=how)
    return hot_part.unionByName(_shuffle_join(big.join(hot_b, on, "left_anti"), small, on, how, row_key))


def salt_buckets(df: DataFrame, key: str) -> int:
    """Ways to split a key so that the largest one fills no more than a fair
    share of a shuffle partition per way: its share of the rows times the
    partitions, from one partially aggregated count."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("c"))
    row = counts.agg(F.max("c").alias("most"), F.sum("c").alias("n")).first()
    return max(1, math.ceil((row["most"] or 0) / ((row["n"] or 1) * fair_share(df))))


def salted_join(big: DataFrame, small: DataFrame, on: str, row_key: list[str], buckets: int | None = None,
                how: str = "inner") -> DataFrame:
    """Equi-join (``inner`` or ``left``) with every key split ``buckets`` ways.

    The big side's salt is a hash of ``row_key``, columns that tell its rows
    apart: deterministic, so a retried task sends each row to the same bucket,
    and spread for rows that are otherwise alike. The small side is replicated
    once per salt value. ``buckets`` defaults to :func:`salt_buckets`.
    """
    _checked(how)
    n = buckets or salt_buckets(big, on)
    # Rows of a NULL key match no salt: their whole hash spreads them further.
    salt = F.when(F.col(on).isNull(), _row_hash(big, row_key)).otherwise(F.pmod(_row_hash(big, row_key), F.lit(n)))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))))
    return big.withColumn("_salt", salt).join(s, [on, "_salt"], how).drop("_salt")


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> DataFrame:
    """Save ``df`` as a table bucketed and sorted by ``key`` at ``path``; return it read back.

    Written straight from M input tasks, a bucketed write makes up to M x
    ``buckets`` files. Hash-partitioning on the key into ``buckets`` partitions
    first (the hash the bucketing uses) gives one file per bucket.
    """
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
       .option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def bucketed_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  how: str = "inner") -> DataFrame:
    """Join two tables bucketed on their keys with the same bucket count:
    a sort-merge join with no exchange on either side (the hint keeps the
    planner from broadcasting a side that happens to be small)."""
    return left.join(right.hint("merge"), left[left_key] == right[right_key], how)
