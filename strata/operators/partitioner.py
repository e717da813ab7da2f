"""A partitioner from measured weights: keys packed onto partitions by their rows.

Hash partitioning deals keys out blindly: with few or uneven keys some partitions
get several large ones. Here the rows of every key are measured first. Large
keys are placed one by one, the many small ones in buckets by their hash; longest
first, each goes to the partition with the least rows so far. The plan is applied
with ``repartitionById``, so what follows can work partition by partition, with
all rows of a key in one place.

A key above one partition's share can't be placed evenly as a whole. With ``split``
its rows are dealt over several partitions by a hash of the row, for work that
merges a key's parts afterwards.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.heavy import heavy_hitters

BUCKETS = 32            # buckets of small keys for each partition
LARGE = 16              # a key is large from this part of a partition's share on


def longest_first(weights: list[int], partitions: int) -> tuple[list[int], list[int]]:
    """The partition of each weight, and each partition's sum: the largest
    first, each to the least filled partition. No partition exceeds the mean by
    more than the weight placed there last, and none exceeds 4/3 of the best
    packing possible."""
    heap = [(0, p) for p in range(partitions)]
    place, load = [0] * len(weights), [0] * partitions
    for i in sorted(range(len(weights)), key=lambda i: (-weights[i], i)):
        filled, p = heapq.heappop(heap)
        place[i], load[p] = p, filled + weights[i]
        heapq.heappush(heap, (load[p], p))
    return place, load


@dataclass(frozen=True)
class Plan:
    """Where keys go: ``large`` (key or part of one, rows, partition) and
    ``buckets`` (partition of each bucket of small keys); ``load``: rows planned per partition."""

    key: str
    partitions: int
    large: list[tuple]          # (key, ways, part, partition), at most LARGE * partitions keys
    buckets: list[int]
    load: list[int]

    def bucket(self, key: Column | str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(len(self.buckets))).cast("int")


def measure(df: DataFrame, key: str, partitions: int, split: bool = False) -> Plan:
    """Weigh the keys of ``df`` and place them. Two passes over the key column
    for the large keys, one for the buckets; the driver gets at most
    ``(LARGE + BUCKETS) * partitions`` counts. NULL is a key like any other."""
    rows = df.select(F.col(key))
    heavy = [(r[key], r["count"]) for r in heavy_hitters(rows, key, 1 / (LARGE * max(partitions, 2))).collect()]
    heavy.sort(key=lambda x: (-x[1], str(x[0])))
    n = partitions * BUCKETS
    bucket = F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    small = rows.join(F.broadcast(_keys(df, key, heavy)), F.col(key).eqNullSafe(F.col("_key")), "left_anti") if heavy else rows
    counts = {r["b"]: r["n"] for r in small.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(w for _, w in heavy) + sum(counts.values())
    fair = max(1, total // partitions)
    parts = []                  # (key, ways, part, rows)
    for k, w in heavy:
        ways = min(partitions, math.ceil(w / fair)) if split and w > fair else 1
        parts += [(k, ways, i, w // ways + (i < w % ways)) for i in range(ways)]
    weights = [p[3] for p in parts] + [counts.get(b, 0) for b in range(n)]
    place, load = longest_first(weights, partitions)
    large = [(k, ways, i, place[j]) for j, (k, ways, i, _) in enumerate(parts)]
    return Plan(key, partitions, large, place[len(parts):], load)


def _keys(df: DataFrame, key: str, heavy: list) -> DataFrame:
    return df.sparkSession.createDataFrame([(k,) for k, _ in heavy], T.StructType([T.StructField("_key", df.schema[key].dataType)]))


def repartition_by_weight(df: DataFrame, plan: Plan, row_key: list[str] | None = None) -> DataFrame:
    """``df`` dealt as planned, its columns unchanged. ``row_key`` names columns
    that tell the rows of a split key apart (all, if not given). Both lookups are
    broadcasts of the plan, whose size is bounded by the number of partitions."""
    spark, key = df.sparkSession, plan.key
    at = spark.createDataFrame(list(enumerate(plan.buckets)), "bucket int, at int")
    columns = [F.col(_quoted(c)) for c in df.columns]
    row = F.xxhash64(*[F.col(_quoted(c)) for c in row_key or df.columns])
    dealt = df.select(F.struct(*columns).alias("row"), F.col(_quoted(key)).alias("key"), row.alias("hash"))     # no name can clash
    dealt = dealt.withColumn("bucket", plan.bucket("key")).join(F.broadcast(at), "bucket")
    if plan.large:
        schema = T.StructType([T.StructField("large", df.schema[key].dataType), T.StructField("places", T.ArrayType(T.IntegerType()))])
        places: dict = {}
        for k, _, _, p in plan.large:
            places.setdefault(k, []).append(p)
        large = spark.createDataFrame(list(places.items()), schema)
        way = F.pmod("hash", F.size("places")).cast("int")
        dealt = (dealt.join(F.broadcast(large), F.col("key").eqNullSafe(F.col("large")), "left")
                 .withColumn("at", F.coalesce(F.get("places", way), "at")))
    return dealt.repartitionById(plan.partitions, F.col("at")).select("row.*")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def weighted_sums(df: DataFrame, key: str, value: str, partitions: int) -> DataFrame:
    """Per key the rows and the sum of ``value`` (as money), over rows dealt by
    weight. ``whole``: all rows of the key lay in one partition; ``even``: no
    partition held more than 4/3 of the mean, or none held more than the mean
    besides its largest key (where few keys come near the mean, that is as even as
    packing gets)."""
    from strata.functions.money import to_double

    placed = repartition_by_weight(df.select(key, value), measure(df, key, partitions))
    per = (placed.groupBy(F.spark_partition_id().alias("_p"), key)
           .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast("decimal(18,2)")).alias("s")))
    loads = per.groupBy("_p").agg(F.sum("n").alias("load"), F.max("n").alias("top"))
    mean = F.sum("load") / partitions
    even = loads.agg(((F.max("load") <= mean * 4 / 3) | (F.max(F.col("load") - F.col("top")) <= mean)).alias("even")).scalar()
    keys = per.groupBy(key).agg(F.sum("n").alias("row_count"), F.sum("s").alias("_s"), (F.count(F.lit(1)) == 1).alias("whole"))
    return keys.select(key, "row_count", to_double(F.col("_s")).alias("value_sum"), "whole", even.alias("even"))
