"""Heavy keys, weighted partitions and mergeable moments against their plain forms."""

import math
import random
import statistics as stats

import pytest
from conftest import SF01, rows
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from strata.operators import heavy, joins, moments, partitioner
from strata.sources.tables import read_table


def exact(df, key, share):
    n = df.count()
    return sorted(((r[key], r["count"]) for r in df.groupBy(key).count().collect() if r["count"] > n * share), key=str)


def found(df, key, share):
    return sorted((tuple(r) for r in heavy.heavy_hitters(df, key, share).collect()), key=str)


@pytest.mark.parametrize("share", [0.3, 0.02, 0.003, 0.0004])
def test_heavy_hitters_equal_the_exact_count(spark, share):
    li = read_table(spark, SF01, "lineitem")
    skewed = li.select(F.when(F.col("l_orderkey") % 3 == 0, F.lit(None)).when(F.col("l_orderkey") % 3 == 1, F.col("l_orderkey") % 40)
                       .otherwise(F.col("l_orderkey")).alias("k"))
    assert found(skewed, "k", share) == exact(skewed, "k", share)
    for key in ("l_quantity", "l_suppkey", "l_returnflag", "l_shipdate"):
        assert found(li, key, share) == exact(li, key, share)


def test_heavy_hitters_of_adversarial_order(spark):
    """Many keys just under the share, sorted so that every task sees others."""
    data = [(k,) for k in range(60) for _ in range(100 + k)] + [(1000 + i,) for i in range(4000)]
    df = spark.createDataFrame(data, "k long").repartitionByRange(12, "k")
    for share in (0.012, 0.0125, 0.009):
        assert found(df, "k", share) == exact(df, "k", share)
    assert found(df.limit(0), "k", 0.1) == []
    nested = df.select(F.struct("k").alias("k"))
    assert heavy.heavy_hitters(nested, "k", 0.012).count() == len(exact(df, "k", 0.012))
    with pytest.raises(ValueError):
        heavy.heavy_hitters(df, "k", 0)


def test_stored_summaries_merge(spark, tmp_path):
    li = read_table(spark, SF01, "lineitem").withColumn("month", F.date_format("l_shipdate", "yyyyMM"))
    heavy.summarise(li, "l_quantity", 0.019, by=["month"]).write.parquet(f"{tmp_path}/s")
    candidates, n = heavy.merged(spark.read.parquet(f"{tmp_path}/s"), 0.019)
    assert n == li.count()
    assert sorted(map(tuple, heavy.recount(li, "l_quantity", candidates, n, 0.019).collect()), key=str) == exact(li, "l_quantity", 0.019)


def test_hot_keys_equal_the_exact_rule(spark):
    """More than a share, and more than ten times the mean of the keys below it."""
    def rule(df, key, share, times):
        counts = {r[key]: r["count"] for r in df.where(F.col(key).isNotNull()).groupBy(key).count().collect()}
        n = df.count()
        above = {k: c for k, c in counts.items() if c > n * share}
        rest = [c for k, c in counts.items() if k not in above]
        return sorted(k for k, c in above.items() if rest and c > times * sum(rest) / len(rest) or times == 0)
    for spec in ([(1, 5000), (2, 40)] + [(i, 3) for i in range(10, 500)], [(i, 100) for i in range(5)], [(1, 98), (2, 1), (3, 1)], [(None, 900), (1, 100)]):
        df = spark.createDataFrame([(k,) for k, c in spec for _ in range(c)], "k long")
        for share, times in ((0.1, 10), (0.01, 10), (0.004, 10), (0.1, 0)):
            assert sorted(r.k for r in joins.hot_keys(df, "k", share, times).collect()) == rule(df, "k", share, times)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1000), max_size=200), st.integers(1, 20))
def test_longest_first(weights, partitions):
    place, load = partitioner.longest_first(weights, partitions)
    assert [sum(w for w, p in zip(weights, place) if p == q) for q in range(partitions)] == load
    mean = sum(weights) / partitions
    assert max(load) <= mean + max(weights, default=0)


def loads(df, n):
    got = {r["p"]: r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()}
    return [got.get(i, 0) for i in range(n)]


@pytest.mark.parametrize("n", [1, 5, 8])
def test_rows_lie_as_planned(spark, n):
    rng = random.Random(n)
    data = [(k, i) for k in range(300) for i in range(rng.choice((1, 5, 60)))] + [(None, i) for i in range(900)]
    df = spark.createDataFrame(data, "k long, _at long").repartition(6)
    plan = partitioner.measure(df, "k", n)
    placed = partitioner.repartition_by_weight(df, plan)
    assert rows(placed) == rows(df) and placed.columns == df.columns
    assert loads(placed, n) == plan.load
    where = placed.withColumn("p", F.spark_partition_id()).groupBy("k").agg(F.count_distinct("p").alias("n"))
    assert where.where("n > 1").count() == 0
    assert max(plan.load) <= max(len(data) / n * 4 / 3, 900)


def test_a_key_above_its_share_is_split(spark):
    data = [(0, i) for i in range(8000)] + [(i % 50 + 1, i) for i in range(2000)]
    df = spark.createDataFrame(data, "k long, i long")
    whole = partitioner.measure(df, "k", 8)
    assert max(whole.load) == 8000
    plan = partitioner.measure(df, "k", 8, split=True)
    placed = partitioner.repartition_by_weight(df, plan, ["i"])
    assert rows(placed) == rows(df)
    assert max(loads(placed, 8)) < 10_000 / 8 * 4 / 3
    empty = partitioner.repartition_by_weight(df.limit(0), partitioner.measure(df.limit(0), "k", 4))
    assert empty.count() == 0


def close(a, b):
    return a == b or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


def plain(values):
    n = len(values)
    mean = math.fsum(values) / n
    m2, m3, m4 = (math.fsum((x - mean) ** p for x in values) for p in (2, 3, 4))
    return (n, mean, stats.variance(values) if n > 1 else None, math.sqrt(n) * m3 / m2 ** 1.5 if m2 else None, n * m4 / m2 ** 2 - 3 if m2 else None,
            min(values), max(values))


@pytest.mark.parametrize("offset", [0.0, 1e9])
def test_moments_equal_the_plain_form(spark, offset):
    """With a large common offset, sums of squares would have lost all digits."""
    rng = random.Random(5)
    data = [(g, i, offset + rng.gauss(0, 1) ** 2) for g in "abc" for i in range(400 if g != "b" else 3)]
    data += [("d", 1, 7.0), ("e", 1, None), (None, 1, offset + 1.0), (None, 2, offset + 2.0)] + [("f", i, 5.0) for i in range(50)]
    df = spark.createDataFrame(data, "g string, i long, x double")
    got = {r.g: r for r in moments.statistics(moments.moments(df, ["g"], "x", "i"), ["g"]).collect()}
    assert set(got) == {"a", "b", "c", "d", "f", None}
    for g, r in got.items():
        n, mean, variance, skew, kurt, least, most = plain([x for h, _, x in data if h == g and x is not None])
        near = (lambda a, b: close(a, b)) if not offset else (lambda a, b: a == b or abs(a - b) < 1e-5)
        assert r.n == n and close(r["mean"], mean) and near(r.variance, variance) and (r.least, r.most) == (least, most)
        assert near(r.skewness, skew) and near(r.kurtosis, kurt)


def test_stored_states_merge_to_the_whole(spark, tmp_path):
    e = read_table(spark, SF01, "events").withColumn("day", F.to_date("ts"))
    daily = moments.moments(e, ["day", "event_type"], "value", "event_id")
    daily.write.parquet(f"{tmp_path}/daily")
    merged = moments.statistics(moments.merge_moments(spark.read.parquet(f"{tmp_path}/daily"), ["event_type"]), ["event_type"])
    whole = {r.event_type: r for r in moments.statistics(moments.moments(e, ["event_type"], "value", "event_id", salt=1), ["event_type"]).collect()}
    for r in merged.collect():
        assert all(close(r[c], whole[r.event_type][c]) for c in ("n", "mean", "variance", "skewness", "kurtosis", "least", "most"))
    assert moments.moments(e.limit(0), [], "value", "event_id").count() == 0
