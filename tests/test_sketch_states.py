"""Quantile sketches, stored distinct counts, compaction in place, sizes before writing."""

import os

import pytest
from conftest import SF01, rows
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from strata.operators import layout, quantiles, ranking, states
from strata.session import scratch_dir
from strata.sources.tables import read_table

K = 512


def worst(df, value, key, k=K):
    both = ranking.global_percent_rank(quantiles.approx_percent_rank(df, value, "near", k), value, key, "exact")
    assert both.where("near is null or near < 0 or near > 1").count() == 0
    return both.agg(F.max(F.abs(F.col("near") - F.col("exact")))).first()[0]


def test_ranks_keep_the_bound(spark):
    li = read_table(spark, SF01, "lineitem").select("l_extendedprice", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"))
    assert worst(li, "l_extendedprice", "k") <= quantiles.rank_error(K)
    # A value that most rows hold, nulls, and values on both sides of it.
    v = F.when(F.col("k") % 3 > 0, F.lit(30_000.0)).when(F.col("k") % 30 == 0, F.lit(None)).otherwise(F.col("l_extendedprice"))
    assert worst(li.withColumn("v", v), "v", "k") <= quantiles.rank_error(K)
    plan = quantiles.approx_percent_rank(li, "l_extendedprice")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Exchange" not in plan


def test_ranks_of_few_rows(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 2), (2.0, 3), (None, 4), (9.0, 5)], "v double, k int")
    exact = {r.k: r.e for r in ranking.global_percent_rank(df, "v", "k", "e").collect()}
    got = {r.k: r.percent_rank for r in quantiles.approx_percent_rank(df, "v").collect()}
    assert all(abs(got[k] - exact[k]) < 0.01 for k in got)
    assert [r.percent_rank for r in quantiles.approx_percent_rank(df.limit(1), "v").collect()] == [0.0]
    assert quantiles.approx_percent_rank(df.limit(0), "v").count() == 0
    assert [r.percent_rank for r in quantiles.approx_percent_rank(df.where("v is null"), "v").collect()] == [0.0]


def test_stored_quantile_sketches_merge(spark):
    e = read_table(spark, SF01, "events").withColumn("day", F.to_date("ts"))
    merged = quantiles.merged_sketch(quantiles.quantile_sketch(e, "value", K, by=["day", "event_type"]), ["event_type"], K)
    for r in quantiles.quantiles(merged, [0.1, 0.5, 0.9]).collect():
        mine = sorted(x.value for x in e.where(F.col("event_type") == r.event_type).collect())
        assert r.n == len(mine)
        for q, v in zip((0.1, 0.5, 0.9), r.quantiles):
            assert abs(sum(x < v for x in mine) / len(mine) - q) <= quantiles.rank_error(K)


def test_days_merge_to_the_full_build(spark):
    e = read_table(spark, SF01, "events").withColumn("day", F.to_date("ts"))
    days = sorted(r.day for r in e.select("day").distinct().collect())
    path = scratch_dir(spark, "state")
    states.add_days(e.where(F.col("day") < days[10]), path, "day", "event_type", "user_id")
    old = {f: os.path.getmtime(f) for f in _files(path)}
    state = states.add_days(e.where(F.col("day") >= days[10]), path, "day", "event_type", "user_id")
    assert all(os.path.getmtime(f) == t for f, t in old.items())          # old days aren't written again
    counts, shared = rows(states.distinct_counts(state)), rows(states.overlaps(state))
    again = states.add_days(e.where(F.col("day") == days[12]), path, "day", "event_type", "user_id")
    full = states.daily_sketches(e, "day", "event_type", "user_id")
    assert counts == rows(states.distinct_counts(again)) == rows(states.distinct_counts(full))
    assert shared == rows(states.overlaps(again)) == rows(states.overlaps(full))
    some = states.distinct_counts(again, F.col("day") < F.lit(days[3])).collect()
    exact = {r.event_type: r.n for r in e.where(F.col("day") < F.lit(days[3])).groupBy("event_type").agg(F.count_distinct("user_id").alias("n")).collect()}
    assert all(abs(r.approx_distinct - exact[r.group]) <= max(1, exact[r.group] * states.HLL_ERROR) for r in some)


def test_overlaps_of_large_groups(spark):
    df = spark.range(60_000).select(F.lit(1).alias("day"), F.expr("case when id < 40000 then 'a' else 'b' end").alias("g"), (F.col("id") % 30_000).alias("u"))
    df = df.unionByName(spark.createDataFrame([(1, None, 5), (1, "c", None), (1, "c", 7)], "day int, g string, u long"))
    got = {(r.a, r.b): (r.approx_shared, r.approx_either) for r in states.overlaps(states.daily_sketches(df, "day", "g", "u")).collect()}
    # a holds 0..29999, b holds 10000..29999, c holds 7
    assert set(got) == {("a", "b"), ("a", "c"), ("b", "c")}
    assert abs(got["a", "b"][0] - 20_000) <= 30_000 * states.THETA_ERROR and abs(got["a", "b"][1] - 30_000) <= 30_000 * states.THETA_ERROR
    assert got["b", "c"][0] <= 30_000 * states.THETA_ERROR


def _files(path):
    path = path.replace("file:", "")
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet") and "/_" not in d)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 120), max_size=80), st.integers(1, 100))
def test_first_fit_decreasing(sizes, room):
    bins = layout.first_fit_decreasing(sizes, room)
    free, want = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = next((b for b, f in enumerate(free) if f >= min(sizes[i], room)), None)
        if at is None:
            at = len(free)
            free.append(room)
        free[at] -= sizes[i]
        want[i] = at
    assert bins == [want[i] for i in range(len(sizes))]


@pytest.mark.parametrize("partitioned", [False, True])
def test_compaction_in_place(spark, partitioned):
    orders = read_table(spark, SF01, "orders")
    path = scratch_dir(spark, "many-files")
    def write(df, mode):
        w = df.write.mode(mode)
        (w.partitionBy("o_orderstatus") if partitioned else w).parquet(path)
    write(orders.where("o_orderkey % 2 = 0").repartition(1), "overwrite")
    write(orders.where("o_orderkey % 2 = 1").repartition(25), "append")
    before = {f: os.path.getsize(f) for f in _files(path)}
    small = sorted(before.values())[-3 if partitioned else -1]      # larger than every file of the second write
    large = {f: os.path.getmtime(f) for f, n in before.items() if n >= small}
    target = 40_000
    plan = layout.packing_plan(spark, path, target, small).collect()
    bins = {}
    for r in plan:
        bins.setdefault((r.folder, r.bin), []).append(r.file_size)
    assert all(len(b) > 1 and sum(b) <= target for b in bins.values())
    layout.compact_folder(spark, path, target, small)
    after = _files(path)
    assert len(after) == len(before) - len(plan) + len(bins)
    assert all(f in after and os.path.getmtime(f) == t for f, t in large.items())
    assert rows(spark.read.parquet(path).select(orders.columns)) == rows(orders)
    assert not [f for f in os.listdir(path.replace("file:", "")) if f.startswith("_comp")]
    assert layout.compact_folder(spark, path, 1, small).count() == 0


def test_an_interrupted_compaction_is_completed(spark, monkeypatch):
    orders = read_table(spark, SF01, "orders")
    path = scratch_dir(spark, "interrupted")
    orders.repartition(12).write.parquet(path)
    finish = layout.finish_compactions
    calls = []
    monkeypatch.setattr(layout, "finish_compactions", lambda *a: calls.append(a) or (finish(*a) if len(calls) == 1 else 0))
    layout.compact_folder(spark, path)
    monkeypatch.undo()
    assert rows(spark.read.parquet(path)) == rows(orders) and len(_files(path)) == 12      # nothing moved in yet
    assert layout.finish_compactions(spark, path) == 1 and layout.finish_compactions(spark, path) == 0
    assert rows(spark.read.parquet(path)) == rows(orders) and len(_files(path)) == 1
    # One that ended before its list was whole is dropped.
    os.makedirs(f"{path.replace('file:', '')}/_compaction-x/new")
    assert layout.finish_compactions(spark, path) == 0 and rows(spark.read.parquet(path)) == rows(orders)


def _written(spark, df, name):
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return sum(os.path.getsize(f) for f in _files(path))


@pytest.mark.parametrize("sample", [layout.SAMPLE_ROWS, 16_384])
def test_size_estimates(spark, sample):
    li, o = read_table(spark, SF01, "lineitem"), read_table(spark, SF01, "orders")
    for name, df in (("li", li), ("o", o.withColumn("d", F.col("o_totalprice").cast("decimal(18,2)"))),
                     ("docs", read_table(spark, SF01, "documents"))):
        r = layout.estimate_written(df, sample).first()
        real = _written(spark, df, f"size-{name}")
        assert r.rows == df.count() and abs(r.bytes - real) <= 0.2 * real, (name, r, real)
    none = layout.estimate_written(li.limit(0)).first()
    assert (none["rows"], none["bytes"], none["error"]) == (0, 0, None)


def test_files_of_the_wanted_size(spark):
    li = read_table(spark, SF01, "lineitem")
    path = scratch_dir(spark, "sized")
    size = layout.estimate_written(li).first()["bytes"]
    assert rows(layout.write_sized(li, path, target_bytes=size // 5 + 1)) == rows(li) and len(_files(path)) == 5


def test_order_is_proved(spark):
    li = read_table(spark, SF01, "lineitem")
    cols = ["l_shipdate", "l_orderkey", "l_linenumber"]
    report = lambda df, c=cols: tuple(layout.sort_order_report(df, c).first())
    assert report(layout.large_sort(li, *cols)) == (60000, True)
    assert report(li) == (60000, False)
    assert report(layout.large_sort(li, *cols).limit(0)) == (0, True)
    ties = spark.createDataFrame([(None,), (None,), (1,), (1,), (2,)], "k int").coalesce(1)
    assert report(ties, ["k"]) == (5, True) and report(ties.orderBy(F.desc("k")).coalesce(1), ["k"]) == (5, False)
    # Sorted inside, but the partitions are the wrong way round.
    parts = spark.createDataFrame([(i,) for i in range(100)], "k int").repartitionById(4, (3 - F.col("k") / 25).cast("int")).sortWithinPartitions("k")
    assert report(parts, ["k"]) == (100, False)


def test_consecutive_ids(spark):
    df = spark.range(0, 1000, 1, 7).where("id % 3 = 0 or id > 900").withColumnRenamed("id", "x")
    for pinned in (True, False):
        got = ranking.consecutive_ids(df, "n", 5, pinned).collect()
        assert sorted(r.n for r in got) == list(range(5, 5 + df.count()))
        assert [r.x for r in sorted(got, key=lambda r: r.n)] == [r.x for r in df.collect()]
    assert ranking.consecutive_ids(df.limit(0)).count() == 0
