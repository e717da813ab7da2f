"""Physical plan shapes: broadcast where bounded, no exchange for buckets,
nothing unbounded in one partition, pushdown, AQE coalescing and skew split."""

from pyspark.sql import functions as F

from conftest import SF01
from strata.operators import joins
from strata.plans import variants
from strata.plans.inspect import count_nodes, plan_text, single_partition_exchanges_are_global_aggregates
from strata.plans.queries import QUERIES


def _run(df):
    df.collect()  # act on this plan itself, so explain shows the final adaptive plan
    return plan_text(df)


def test_broadcast_join_plan(spark):
    t = _run(QUERIES["left_join_broadcast"](spark, SF01))
    assert "BroadcastHashJoin" in t and "SortMergeJoin" not in t


def test_shuffle_join_plan(spark):
    t = _run(QUERIES["left_join_shuffle"](spark, SF01))
    assert "SortMergeJoin" in t


def test_bucketed_join_has_no_exchange(spark):
    t = _run(QUERIES["bucketed_join"](spark, SF01))
    assert "SortMergeJoin" in t
    assert count_nodes(t, "Exchange") == 0


def test_flagship_has_no_unbounded_single_partition(spark):
    ours = _run(QUERIES["top_users_ranked"](spark, SF01))
    assert "TakeOrderedAndProject" in ours
    assert single_partition_exchanges_are_global_aggregates(ours)
    plain = _run(variants.top_users_ranked_single_partition(spark, SF01))
    assert not single_partition_exchanges_are_global_aggregates(plain)


def test_full_rank_plan_broadcasts_only_bounded_tables(spark):
    t = _run(QUERIES["user_rank"](spark, SF01))
    assert single_partition_exchanges_are_global_aggregates(t, allow_partition_counts=True)
    assert not single_partition_exchanges_are_global_aggregates(t)
    assert "Window" in t  # only over the one-row-per-partition offsets


def test_pushdown_and_pruning(spark):
    t = plan_text(QUERIES["multi_stage_rollup"](spark, SF01), "formatted")
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)" in t
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double,l_returnflag:string>" in t
    t2 = plan_text(QUERIES["user_stats_basic"](spark, SF01), "formatted")
    assert "props" not in t2.split("ReadSchema:")[1].splitlines()[0]


def test_partial_aggregation_before_every_exchange(spark):
    t = _run(QUERIES["user_stats"](spark, SF01))
    lines = t.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            assert "HashAggregate" in lines[i + 1] or "ObjectHashAggregate" in lines[i + 1], lines[i + 1]


def test_aqe_coalesces_small_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        t = _run(QUERIES["multi_stage_rollup"](spark, SF01))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert "AQEShuffleRead coalesced" in t


def test_aqe_splits_the_skewed_join_partition(spark):
    confs = {"spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        from strata.sources.tables import read_table

        li = (read_table(spark, SF01, "lineitem").repartition(16)
              .select("l_orderkey", "l_linenumber",
                      F.when(F.pmod("l_orderkey", F.lit(10)) < 8, F.lit(0).cast("bigint"))
                       .otherwise(F.col("l_orderkey")).alias("k")))
        c = read_table(spark, SF01, "customer").select(F.col("c_custkey").alias("k"), "c_name")
        t = _run(li.join(c.hint("merge"), "k", "left"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in t


def test_hot_key_join_broadcasts_only_the_hot_part(spark):
    from strata.sources.tables import read_table

    o = read_table(spark, SF01, "orders").select("o_orderkey", "o_custkey")
    c = read_table(spark, SF01, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    t = _run(joins.hot_key_join(o, c, "o_custkey", joins.hot_keys(o, "o_custkey", share=0.0005, to_typical=0), "inner"))
    assert "LeftSemi" in t and "LeftAnti" in t and "Union" in t


def test_size_check_gathers_no_rows(spark):
    """The measuring aggregate is partial below its one-task end: nothing else goes to a single partition."""
    from strata.sources.tables import user_dimension

    dim = user_dimension(spark, SF01)
    t = _run(dim.agg(F.sum(F.octet_length("country"))))
    assert single_partition_exchanges_are_global_aggregates(t)
    import inspect

    assert "limit(" not in inspect.getsource(joins.estimate_size_bytes) + inspect.getsource(joins.broadcast_if_bounded)


def test_top_joined_events_limit_before_the_join(spark):
    t = _run(QUERIES["top_joined_events"](spark, SF01))
    final = t.split("== Initial Plan ==")[0]
    assert "SortMergeJoin" not in final and "TakeOrderedAndProject" in final
    assert final.index("BroadcastHashJoin") < final.rindex("TakeOrderedAndProject")


def test_percent_rank_joins_no_rows_on_their_value(spark):
    """After the checkpoint of the sorted rows neither a join on values nor another shuffle follows."""
    t = _run(QUERIES["ltv_percentile"](spark, SF01)).split("== Initial Plan ==")[0]
    assert "SortMergeJoin" not in t and "hashpartitioning" not in t and "BroadcastHashJoin" in t


def test_bucketed_write_has_one_file_per_bucket(spark):
    import os

    from strata.session import scratch_dir
    from strata.sources.tables import read_table

    path = scratch_dir(spark, "t-bucketed")
    li = read_table(spark, SF01, "lineitem").repartition(5)
    joins.write_bucketed(li, "strata_t_bucketed", "l_orderkey", 4, path)
    files = [f for f in os.listdir(path.replace("file:", "")) if f.endswith(".parquet")]
    assert len(files) == 4


def test_composite_key_aggregates_before_its_exchange(spark):
    t = _run(QUERIES["composite_key_repartition"](spark, SF01))
    lines = t.splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert exchanges
    for i in exchanges:
        assert "HashAggregate" in lines[i + 1] and "partial_" in lines[i + 1], lines[i + 1]


def test_enriched_sessions_use_a_window_not_a_join(spark):
    t = _run(QUERIES["filter_positive_sessions"](spark, SF01))
    assert "Window" in t and "Join" not in t
    assert count_nodes(t.split("== Initial Plan ==")[0], "Exchange") == 2
