"""Every physical variant equals its plain form (on sf0.01 tables)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF01, rows
from strata.operators import joins, ranking, rollups, skew
from strata.plans import variants
from strata.plans.inspect import plan_text
from strata.sources.tables import clickstream, read_table, user_dimension


def test_broadcast_equals_shuffle_join(spark):
    fact = clickstream(spark, SF01).select("event_id", "user_id", "revenue")
    dim = user_dimension(spark, SF01)
    a = joins.left_join_broadcast(fact, dim, "user_id")
    b = joins.left_join_shuffle(fact, dim, "user_id")
    assert rows(a) == rows(b.select(*a.columns))


def test_broadcast_falls_back_when_too_big(spark):
    # Half of the events moved onto one user, so the fallback has a hot key to isolate.
    fact = clickstream(spark, SF01).select(
        "event_id", F.when(F.pmod("event_id", F.lit(2)) == 0, F.lit(1).cast("bigint"))
                     .otherwise(F.col("user_id")).alias("user_id"))
    dim = user_dimension(spark, SF01)
    j = joins.left_join_broadcast(fact, dim, "user_id", max_bytes=10)
    plan = plan_text(j)
    assert "LeftAnti" in plan and "Union" in plan   # hot keys isolated, the rest shuffled
    plain_fact = clickstream(spark, SF01).select("event_id", "user_id")
    assert "Union" not in plan_text(joins.left_join_broadcast(plain_fact, dim, "user_id", max_bytes=10))
    assert rows(j) == rows(joins.left_join_shuffle(fact, dim, "user_id").select(*j.columns))
    plain = joins.left_join_broadcast(fact, dim, "user_id", max_bytes=10, skew_safe=False)
    assert rows(plain.select(*j.columns)) == rows(j)


def test_salted_and_hot_key_joins_equal_plain(spark):
    o = read_table(spark, SF01, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = read_table(spark, SF01, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    plain = rows(o.join(c, "o_custkey", "left"))
    assert rows(joins.salted_join(o, c, "o_custkey", ["o_orderkey"], 5, "left").select(*o.columns, "c_name")) == \
        rows(o.join(c, "o_custkey", "left").select(*o.columns, "c_name"))
    hot = joins.hot_keys(o, "o_custkey", share=0.0008, to_typical=0)
    assert hot.count() > 50
    hk = joins.hot_key_join(o, c, "o_custkey", hot, "left")
    assert rows(hk.select("o_custkey", "o_orderkey", "o_totalprice", "c_name")) == \
        rows(o.join(c, "o_custkey", "left").select("o_custkey", "o_orderkey", "o_totalprice", "c_name"))
    assert len(plain) == 15000


def test_skewed_key_join_all_paths_agree(spark):
    li = read_table(spark, SF01, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.pmod("l_orderkey", F.lit(10)) < 8, F.lit(0).cast("bigint")).otherwise(F.col("l_orderkey"))
         .alias("k"))
    c = read_table(spark, SF01, "customer").select(F.col("c_custkey").alias("k"), "c_name")
    base = rows(li.join(c, "k", "left"))
    hot = joins.hot_keys(li, "k")
    assert [r["k"] for r in hot.collect()] == [0]
    assert rows(joins.hot_key_join(li, c, "k", hot, "left").select("k", "l_orderkey", "l_linenumber", "c_name")) == \
        rows(li.join(c, "k", "left").select("k", "l_orderkey", "l_linenumber", "c_name"))
    assert rows(joins.salted_join(li, c, "k", ["l_orderkey", "l_linenumber"], how="left").select("k", "l_orderkey", "l_linenumber", "c_name")) == \
        rows(li.join(c, "k", "left").select("k", "l_orderkey", "l_linenumber", "c_name"))
    assert len(base) == 60000


def test_salted_and_split_aggregates_equal_direct(spark):
    c = clickstream(spark, SF01)
    direct = rows(rollups.skew_user_stats(c))
    assert rows(skew.salted_user_stats(c, 10)) == direct
    assert rows(skew.hot_key_split_union(c, "user_id", 10)) == direct
    hot = joins.hot_keys(c, "user_id", share=0.005, to_typical=0)
    assert hot.count() > 0
    assert rows(skew.hot_key_split_union(c, "user_id", 7, hot=hot)) == direct


def test_composite_key_repartition_equals_direct(spark):
    li = read_table(spark, SF01, "lineitem")
    direct = rows(skew.direct_key_sums(li, "l_suppkey", "l_extendedprice"))
    assert rows(skew.composite_key_repartition(li, "l_suppkey", "l_extendedprice", "l_orderkey", 8)) == direct
    assert rows(skew.composite_key_repartition(li, "l_suppkey", "l_extendedprice", "l_orderkey", 8,
                                               explicit_repartition=True)) == direct


def test_global_ranks_equal_window_functions(spark):
    o = read_table(spark, SF01, "orders")
    c = o.groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("ltv"))
    w_rank = Window.orderBy(F.col("ltv").desc(), "user_id")
    ref = c.select("user_id", F.row_number().over(w_rank).alias("r"),
                   F.percent_rank().over(Window.orderBy("ltv")).alias("p"))
    for parts in (1, 3, 16):
        r = ranking.global_row_number(c, "ltv", "user_id", True, "r", num_partitions=parts)
        p = ranking.global_percent_rank(c, "ltv", "user_id", "p", num_partitions=parts)
        got = r.select("user_id", "r").join(p.select("user_id", "p"), "user_id")
        assert rows(got, "user_id", "r", "p") == rows(ref, "user_id", "r", "p"), parts


def test_percent_rank_with_a_hot_value(spark):
    """A value held by 80 % of rows runs over most partitions and stays exact."""
    li = read_table(spark, SF01, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.when(F.pmod("l_orderkey", F.lit(10)) < 8, F.lit(0)).otherwise(F.col("l_partkey")).alias("v"))
    p = ranking.global_percent_rank(li, "v", "id", "p", num_partitions=8)
    ref = li.select("id", F.percent_rank().over(Window.orderBy("v")).alias("p"))
    assert rows(p, "id", "p") == rows(ref, "id", "p")


def test_top_k_equals_window(spark):
    c = clickstream(spark, SF01)
    p = rollups.user_profiles(c)
    top = ranking.top_k_ranked(p, "lifetime_value", "user_id", 25)
    plain = variants.top_users_ranked_single_partition(spark, SF01, 25)
    assert rows(top, "user_id", "user_rank", "ltv_percentile") == \
        rows(plain, "user_id", "user_rank", "ltv_percentile")


def test_approx_distinct_mergeable_close_to_exact(spark):
    e = read_table(spark, SF01, "events")
    approx = {r[0]: r[1] for r in skew.approx_distinct_mergeable(e, "event_type", "user_id").collect()}
    exact = {r[0]: r[1] for r in e.groupBy("event_type").agg(F.countDistinct("user_id")).collect()}
    assert approx.keys() == exact.keys()
    for k in exact:
        assert abs(approx[k] - exact[k]) <= 0.03 * exact[k]


def test_hot_key_join_with_duplicate_small_keys(spark):
    """Not-unique small side: measured, and salted when too big to broadcast."""
    o = read_table(spark, SF01, "orders").select("o_orderkey", "o_custkey")
    dup = read_table(spark, SF01, "orders").select("o_custkey", F.col("o_orderkey").alias("other"))
    hot = joins.hot_keys(o, "o_custkey", share=0.0005, to_typical=0)
    plain = rows(o.join(dup, "o_custkey").select("o_custkey", "o_orderkey", "other"))
    for max_bytes in (10, 1 << 30):
        j = joins.hot_key_join(o, dup, "o_custkey", hot, "inner", max_bytes=max_bytes, row_key=["o_orderkey"])
        assert rows(j.select("o_custkey", "o_orderkey", "other")) == plain


def test_scenarios_plain_and_tuned_agree(spark):
    from strata.plans import scenarios as sc

    for name in ("memory", "shuffle", "broadcast", "ranking"):
        clicks = sc.generated_clicks(spark, 20000, name, 4)
        plain, tuned = sc.SCENARIOS[name](clicks, "plain"), sc.SCENARIOS[name](clicks, "tuned")
        for out in plain:
            cols = [c for c in plain[out].columns if c in tuned[out].columns
                    and c not in ("event_types", "session_id", "avg_revenue")]
            if name == "memory" and out == "top_users":   # the plain shape ranks ties arbitrarily
                cols = [c for c in cols if c != "user_rank"]
            a = [tuple(float(x) if hasattr(x, "as_tuple") else x for x in r) for r in plain[out].select(*cols).collect()]
            b = [tuple(float(x) if hasattr(x, "as_tuple") else x for x in r) for r in tuned[out].select(*cols).collect()]
            assert sorted(a, key=str) == sorted(b, key=str), (name, out)


def test_size_check_measures(spark):
    li = read_table(spark, SF01, "lineitem")
    assert joins.estimate_size_bytes(li) > 1_000_000
    _, ok = joins.broadcast_if_bounded(li, max_bytes=10_000)
    assert not ok
    _, ok = joins.broadcast_if_bounded(read_table(spark, SF01, "nation"), max_bytes=10_000)
    assert ok
    assert joins.estimate_size_bytes(li.limit(0)) == 0
    # Nested columns count what they hold.
    wide = spark.range(100).select("id", F.sequence(F.lit(1), F.lit(1000)).cast("array<double>").alias("v"))
    assert joins.estimate_size_bytes(wide) >= 100 * 1000 * 8
    _, ok = joins.broadcast_if_bounded(wide, max_bytes=400_000)
    assert not ok


def test_skew_joins_refuse_what_they_cannot_do(spark):
    o = read_table(spark, SF01, "orders").select("o_orderkey", "o_custkey")
    c = read_table(spark, SF01, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    for how in ("right", "full", "left_anti"):
        with pytest.raises(ValueError):
            joins.hot_key_join(o, c, "o_custkey", joins.hot_keys(o, "o_custkey"), how)
        with pytest.raises(ValueError):
            joins.salted_join(o, c, "o_custkey", ["o_orderkey"], 4, how)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_null_keys_stay_out_of_the_shuffle(spark, how):
    """80 % NULL keys, a hot key among the rest, and rows that are all alike."""
    big = spark.range(1000).select(
        F.when(F.col("id") % 10 < 8, F.lit(None)).when(F.col("id") % 10 == 8, 0).otherwise(F.col("id")).cast("bigint").alias("k"),
        F.col("id").alias("row"), F.lit("same").alias("x"))
    small = spark.createDataFrame([(0, "zero"), (9, "nine"), (None, "null")], "k bigint, name string")
    want = rows(big.join(small, "k", how).select("k", "row", "x", "name"))
    hot = joins.hot_keys(big, "k", share=0.05)
    assert [r["k"] for r in hot.collect()] == [0]       # NULL is no hot key
    j = joins.hot_key_join(big, small, "k", hot, how, row_key=["row"])
    assert rows(j.select("k", "row", "x", "name")) == want
    s = joins.salted_join(big, small, "k", ["row"], how=how)
    assert rows(s.select("k", "row", "x", "name")) == want
    assert "BroadcastHashJoin" in plan_text(j) and "Union" in plan_text(j)


def test_salt_follows_the_largest_share(spark):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    even = spark.range(10_000).select((F.col("id") % 1000).alias("k"))
    assert joins.salt_buckets(even, "k") == 1
    skewed = spark.range(10_000).select(F.when(F.col("id") < 5000, 0).otherwise(F.col("id")).alias("k"))
    assert joins.salt_buckets(skewed, "k") == parts // 2
    assert joins.hot_keys(even, "k", share=0.0005).count() == 0     # over the share, but not over the median


def test_registered_skew_queries_take_their_skew_path(spark):
    from strata.plans.queries import QUERIES

    for partitions in ("4", "64"):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            assert "Union" in plan_text(QUERIES["hot_key_broadcast_join"](spark, SF01))
            assert "Union" in plan_text(QUERIES["hot_key_split_union"](spark, SF01))
            c = clickstream(spark, SF01)
            assert joins.salt_buckets(c, "revenue") > int(partitions) // 2
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
