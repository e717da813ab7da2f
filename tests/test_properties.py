"""Property tests on random small inputs (many ties, NULL-free values)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import EVENTS_DDL, rows
from strata.operators import ranking, rollups, skew
from strata.sources.tables import with_session_columns

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

values = st.lists(st.integers(min_value=0, max_value=6), min_size=1, max_size=60)


@SETTINGS
@given(vals=values, parts=st.integers(min_value=1, max_value=7))
def test_distributed_ranks_equal_windows(spark, vals, parts):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id bigint, v bigint")
    ref = df.select("id", F.row_number().over(Window.orderBy(F.col("v").desc(), "id")).alias("r"),
                    F.percent_rank().over(Window.orderBy("v")).alias("p"))
    r = ranking.global_row_number(df, "v", "id", True, "r", num_partitions=parts)
    p = ranking.global_percent_rank(df, "v", "id", "p", num_partitions=parts)
    got = r.select("id", "r").join(p.select("id", "p"), "id")
    assert rows(got, "id", "r", "p") == rows(ref, "id", "r", "p")


@SETTINGS
@given(vals=values, k=st.integers(min_value=1, max_value=20))
def test_top_k_equals_window(spark, vals, k):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id bigint, v bigint")
    ref = (df.select("id", F.row_number().over(Window.orderBy(F.col("v").desc(), "id")).alias("r"),
                     F.percent_rank().over(Window.orderBy("v")).alias("p"))
             .filter(F.col("r") <= k))
    got = ranking.top_k_ranked(df, "v", "id", k, "r", "p", materialize=False)
    assert rows(got, "id", "r", "p") == rows(ref, "id", "r", "p")


events = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 47), st.sampled_from(["view", "click", "purchase"]),
                            st.integers(0, 500)), min_size=1, max_size=80)


@SETTINGS
@given(evs=events, salt=st.integers(min_value=1, max_value=9))
def test_salted_and_split_equal_direct(spark, evs, salt):
    base = dt.datetime(2024, 1, 1)
    data = [(i, base + dt.timedelta(minutes=30 * h), u, t, c / 100.0) for i, (u, h, t, c) in enumerate(evs)]
    clicks = with_session_columns(spark.createDataFrame(data, EVENTS_DDL))
    direct = rows(rollups.skew_user_stats(clicks))
    assert rows(skew.salted_user_stats(clicks, salt)) == direct
    from strata.operators.joins import hot_keys

    assert rows(skew.hot_key_split_union(clicks, "user_id", salt, hot=hot_keys(clicks, "user_id", share=0.1))) == direct


@SETTINGS
@given(evs=events, parts=st.integers(min_value=1, max_value=7))
def test_positions_equal_row_number(spark, evs, parts):
    df = spark.createDataFrame([(i, None if u == 5 else u, h, t) for i, (u, h, t, _) in enumerate(evs)],
                               "id bigint, u int, h int, t string")
    want = df.select("id", F.row_number().over(Window.partitionBy("u", "t").orderBy("h", "id")).alias("position"))
    got = ranking.numbered_within(df, ["u", "t"], ["h", "id"], num_partitions=parts)
    assert rows(got, "id", "position") == rows(want)


@SETTINGS
@given(keys=st.lists(st.integers(min_value=0, max_value=12), min_size=1, max_size=120))
def test_skew_report_equals_brute_force(spark, keys):
    import statistics
    from collections import Counter

    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    r = skew.skew_report(df, "k").first()
    counts = sorted(Counter(keys).values())
    assert (r["keys"], r["rows"], r["max_count"]) == (len(counts), len(keys), max(counts))
    assert r["median_count"] == float(statistics.median(counts))
    assert r["max_share_pct"] == float(
        __import__("decimal").Decimal(100 * max(counts)) .__truediv__(len(keys))
        .quantize(__import__("decimal").Decimal("0.01"), rounding="ROUND_HALF_UP"))


@SETTINGS
@given(evs=events, salt=st.integers(min_value=1, max_value=9))
def test_array_set_merge_equals_python_sets(spark, evs, salt):
    base = dt.datetime(2024, 1, 1)
    data = [(i, base + dt.timedelta(minutes=30 * h), u, t, c / 100.0) for i, (u, h, t, c) in enumerate(evs)]
    clicks = with_session_columns(spark.createDataFrame(data, EVENTS_DDL))
    want = {}
    for u, _, t, _ in evs:
        want.setdefault(u, set()).add(t)
    got = {r["user_id"]: (r["event_types"], r["type_count"]) for r in skew.array_set_merge_by(clicks, "user_id", salt).collect()}
    assert got == {u: (sorted(ts), len(ts)) for u, ts in want.items()}
