"""Generator properties: exact counts, partition independence, skew shape, columns."""

from pyspark.sql import functions as F

from conftest import rows
from strata.sources import generators as gen


def test_exact_row_count_not_multiple_of_partitions(spark):
    assert gen.gen_clickstream(gen.ids(spark, 1003, 7)).count() == 1003
    assert gen.gen_transactions(gen.ids(spark, 20_000_000 // 1000 + 5, 29)).count() == 20005


def test_same_rows_for_any_partition_count(spark):
    a = gen.gen_clickstream(gen.ids(spark, 500, 1))
    b = gen.gen_clickstream(gen.ids(spark, 500, 13))
    assert rows(a) == rows(b)
    assert rows(gen.gen_transactions(gen.ids(spark, 300, 2))) == rows(gen.gen_transactions(gen.ids(spark, 300, 9)))


def test_hot_key_share(spark):
    df = gen.gen_clickstream(gen.ids(spark, 20000, 8), hot_fraction=0.8, hot_keys=1)
    share = df.filter("user_id = 0").count() / 20000
    assert 0.78 < share < 0.82
    uniform = gen.gen_clickstream(gen.ids(spark, 20000, 8), hot_fraction=0.0, hot_keys=1000)
    assert uniform.filter("user_id < 1000").count() == 0


def test_clickstream_columns(spark):
    df = gen.gen_clickstream(gen.ids(spark, 5000, 4))
    assert df.columns == ["record_id", "timestamp", "user_id", "event_type", "session_id", "page_url", "revenue"]
    assert {r[0] for r in df.select("event_type").distinct().collect()} == set(gen.EVENT_TYPES_GENERATED)
    assert df.filter("event_type <> 'purchase' AND revenue <> 0").count() == 0
    assert df.filter("revenue < 0 OR revenue >= 1000").count() == 0
    bad = df.filter(F.col("session_id") != F.concat(F.lit("session_"), F.col("user_id").cast("string"), F.lit("_"),
                                                    F.floor(F.col("timestamp") / 3600000).cast("string")))
    assert bad.count() == 0
    span = df.agg(F.min("timestamp"), F.max("timestamp")).first()
    assert gen.BASE_MS - gen.DAY_MS < span[0] and span[1] <= gen.BASE_MS


def test_transactions_amount_and_ranges(spark):
    df = gen.gen_transactions(gen.ids(spark, 5000, 4))
    assert df.filter(F.col("amount") != F.col("quantity") * F.col("price")).count() == 0
    r = df.agg(F.min("quantity"), F.max("quantity"), F.min("price"), F.max("price"), F.min("timestamp")).first()
    assert (r[0], r[1]) == (1, 10) and r[2] >= 10.0 and r[3] < 510.0
    assert r[4] >= gen.BASE_MS - 30 * gen.DAY_MS


def test_wide_table_one_select(spark):
    df = gen.generate(spark, "wide", 100, 3, columns=7)
    assert df.columns == ["id", "base_value"] + [f"col_{i}" for i in range(1, 8)]
    assert df.filter(F.col("col_7") != F.col("base_value") + 7).count() == 0


def test_presets_and_dispatch(spark):
    assert gen.resolve_size("small") == 1_000_000 and gen.resolve_size("xlarge") == 100_000_000
    assert gen.resolve_size(1234) == 1234 and gen.resolve_size("77") == 77
    assert gen.generate(spark, "unknown-kind", 10).columns[0] == "record_id"
    assert gen.generate(spark, "transactions", 10).count() == 10


def test_user_dim_and_row_expand(spark):
    d = gen.gen_user_dim(gen.ids(spark, 1000, 3))
    r = d.agg(F.min("user_age"), F.max("user_age"), F.countDistinct("user_tier")).first()
    assert r[0] >= 0 and r[1] <= 99 and r[2] == 1
    e = gen.row_expand(gen.ids(spark, 10, 2), F.col("id") + 1)
    assert e.count() == sum(range(1, 11))
