"""Sinks, file layout, partition sizing, sorts and reuse."""

import os
import subprocess
import sys

from pyspark.sql import functions as F

from conftest import SF01, rows
from strata.operators import layout
from strata.plans.reuse import cached
from strata.session import scratch_dir
from strata.sources.tables import read_table, table_path


def _files(path):
    p = path.replace("file:", "")
    return [f for f in os.listdir(p) if f.endswith(".parquet")]


def test_write_compacted_gives_exact_file_count(spark):
    o = read_table(spark, SF01, "orders")
    path = scratch_dir(spark, "t-compacted")
    back = layout.write_compacted(o, path, files=3)
    assert len(_files(path)) == 3
    assert rows(back) == rows(o)


def test_write_compacted_sizes_from_data(spark):
    o = read_table(spark, SF01, "orders")
    path2 = scratch_dir(spark, "t-compacted-rebalance")
    assert rows(layout.write_compacted(o.repartition(40), path2)) == rows(o)
    assert 1 <= len(_files(path2)) < 40


def test_uncontrolled_write_and_layout_report(spark):
    o = read_table(spark, SF01, "orders").repartition(6)
    path = scratch_dir(spark, "t-uncontrolled")
    layout.write_uncontrolled(o, path)
    rep = layout.file_layout_report(spark, path)
    assert rep.count() == len(_files(path)) == 6
    s = layout.file_layout_summary(rep).first()
    assert s["rows"] == 15000 and s["files"] == 6 and s["small_files"] == 6


def test_layout_report_of_partitioned_and_empty_files(spark):
    o = read_table(spark, SF01, "orders")
    path = scratch_dir(spark, "t-partitioned")
    o.coalesce(1).write.partitionBy("o_orderstatus").parquet(path)
    o.limit(0).coalesce(1).write.parquet(f"{path}/o_orderstatus=none")
    report = {r["file_path"].split("o_orderstatus=")[1].split("/")[0]: r["rows"] for r in layout.file_layout_report(spark, path).collect()}
    want = {r["o_orderstatus"]: r["count"] for r in o.groupBy("o_orderstatus").count().collect()}
    assert report == {**want, "none": 0}
    assert layout.file_layout_report(spark, path).select("file_path").distinct().count() == len(want) + 1


def test_file_per_value_keeps_rows_and_confs(spark):
    """Nulls and empty strings share a folder, as ever; more values than open files, too."""
    conf = "spark.sql.maxConcurrentOutputFileWriters"
    values = [None, "", "a/b=c", "F"] + [f"v{i}" for i in range(3 * layout.OPEN_FILES)]
    df = spark.createDataFrame([(i, values[i % len(values)]) for i in range(20 * len(values))], "id long, `s.x` string").repartition(5)
    for frame in (df, df.where("id < 0")):
        path, before = scratch_dir(spark, "t-per-value"), spark.conf.get(conf)
        layout.write_file_per_value(frame, path, "s.x")
        assert spark.conf.get(conf) == before
        if frame is df:
            back = spark.read.schema(df.schema).parquet(path).select("id", "`s.x`")
            assert sorted(map(tuple, back.collect()), key=str) == sorted(((i, v or None) for i, v in map(tuple, df.collect())), key=str)
            assert layout.list_files(spark, path, "*.parquet").count() == len(values) - 1


def test_writes_by_status_hold_no_rows_to_sort(tmp_path):
    job = os.path.join(os.path.dirname(os.path.abspath(__file__)), "layout_job.py")
    out = subprocess.run([sys.executable, job, str(tmp_path)], capture_output=True, text=True, timeout=600)
    assert out.returncode == 0 and out.stdout.strip().endswith("OK"), out.stderr[-3000:]


def test_listing_reads_no_content(spark):
    from strata.plans.inspect import plan_text

    t = plan_text(layout.input_bytes(spark, table_path(SF01, "lineitem")))
    assert "content" not in t.split("ReadSchema")[1]


def test_scratch_is_released(spark):
    from strata import session

    kept, session._SCRATCH[:] = list(session._SCRATCH), []
    try:
        path = scratch_dir(spark, "t-released")
        spark.range(3).write.parquet(path)
        assert session.release_scratch(spark) == 1 and not os.path.exists(path.replace("file:", ""))
    finally:
        session._SCRATCH[:] = kept


def test_bucketed_tables_are_written_once(spark):
    from strata.plans.queries import QUERIES

    QUERIES["bucketed_join"](spark, SF01)
    before = {t.name for t in spark.catalog.listTables()}
    QUERIES["bucketed_join"](spark, SF01)
    assert {t.name for t in spark.catalog.listTables()} == before


def test_size_partitions(spark):
    r = layout.size_partitions(spark, table_path(SF01, "lineitem")).first()
    assert r["files"] == 1 and r["input_bytes"] > 0 and r["partitions"] == 4
    r2 = layout.size_partitions(spark, table_path(SF01, "lineitem"), target_bytes=100_000, min_partitions=1).first()
    assert r2["partitions"] == -(-r2["input_bytes"] // 100_000)


def test_repartition_and_row_counts(spark):
    li = read_table(spark, SF01, "lineitem")
    rp = layout.repartition_by_size(li, 5)
    counts = layout.partition_row_counts(rp).collect()
    assert len(counts) == 5 and sum(c["rows"] for c in counts) == 60000
    assert max(c["rows"] for c in counts) - min(c["rows"] for c in counts) <= 5


def test_large_sort_is_ordered_across_partitions(spark):
    li = read_table(spark, SF01, "lineitem")
    s = layout.large_sort(li, "l_extendedprice", num_partitions=6)
    rep = layout.sort_boundary_report(s, "l_extendedprice").collect()
    vals = [r["l_extendedprice"] for r in s.select("l_extendedprice").collect()]
    assert vals == sorted(vals)
    assert len(rep) > 1 and all(r["ordered_after_previous"] for r in rep)
    assert sum(r["rows"] for r in rep) == 60000


def test_write_format_round_trip(spark):
    e = read_table(spark, SF01, "events")
    ntz = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    for fmt, opts in (("parquet", {}), ("orc", {}), ("json", ntz), ("csv", {**ntz, "header": "true"})):
        back = layout.write_format(e, scratch_dir(spark, f"t-{fmt}"), fmt, **opts)
        assert rows(back) == rows(e), fmt


def test_cached_releases(spark):
    e = read_table(spark, SF01, "events").groupBy("user_id").count()
    with cached(e) as c:
        assert c.is_cached and c.count() == 150
    assert not e.is_cached


def test_cached_rollups_equal_checkpointed(spark):
    """The persist/unpersist path gives the same two rollups as the checkpointed one."""
    from pyspark.sql import functions as F

    from strata.plans.reuse import multi_rollup, session_level
    from strata.sources.tables import clickstream

    clicks = clickstream(spark, SF01)
    expected = rows(multi_rollup(clicks).filter("rollup = 'user'").select("key", "sessions", "events"))
    with cached(session_level(clicks)) as sessions:
        users = sessions.groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"), F.sum("c").alias("events"))
        got = rows(users.select(F.col("user_id").cast("string").alias("key"), "sessions", "events"))
        hours = sessions.groupBy("hour_start").count().count()
    assert got == expected and hours > 0
