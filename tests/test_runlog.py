"""Run metrics from the committed event-log fixtures."""

import os

import pytest

from strata.operators import runlog
from strata.sources.eventlog import read_event_log

FX = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")
BEFORE, AFTER = os.path.join(FX, "eventlog_before.jsonl"), os.path.join(FX, "eventlog_after.jsonl")
MB = 1024 ** 2


@pytest.fixture(scope="module")
def before(spark):
    return read_event_log(spark, BEFORE)


def test_stage_metrics(before):
    st = {r["stage_id"]: r for r in runlog.stage_metrics(before).collect()}
    assert st[0]["tasks"] == 8 and st[0]["shuffle_write_bytes"] == 80 * MB
    assert st[1]["tasks"] == 5 and st[1]["failed_tasks"] == 1
    assert st[1]["disk_spilled_bytes"] == 120 * MB and st[1]["memory_spilled_bytes"] == 300 * MB
    assert st[1]["shuffle_read_bytes"] == 80 * MB and st[1]["peak_execution_memory"] == 950 * MB


def test_task_skew_flags_the_slow_stage(before):
    sk = {r["stage_id"]: r for r in runlog.task_skew(before).collect()}
    assert sk[0]["max_task_ms"] == 1500 and sk[0]["median_task_ms"] == 100 and sk[0]["skewed"]
    assert not sk[1]["skewed"] and sk[1]["tasks"] == 4


def test_executor_memory_and_warnings(before):
    ex = {r["executor_id"]: r for r in runlog.executor_memory(before).collect()}
    assert ex["1"]["memory_utilisation_pct"] == pytest.approx(92.77)
    assert ex["2"]["failed_tasks"] == 1
    w = {r["executor_id"]: r["warning"] for r in runlog.memory_warnings(before).collect()}
    assert "high memory utilisation" in w["1"] and "disk spill" in w["1"]
    assert w["2"] == "failed tasks"


def test_app_summary_and_compare(spark, before):
    b = runlog.app_summary(before)
    a = runlog.app_summary(read_event_log(spark, AFTER))
    rb = b.first()
    assert (rb["app_name"], rb["status"], rb["duration_sec"], rb["tasks"], rb["records"]) == \
        ("clickstream-rollup", "SUCCESS", 3.1, 13, 8000)
    cmp = {r["metric"]: r for r in runlog.compare(b, a).collect()}
    assert cmp["duration_sec"]["change_pct"] == -50.0
    assert cmp["disk_spill_gb"]["after"] == 0.0 and cmp["failed_tasks"]["before"] == 1.0
    assert set(cmp) == set(runlog.COMPARED)


def test_two_logs_read_together(spark):
    both = read_event_log(spark, [BEFORE, AFTER])
    assert runlog.app_summary(both).count() == 2
    assert runlog.stage_metrics(both).count() == 4


def test_rolling_log_is_one_application(spark, before):
    rolled = read_event_log(spark, os.path.join(FX, "eventlog_v2_app-before"))
    s = runlog.app_summary(rolled).collect()
    assert len(s) == 1 and s[0]["log_path"].endswith("eventlog_v2_app-before")
    plain = runlog.app_summary(before).first()
    for col in ("status", "duration_sec", "tasks", "failed_tasks", "records", "memory_utilisation_pct", "gc_pct"):
        assert s[0][col] == plain[col], col
