"""The command line runs in-process on the test session."""

import os

from strata import cli
from strata.session import scratch_dir

FX = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")


def test_generate_and_save(spark, capsys):
    out = scratch_dir(spark, "cli-gen")
    cli.main(["generate", "transactions", "1234", out, "--partitions", "3"])
    assert spark.read.parquet(out).count() == 1234
    assert "transaction_id" in capsys.readouterr().out


def test_scenario_and_runlog(spark, capsys):
    cli.main(["scenario", "skew", "--rows", "5000", "--show", "2"])
    text = capsys.readouterr().out
    assert "== skew_report" in text and "skew (tuned, 5000 rows)" in text
    cli.main(["runlog", os.path.join(FX, "eventlog_before.jsonl"), os.path.join(FX, "eventlog_after.jsonl")])
    text = capsys.readouterr().out
    assert "clickstream-rollup" in text and "change_pct" in text
