"""Command line: generate-and-save, the five jobs (plain or tuned), run metrics.

    python -m strata.cli generate clickstream small /data/clicks [--format parquet]
    python -m strata.cli scenario memory --variant tuned --rows 50000000
    python -m strata.cli runlog /logs/app-1 [/logs/app-2]

Under ``spark-submit`` the session comes from the deployment; ``--local N``
starts a ``local[N]`` session for a laptop run.
"""

from __future__ import annotations

import argparse
import sys
import time

from pyspark.sql import SparkSession


def _session(args) -> SparkSession:
    if args.local:
        from strata.session import local_session

        return local_session(args.local, shuffle_partitions=max(8, 2 * int(args.local)), app_name="strata-cli")
    from strata.session import ensure_checkpoint_dir

    spark = SparkSession.builder.appName("strata-cli").getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def cmd_generate(spark: SparkSession, args) -> None:
    from strata.operators.layout import write_format
    from strata.sources import generators as gen

    df = gen.generate(spark, args.kind, args.size, args.partitions)
    out = write_format(df, args.output, args.format)
    out.printSchema()
    out.show(5, truncate=False)


def cmd_scenario(spark: SparkSession, args) -> None:
    from strata.plans import scenarios as sc

    clicks = sc.generated_clicks(spark, args.rows, args.name, args.partitions)
    t0 = time.perf_counter()
    outs = sc.SCENARIOS[args.name](clicks, args.variant)
    for name, df in outs.items():
        print(f"== {name}")
        df.show(args.show, truncate=False)
    print(f"{args.name} ({args.variant}, {args.rows} rows): {time.perf_counter() - t0:.1f} s")


def cmd_runlog(spark: SparkSession, args) -> None:
    from strata.operators import runlog
    from strata.sources.eventlog import read_event_log

    summaries = [runlog.app_summary(read_event_log(spark, p)) for p in args.logs]
    for p, s in zip(args.logs, summaries):
        print(f"== {p}")
        s.show(truncate=False)
        ev = read_event_log(spark, p)
        runlog.task_skew(ev).filter("skewed").show(truncate=False)
        runlog.memory_warnings(ev).show(truncate=False)
    if len(summaries) == 2:
        runlog.compare(*summaries).show(truncate=False)


def main(argv: list[str] | None = None) -> None:
    from strata.plans.scenarios import SCENARIOS
    from strata.sources.generators import KINDS

    ap = argparse.ArgumentParser(prog="strata")
    ap.add_argument("--local", help="run on local[N] instead of the deployment's session")
    sub = ap.add_subparsers(dest="cmd", required=True)
    g = sub.add_parser("generate", help="generate a dataset and save it")
    g.add_argument("kind", nargs="?", default="clickstream", help=f"one of {KINDS} (default clickstream)")
    g.add_argument("size", nargs="?", default="small", help="small/medium/large/xlarge or a row count")
    g.add_argument("output")
    g.add_argument("--format", default="parquet")
    g.add_argument("--partitions", type=int)
    s = sub.add_parser("scenario", help="run one of the five jobs on generated rows")
    s.add_argument("name", choices=sorted(SCENARIOS))
    s.add_argument("--variant", choices=("plain", "tuned"), default="tuned")
    s.add_argument("--rows", type=int, default=1_000_000)
    s.add_argument("--partitions", type=int)
    s.add_argument("--show", type=int, default=10)
    r = sub.add_parser("runlog", help="run metrics from one or two event logs (two: compared)")
    r.add_argument("logs", nargs="+")
    args = ap.parse_args(argv)
    spark = _session(args)
    {"generate": cmd_generate, "scenario": cmd_scenario, "runlog": cmd_runlog}[args.cmd](spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
