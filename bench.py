"""Benchmark: every catalog query at one scale, written in full to the noop sink.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default all), BENCH_REPEAT (runs per query, the
median is reported and ``spread`` has the fastest and slowest; default 3), BENCH_GEN_ROWS (rows of the generated
scenario section, default 2,000,000; 0 skips it). Prints one JSON line.
``queries`` holds the catalog versions; ``plain`` the reference's query shapes
(unpartitioned windows, no salt, forced sort-merge) for the same keys;
``scenarios`` the reference's five jobs on generated rows, plain vs tuned,
with rows/s.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from strata.plans.queries import QUERIES
    from strata.plans.variants import PLAIN
    from strata.session import local_session, release_scratch

    parts = max(8, int(cpus) * 2)
    spark = local_session(cpus, shuffle_partitions=parts, app_name="strata-bench")
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(QUERIES)

    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "3")))

    spread = {}

    def timed(fn, name=None):
        took = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - t0)
        if name:
            spread[name] = [round(min(took), 3), round(max(took), 3)]
        return round(statistics.median(took), 3)

    timed(QUERIES["user_stats"])  # warm-up: JIT, file listing caches
    results, errors = {}, {}
    for k in wanted:
        try:
            results[k] = timed(QUERIES[k], k)
        except Exception as e:  # noqa: BLE001
            errors[k] = f"{type(e).__name__}: {str(e)[:200]}"
    plain = {}
    for k, fn in PLAIN.items():
        if k in wanted:
            plain[k] = timed(fn)
    scen = {}
    gen_rows = int(os.environ.get("BENCH_GEN_ROWS", "2000000"))
    if gen_rows > 0:
        from strata.plans import scenarios as sc

        spark.conf.set("spark.sql.shuffle.partitions", str(max(parts, gen_rows // 250_000)))
        for name, fn in sc.SCENARIOS.items():
            row = {}
            for variant in ("plain", "tuned"):
                t0 = time.perf_counter()
                for df in fn(sc.generated_clicks(spark, gen_rows, name), variant).values():
                    df.write.format("noop").mode("overwrite").save()
                row[variant] = round(time.perf_counter() - t0, 3)
            row["tuned_rows_per_sec"] = round(gen_rows / row["tuned"])
            scen[name] = row
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    out = {"metric": "catalog_total_noop_seconds", "value": round(sum(results.values()), 3), "unit": "sec",
           "queries": results, "plain": plain, "scenarios": scen, "generated_rows": gen_rows,
           "sf": sf, "cpus": int(cpus), "shuffle_partitions": parts, "repeat": repeat, "stat": "median", "spread": spread}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    release_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
