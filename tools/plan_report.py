"""Summarise the final physical plan of every catalog query (writes PLANS.md).

usage: python tools/plan_report.py [sf_dir] > PLANS.md
Each query is run once (collect) so the adaptive plan is final, then its
``explain`` text is reduced to counts of the operators that matter at scale.
Scalar subqueries and checkpoint jobs run as separate plans and are not counted.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.plans.inspect import plan_text, single_partition_exchanges_are_global_aggregates  # noqa: E402
from strata.session import local_session  # noqa: E402


def final_part(text: str) -> str:
    if "== Final Plan ==" in text:
        return text.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return text


def summary(text: str) -> dict:
    t = final_part(text)
    return {
        "hash_exchanges": len(re.findall(r"Exchange hashpartitioning", t)),
        "range_exchanges": len(re.findall(r"Exchange rangepartitioning", t)),
        "round_robin": len(re.findall(r"RoundRobinPartitioning", t)),
        "single_partition": len(re.findall(r"Exchange SinglePartition", t)),
        "broadcasts": len(re.findall(r"BroadcastExchange", t)),
        "bhj": len(re.findall(r"BroadcastHashJoin", t)),
        "smj": len(re.findall(r"SortMergeJoin", t)),
        "skew_split": "skew=true" in t,
        "window": len(re.findall(r"\bWindow\b", t)),
        "top_k": len(re.findall(r"TakeOrderedAndProject", t)),
        "pushed": sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", t))),
        "single_ok": single_partition_exchanges_are_global_aggregates(t, allow_partition_counts=True),
    }


# Single-partition steps that are bounded by construction (not by the data).
BOUNDED = {"skew_report": "window over the frequency-of-counts table, < sqrt(2*rows) rows"}


def _bounded(key: str) -> str:
    for prefix, why in BOUNDED.items():
        if key.startswith(prefix):
            return "bounded: " + why
    return "NO"


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from strata.plans.queries import QUERIES

    spark = local_session()
    print("# Final physical plans, per catalog key\n")
    print(f"Generated by `tools/plan_report.py` on `{sf_dir}` (local[*], 8 shuffle partitions, AQE on). Counts are")
    print("of the main query's final adaptive plan. Scalar subqueries and eager checkpoint jobs are separate plans.")
    print("`1-task ok` means every `Exchange SinglePartition` feeds only a keyless aggregate or the")
    print("one-row-per-partition offsets, so no unbounded data meets in one task.\n")
    print("| key | hash exch. | range exch. | round-robin | single-part. | broadcasts | BHJ | SMJ | skew split | window | top-k | 1-task ok | pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for k, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.collect()
        s = summary(plan_text(df))
        pushed = "; ".join(p.replace("|", "/") for p in s["pushed"]) or "-"
        print(f"| `{k}` | {s['hash_exchanges']} | {s['range_exchanges']} | {s['round_robin']} | {s['single_partition']} | "
              f"{s['broadcasts']} | {s['bhj']} | {s['smj']} | {'yes' if s['skew_split'] else '-'} | {s['window']} | "
              f"{s['top_k']} | {'yes' if s['single_ok'] else _bounded(k)} | "
              f"{pushed} |", flush=True)


if __name__ == "__main__":
    main()
