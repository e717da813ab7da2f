"""Plan inspection through the public ``explain`` output."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    """The text ``df.explain(mode)`` prints. After an action on ``df`` an
    adaptive plan shows its final form (``isFinalPlan=true``)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def count_nodes(text: str, name: str) -> int:
    return len(re.findall(rf"\b{re.escape(name)}\b", text))


def single_partition_exchanges_are_global_aggregates(text: str, allow_partition_counts: bool = False) -> bool:
    """True if every ``Exchange SinglePartition`` feeds only a global (keyless)
    aggregate, i.e. what meets in one task is one partial row per map task.

    With ``allow_partition_counts`` an aggregate keyed by the partition id of
    :mod:`strata.operators.ranking` (one row per partition) is accepted too.
    """
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            near = " ".join(lines[max(0, i - 1):i + 8])
            if "HashAggregate(keys=[]" in near:
                continue
            if allow_partition_counts and "shiftright(_mid" in near:
                continue
            return False
    return True
