"""Exact money arithmetic that two SQL engines agree on bit for bit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(m: Column) -> Column:
    """decimal money -> double (the exact decimal rounds to one double)."""
    return m.cast("double")


def ratio_2(total: Column, n: Column) -> Column:
    """round(total / n, 2) half-up, for non-negative money and positive n.

    Done in integer cents, ``floor((2*cents + n) / (2*n)) / 100``, so the result
    doesn't depend on how an engine rounds a double. NULL when n is 0 or NULL.
    """
    cents = (total * F.lit(100)).cast("bigint")
    n = n.cast("bigint")
    q = F.floor((cents * F.lit(2) + n) / (n * F.lit(2)))
    return F.when(n > 0, q.cast("double") / F.lit(100.0))


def ratio_2_sql(total: str, n: str) -> str:
    """DuckDB text of :func:`ratio_2`."""
    cents = f"(({total}) * 100)::BIGINT"
    return (f"CASE WHEN ({n}) > 0 THEN floor(({cents} * 2 + ({n})) / (({n}) * 2))::DOUBLE / 100.0 END")
