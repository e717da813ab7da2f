"""Bloom filters as constants of a query: built with ``bit_or`` over a key
column, looked up by an expression, without a join and without Python."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

HASHES = 5


def _positions(key: Column, salt: int, bits: int) -> Column:
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(salt), F.lit(i)), F.lit(bits).cast("long")) for i in range(HASHES)])


def bloom_filter(keys: DataFrame, bits: int, salt: int = 0) -> Callable[[Column], Column]:
    """Whether a key may be among ``keys`` (column ``key``): never false for one
    that is. ``bits``: a multiple of 64, which bounds what reaches the driver."""
    at = keys.select(F.explode(_positions(F.col("key"), salt, bits)).alias("at"))
    words = (at.groupBy(F.expr("at div 64").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("v")).collect())
    dense = np.zeros(bits // 64, np.int64)
    dense[[r["word"] for r in words]] = [r["v"] for r in words]
    constant = F.split(F.lit(",".join(map(str, dense.tolist()))), ",").cast("array<bigint>")

    def test(key: Column) -> Column:
        return F.forall(_positions(key, salt, bits), lambda at: F.getbit(
            F.get(constant, F.shiftright(at, 6).cast("int")), (at % 64).cast("int")) == 1)
    return test
