"""Scalar column expressions shared by the operators.

All of them are built-in Spark expressions, so they run inside whole-stage
codegen; none of them depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for the same results)
# ---------------------------------------------------------------------------
# Revenue bucket edges: total_revenue < 100 -> "low", < 1000 -> "medium",
# otherwise (also NULL) -> "high".
REVENUE_BUCKETS = (("low", 100), ("medium", 1000), ("high", None))
# Event types of the generated clickstream, in this order.
EVENT_TYPES_GENERATED = ("page_view", "click", "purchase", "add_to_cart", "search")
# Transaction categories of the generated transactions, in this order.
CATEGORIES_GENERATED = ("Electronics", "Clothing", "Food", "Books", "Home")
# Constant columns of the generated user dimension.
USER_TIER_GENERATED = "Premium"
COUNTRY_GENERATED = "US"
# Id formats: "session_<user_id>_<hour>", "/page/<n>", "txn_<id>".
SESSION_PREFIX = "session_"
PAGE_PREFIX = "/page/"
TXN_PREFIX = "txn_"

MONEY = "decimal(18,2)"
_TWO31 = 2 ** 31


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """Money as decimal(18,2): exact sums, independent of row order."""
    return _c(c).cast(MONEY)


def hour_floor(ts: Column | str) -> Column:
    """Start of the hour of a ``timestamp_ntz``, without any time-zone shift.

    ``date_trunc`` returns a zoned timestamp and moves with the session zone;
    rebuilding the value from its fields keeps it a wall-clock hour.
    """
    t = _c(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t),
                                F.lit(0), F.lit(0))


def hour_key(hour_start: Column | str) -> Column:
    """``yyyyMMddHH`` of a ``timestamp_ntz``, from its fields.

    ``date_format`` would pass the value through the session zone (a
    daylight-saving gap would move it); field extraction never does.
    """
    h = _c(hour_start)
    return F.format_string("%04d%02d%02d%02d", F.year(h), F.month(h), F.dayofmonth(h), F.hour(h))


def session_id(user_id: Column | str, hour_start: Column | str) -> Column:
    """``session_<user>_<yyyyMMddHH>``: one session per user and wall-clock hour."""
    return F.concat(F.lit(SESSION_PREFIX), _c(user_id).cast("string"), F.lit("_"), hour_key(hour_start))


def event_time(ts: Column | str) -> Column:
    """A ``timestamp_ntz`` as the zoned ``TIMESTAMP`` with the same UTC wall
    clock (what watermarks require), independent of the session zone."""
    t = _c(ts)
    return F.make_timestamp(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t),
                            F.date_part(F.lit("SECOND"), t), F.lit("UTC"))


def revenue_bucket(total: Column | str) -> Column:
    """Bucket label of a revenue total (NULL lands in the last bucket)."""
    t = _c(total)
    (lo, lo_edge), (mid, mid_edge), (hi, _) = REVENUE_BUCKETS
    return F.when(t < lo_edge, lo).when(t < mid_edge, mid).otherwise(hi)


def int_mix(x: Column | str, stream: int = 0) -> Column:
    """Deterministic 31-bit integer hash of a bigint, reproducible in plain SQL.

    h = ((x + stream) mod 2^31 * 1103515245 + 12345) mod 2^31; h ^= h >> 15;
    h = h * 1597334677 mod 2^31; h ^= h >> 13. Every product stays below 2^62,
    so ANSI arithmetic never overflows.
    """
    v = F.pmod(_c(x).cast("bigint") + F.lit(stream), F.lit(_TWO31))
    h = F.pmod(v * F.lit(1103515245) + F.lit(12345), F.lit(_TWO31))
    h = h.bitwiseXOR(F.shiftright(h, 15))
    h = F.pmod(h * F.lit(1597334677), F.lit(_TWO31))
    return h.bitwiseXOR(F.shiftright(h, 13))


def int_mix_sql(x: str, stream: int = 0) -> str:
    """The same hash as DuckDB SQL text (used by the oracle queries)."""
    v = f"((({x})::BIGINT + {stream}) % 2147483648)"
    h1 = f"(({v} * 1103515245 + 12345) % 2147483648)"
    h2 = f"xor({h1}, {h1} >> 15)"
    h3 = f"(({h2}) * 1597334677 % 2147483648)"
    return f"xor({h3}, {h3} >> 13)"


def sorted_join(arr: Column | str, sep: str = ",") -> Column:
    """A set-valued array as one comparable string (sorted, joined)."""
    return F.array_join(F.array_sort(_c(arr)), sep)


def array_set_merge(arrays: Column | str) -> Column:
    """Union of an array of arrays, as a sorted distinct array."""
    return F.array_sort(F.array_distinct(F.flatten(_c(arrays))))
