from strata.functions.columns import (  # noqa: F401
    EVENT_TYPES_GENERATED,
    REVENUE_BUCKETS,
    array_set_merge,
    event_time,
    hour_floor,
    hour_key,
    int_mix,
    money,
    revenue_bucket,
    session_id,
    sorted_join,
)
