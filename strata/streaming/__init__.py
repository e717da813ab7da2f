from strata.streaming.sessions import (  # noqa: F401
    read_events_stream,
    session_totals_stream,
    start_session_rollup,
)
