import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import local_session

    s = local_session("*", shuffle_partitions=8, app_name="strata-tests")
    yield s
    from strata.session import release_scratch

    release_scratch(s)
    s.stop()


def _t(h, m, s):
    return dt.datetime(2024, 1, 1, h, m, s)


# FIXTURES.md section 3: hour boundary (user 1), bucket edges 100.00 / 999.99 /
# 1000.00, revenue ties (users 4 and 5), equal timestamps (user 5).
MINI_EVENTS = [
    (1, _t(10, 59, 59), 1, "purchase", 99.99),
    (2, _t(11, 0, 0), 1, "purchase", 0.01),
    (3, _t(10, 0, 0), 2, "purchase", 999.99),
    (4, _t(10, 5, 0), 2, "click", 5.00),
    (5, _t(10, 0, 0), 3, "purchase", 1000.00),
    (6, _t(10, 0, 0), 4, "view", 7.00),
    (7, _t(10, 0, 0), 5, "view", 3.00),
    (8, _t(10, 0, 0), 5, "click", 3.00),
]
EVENTS_DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"


@pytest.fixture(scope="session")
def mini_events(spark):
    return spark.createDataFrame(MINI_EVENTS, EVENTS_DDL)


@pytest.fixture(scope="session")
def mini_clicks(mini_events):
    from strata.sources.tables import with_session_columns

    return with_session_columns(mini_events)


@pytest.fixture(scope="session")
def mini_users(spark):
    return spark.createDataFrame([(1, "Premium", 30, "US"), (2, "Premium", 40, "US"), (3, "Premium", 50, "US")],
                                 "user_id bigint, user_tier string, user_age int, country string")


def rows(df, *cols):
    """Sorted list of tuples of the named columns."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple(map(str, t)))
