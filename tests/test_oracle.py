"""Every catalog query against its DuckDB oracle, on the sf0.001 tables."""

import os
import sys

import duckdb
import pytest

from conftest import SF001

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import oracle_check  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402

oracle_check.STRICT = True   # exact floats: the results must agree bit for bit

import __spark_entry__ as ent  # noqa: E402

from strata.plans.queries import QUERIES  # noqa: E402

KEYS = sorted(QUERIES)
SPARK_TO_DUCK = {"IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
                 "TimestampNTZType": "TIMESTAMP", "BooleanType": "BOOLEAN", "ArrayType": "VARCHAR[]"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_every_oracle_has_a_query():
    assert set(ent.oracle_sql()) <= set(ent.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = ent.queries()[key](spark, SF001)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    rel = duck.sql(ent.oracle_sql()[key])
    d_cols = list(rel.columns)
    assert sorted(s_cols) == sorted(d_cols)
    s_types = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, type(f.dataType).__name__)
               for f in df.schema.fields}
    assert s_types == {n: str(t) for n, t in zip(d_cols, rel.types)}
    assert rows_of(s_cols, s_rows) == rows_of(d_cols, rel.fetchall())


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.count() > 0
    assert "user_rank" in df.columns and "ltv_percentile" in df.columns
