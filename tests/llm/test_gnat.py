"""Hard negatives against SQL and brute force."""

import duckdb
import numpy as np
import pytest
from conftest import SF01
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from strata.llm import gnat
from strata.llm.queries import ORACLE, QUERIES


def brute(rows, is_anchor, positives=5, negatives=10, least=30, most=90, scale=256):
    ok = [(i, lab, np.floor(np.array(v, float) * scale).astype(int)) for i, v, lab in dict.fromkeys((i, None if v is None else tuple(v), lab) for i, v, lab in rows)
          if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, lab, v in ok:
        if not is_anchor(i):
            continue
        others = sorted((-int(v @ w), j, m == lab) for j, m, w in ok if j != i and len(w) == len(v))
        for ps, j, _ in [o for o in others if o[2]][:positives]:
            fit = [o for o in others if not o[2] and least * -ps <= 100 * -o[0] <= most * -ps][:negatives]
            out += [(i, j, r, n, -ps, -ns) for r, (ns, n, _) in enumerate(fit, 1)]
    return sorted(out)


def run(spark, rows, **args):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("q", F.lit("clash")).withColumn("cell", F.lit(1))
    return sorted(tuple(r) for r in gnat.hard_negatives(vectors, F.col("vec_id") % 10 == 0, **args).collect())


def test_query_equals_sql(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{SF01}/embeddings.parquet'")
    want = duckdb.sql(ORACLE["op11_hard_negatives"])
    got = QUERIES["op11_hard_negatives"](spark, SF01).select(*want.columns)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.fetchall())


@pytest.mark.parametrize("part, few, chunk", [(8192, 64, 4096), (40, 8, 3)])
def test_clusters_ties_and_parts(spark, monkeypatch, part, few, chunk):
    """Tight clusters, one vector held by a third of the rows, several levels, parts and chunks."""
    monkeypatch.setattr(gnat, "PART", part)
    monkeypatch.setattr(gnat, "FEW", few)
    monkeypatch.setattr(gnat, "CHUNK", chunk)
    rng = np.random.default_rng(1)
    middles = rng.normal(size=(6, 5)) * 3
    rows = [(i, [float(x) for x in (middles[0] if i % 3 == 0 else middles[i % 6] + rng.normal(size=5) * 0.4)], i % 4) for i in range(700)]
    assert run(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_hard_rows(spark):
    inf = float("inf")
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (0, [0.0, 9.0], 1), (None, [1.0, 1.0], 1), (1, None, 1), (2, [1.0, None], 2), (3, [inf, 0.0], 1),
            (4, [float("nan"), 0.0], 0), (5, [0.5, 0.5], None), (6, [0.9, 0.1], 1), (7, [0.9, 0.1], 1), (8, [0.5, 0.1], 2), (9, [0.5, 0.1], 3),
            (10, [1.0, 2.0, 3.0], 1), (11, [1.0, 1.0, 1.0], 1), (12, [0.5, 0.5, 0.5], 2), (20, [-1.0, -1.0], 2), (30, [], 1), (31, [], 1), (32, [], 2)]
    assert run(spark, rows) == brute(rows, lambda i: i % 10 == 0)
    assert run(spark, []) == []
    assert run(spark, rows[:1]) == []
    assert run(spark, rows, positives=1, negatives=2, least_pct=0, most_pct=100) == brute(rows, lambda i: i % 10 == 0, 1, 2, 0, 100)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10 ** 9), st.integers(1, 5), st.integers(1, 300))
def test_no_vector_in_a_window_is_eliminated(seed, dim, n):
    rng = np.random.default_rng(seed)
    points = rng.integers(-30, 30, (n, dim)) * rng.integers(1, 4, (n, 1))
    points = points[rng.integers(0, n, n)]                      # some alike
    queries = rng.integers(-40, 40, (7, dim)).astype(float)
    least = rng.integers(-2000, 2000, (7, 2)).astype(float)
    most = least + rng.integers(0, 1500, (7, 2))
    tree = gnat.Gnat(points.astype(float), few=4, arity=3)
    assert sorted(np.concatenate(tree.cells).tolist()) == list(range(n))
    cell = tree.cell_of(points.astype(float))
    seen = {(c, q) for c, rows in tree.visit(queries, least, most) for q in rows.tolist()}
    score = queries @ points.T
    inside = ((score[:, None] >= least[..., None]) & (score[:, None] <= most[..., None])).any(1)
    # Vectors at equal distances may lie in another cell than the one they were grown into.
    home = {r: c for c, rows in enumerate(tree.cells) for r in rows.tolist()}
    for q, p in zip(*np.nonzero(inside)):
        assert (home[p], q) in seen
    assert (cell >= 0).all() and (cell < len(tree.cells)).all()
