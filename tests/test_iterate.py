"""Iterative jobs against plain Python: results, rounds, and the files that a loop keeps."""

import os
import random

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from strata import session
from strata.operators import iterate as it
from strata.sources.tables import read_table


def folders(spark):
    base = session.ensure_checkpoint_dir(spark).replace("file:", "")
    return {f for f in os.listdir(base) if f.startswith("strata-")}


def brute_components(links):
    label = {}
    for a, b in links:
        label.setdefault(a, a)
        label.setdefault(b, b)
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def brute_ranks(links, rounds, damping):
    links = set(links)
    nodes = {x for link in links for x in link}
    rank, degree = dict.fromkeys(nodes, it.RANK_UNIT), {}
    for a, _ in links:
        degree[a] = degree.get(a, 0) + 1
    for _ in range(rounds):
        got = dict.fromkeys(nodes, 0)
        for a, b in links:
            got[b] += rank[a] // degree[a]
        rank = {x: it.RANK_UNIT * (100 - damping) // 100 + got[x] * damping // 100 for x in nodes}
    return rank


def frame(spark, links):
    return spark.createDataFrame(links, "a long, b long")


def test_components_equal_brute_force(spark):
    """Forty random graphs side by side, from a few links to dense."""
    rng, links = random.Random(2), []
    for g in range(40):
        n = rng.randrange(2, 60)
        links += [(g * 100 + rng.randrange(n), g * 100 + rng.randrange(n)) for _ in range(rng.randrange(1, 80))]
    got = {r.node: r.component for r in it.components(frame(spark, links), "a", "b").collect()}
    assert got == brute_components(links)


def test_a_chain_takes_few_rounds(spark, monkeypatch):
    n = 300
    order = list(range(n))
    random.Random(3).shuffle(order)
    links = [(order[i], order[i + 1]) for i in range(n - 1)]
    rounds, plain = [], it.iterate
    monkeypatch.setattr(it, "iterate", lambda *a, **k: (lambda s, r: (rounds.append(r), (s, r))[1])(*plain(*a, **k)))
    got = {r.component for r in it.components(frame(spark, links), "a", "b").collect()}
    assert got == {0} and rounds[0] < 12


def test_hub_nulls_loops_and_empty(spark):
    links = [(0, i) for i in range(1, 400)] + [(None, 1), (2, None), (500, 500), (7, 7), (600, 601), (601, 600)]
    got = {r.node: r.component for r in it.components(frame(spark, links), "a", "b").collect()}
    assert got == brute_components([x for x in links if None not in x])
    assert it.components(frame(spark, links).limit(0), "a", "b").count() == 0
    assert it.rank_rounds(frame(spark, links).limit(0), "a", "b").count() == 0


def test_rank_rounds_equal_brute_force(spark):
    rng = random.Random(1)
    links = [(rng.randrange(60), rng.randrange(60) ** 2 // 60) for _ in range(300)]
    for rounds, damping in ((1, 85), (6, 85), (4, 50)):
        got = {r.node: r["rank"] for r in it.rank_rounds(frame(spark, links + links[:20] + [(None, 1)]), "a", "b", rounds, damping).collect()}
        assert got == brute_ranks(links, rounds, damping)


def test_a_loop_keeps_the_files_of_two_rounds_at_most(spark):
    before, kept, held = folders(spark), [], []

    def step(state, n):
        kept.append(len(folders(spark) - before))       # files of the last round only
        side = session.materialize(state.select("id"), "side-table")
        held.append(side)
        return state.join(side, "id").select("id", (F.col("left") - 1).alias("left"))

    start = spark.range(5).withColumn("left", F.col("id"))
    out, rounds = it.iterate(start, step, moving="left > 0", max_rounds=20)
    assert rounds == 4 and kept == [1] * 4 and len(folders(spark) - before) == 1
    assert sorted(tuple(r) for r in out.collect()) == [(i, i - 4) for i in range(5)]
    # A round's plan starts from the last round's files, not from the first ones.
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    with pytest.raises(RuntimeError):
        it.iterate(start, step, moving="left > -100", max_rounds=2)
    assert len(folders(spark) - before) == 1
    fixed, rounds = it.iterate(start, lambda s, n: s.withColumn("left", F.col("left") + n), max_rounds=3)
    assert rounds == 3 and fixed.agg(F.sum("left")).first()[0] == 10 + 5 * 6
    session.delete_scratch(spark, ["file:" + p if not p.startswith("file:") else p for p in session.scratch_since(0)][-1:])


def test_a_reused_table_goes_with_its_block(spark):
    before = folders(spark)
    with it.reused(read_table(spark, SF001, "orders").select("o_custkey")) as table:
        assert len(folders(spark) - before) == 1 and table.count() == 1500
    assert folders(spark) == before
    with pytest.raises(ZeroDivisionError), it.reused(spark.range(3)):
        1 / 0
    assert folders(spark) == before
