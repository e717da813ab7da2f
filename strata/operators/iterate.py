"""Iterative jobs: a state that a loop writes anew each round, until it settles.

A loop of DataFrame steps has two costs that grow with its rounds: the plan,
which holds every earlier round, and the intermediates. :func:`iterate` writes
the state after every round to the shared checkpoint folder and reads it back,
so a round's plan starts from files (and a lost executor reads them again), and
deletes what the round before has left. At any time there are the files of two
rounds at most. Inputs that every round reads are written once (:func:`reused`).

Two jobs are built on it: connected components by label propagation, which
runs until no label moves, and a fixed number of rank rounds over a link graph.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import delete_scratch, materialize, scratch_mark, scratch_since

MAX_ROUNDS = 200


@contextmanager
def reused(df: DataFrame, name: str = "reused") -> Iterator[DataFrame]:
    """``with reused(df) as table:`` - ``df`` written once for the block, its files deleted after it."""
    mark = scratch_mark()
    table = materialize(df, name)
    written = scratch_since(mark)
    try:
        yield table
    finally:
        delete_scratch(df.sparkSession, written)


def iterate(state: DataFrame, step: Callable[[DataFrame, int], DataFrame], moving: Column | str | None = None,
            max_rounds: int = MAX_ROUNDS, name: str = "round") -> tuple[DataFrame, int]:
    """``(state, rounds)`` after ``state = step(state, round)`` has run again and again.

    With ``moving``, a condition on the new state's rows, the loop ends after the
    round that leaves no such row; if ``max_rounds`` don't suffice it raises.
    Without it, exactly ``max_rounds`` rounds run. ``step`` has to return a
    DataFrame with the state's columns, and may write intermediates of its own
    with ``materialize``: they are deleted with the round. The files of the state
    that is returned stay until ``release_scratch``.
    """
    spark = state.sparkSession
    mark = scratch_mark()
    current = materialize(state, f"{name}-0")
    files = scratch_since(mark)
    for n in range(1, max_rounds + 1):
        mark = scratch_mark()
        following = materialize(step(current, n), f"{name}-{n}")
        written = scratch_since(mark)
        settled = moving is not None and following.where(moving).isEmpty()
        delete_scratch(spark, files + written[:-1])     # the last folder is the new state
        current, files = following, written[-1:]
        if settled:
            return current, n
    if moving is not None:
        delete_scratch(spark, files)
        raise RuntimeError(f"the state still moves after {max_rounds} rounds")
    return current, max_rounds


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node``, ``component`` for every node of ``links`` (columns ``a`` and
    ``b`` name its ends): the smallest node that can be reached from it.

    A node's label is a node of its component, no larger than itself. Each round
    it becomes the smallest among itself, its label's label, and the neighbours'
    labels' labels; what a node finds its label learns, too. So trees of labels
    hook onto each other and flatten at once: the rounds grow with the logarithm
    of a component's size, also along a chain. Minima are partially aggregated,
    so a hub or a label that most nodes share is one row per task. Null ends link
    nothing; a node linked only to itself is its own component; no links give no rows.
    """
    sound = links.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("src"), F.col(b).alias("dst"))
    both = sound.unionByName(sound.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    with reused(both, "links") as table:
        own = F.col("src")
        nodes = table.select(own.alias("node"), own.alias("label"), own.alias("above"), F.lit(True).alias("moved")).distinct()

        def step(state: DataFrame, _: int) -> DataFrame:
            near = (table.join(state.select(F.col("node").alias("src"), "above"), "src")
                    .groupBy(F.col("dst").alias("node")).agg(F.min("above").alias("near")))
            least = F.least("label", "above", F.coalesce("near", "label"))
            seen = materialize(state.join(near, "node", "left").select("node", "label", "above", least.alias("least")), "seen")
            learned = seen.groupBy(F.col("label").alias("node")).agg(F.min("least").alias("learned"))
            label = F.least("least", F.coalesce("learned", "least"))
            now = materialize(seen.join(learned, "node", "left").select(
                "node", label.alias("label"), F.col("above").alias("_above"), (label < F.col("label")).alias("_lower")), "now")
            above = now.select(F.col("node").alias("label"), F.col("label").alias("above"))
            return now.join(above, "label").select("node", "label", "above", (F.col("_lower") | (F.col("above") < F.col("_above"))).alias("moved"))

        state, _ = iterate(nodes, step, moving="moved", name="labels")
    return state.select("node", F.col("label").alias("component"))


RANK_UNIT = 1_000_000       # a rank of one


def rank_rounds(links: DataFrame, src: str, dst: str, rounds: int = 10, damping_pct: int = 85) -> DataFrame:
    """``node``, ``rank`` after ``rounds`` rounds of link ranking (in millionths).

    A node hands its rank out in equal shares along its links and gets the base
    rank plus ``damping_pct`` percent of what it receives. All in whole numbers,
    each division rounded down, so the result doesn't depend on the order of
    sums. Repeated links count once, null ends none. The link table with its
    degrees is written once and read every round.
    """
    sound = links.where(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(F.col(src).alias("src"), F.col(dst).alias("dst")).distinct()
    degree = sound.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))
    base = RANK_UNIT * (100 - damping_pct) // 100
    with reused(sound.join(degree, "src"), "ranked-links") as table:
        nodes = table.select(F.col("src").alias("node")).union(table.select("dst")).distinct().withColumn("rank", F.lit(RANK_UNIT).cast("long"))

        def step(state: DataFrame, _: int) -> DataFrame:
            shares = (table.join(state.withColumnRenamed("node", "src"), "src")
                      .groupBy(F.col("dst").alias("node")).agg(F.sum(F.expr("rank div degree")).alias("got")))
            got = F.coalesce("got", F.lit(0).cast("long")) * damping_pct
            return state.join(shares, "node", "left").select("node", (F.lit(base) + F.floor(got / 100)).cast("long").alias("rank"))

        state, _ = iterate(nodes, step, max_rounds=rounds, name="ranks")
    return state
