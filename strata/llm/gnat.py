"""Hard negatives by a geometric near-neighbour access tree (GNAT) in Spark.

The tree is a multiway hyperplane tree. A node has several split points, and a
vector belongs to the nearest one. For every split point and every sibling the
node keeps the range of distances from that point to the sibling's vectors.
A query looks for products in a window; with the range of a subtree's norms
that is an annulus around the query, ``d^2 = |q|^2 + |x|^2 - 2 q.x``. One
distance to a split point tells which distances a sibling's vectors can have,
and a sibling where that range and the annulus don't meet is gone.

The upper levels are fitted on a bounded sample; every vector is then sent down
to a cell, and the ranges are taken over all vectors (minima and maxima, partly
aggregated in each task). Cells are cut into parts of bounded size; a task builds
the lower levels over its part, walks them with all its queries at once, and
computes exact products in the leaves.

A search has two passes. The first looks into the query's own cell only, which
gives scores to beat. The second sends the query to the cells that the upper
levels leave over, and is complete. A part of a cell is read once for each
``CHUNK`` of queries that ask for it, and not at all if none does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from strata.llm.topk import integers
from strata.session import materialize

SAMPLE = 16_384         # vectors that the upper levels are fitted on, at most
ARITY = 16              # split points of a node
FEW = 64                # a node of the sample with no more isn't split
PART = 8192             # vectors of a part, about
CHUNK = 4096            # requests that read a part together, about
LEAF = 64               # vectors of a leaf, unless they are alike
SLACK = 1e-6            # relative, for rounding


def _matrix(packed, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.int64).reshape(len(packed), dim)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products (longs)."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2 ** 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between the rows of two float matrices."""
    square = (a ** 2).sum(1)[:, None] + (b ** 2).sum(1)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def _split_points(points: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` different rows far from each other, the first nearest the middle."""
    at = int(_distances(points, points.mean(0)[None])[:, 0].argmin())
    chosen, near = [at], _distances(points, points[[at]])[:, 0]
    while len(chosen) < n and near.max() > 0:
        at = int(near.argmax())
        chosen.append(at)
        near = np.minimum(near, _distances(points, points[[at]])[:, 0])
    return points[chosen]


class Gnat:
    """Nodes by number, the root is 0. ``splits[n]``: the node's split points;
    ``child[n]``: the child at each of them, a cell ``-1 - c`` or a node.
    ``low``, ``high``: distances from split point i to the vectors at j;
    ``norms``: least and largest norm at j."""

    def __init__(self, points: np.ndarray, few: int, arity: int = ARITY):
        self.splits: list[np.ndarray] = []
        self.child: list[list[int]] = []
        self.cells: list[np.ndarray] = []           # rows of each cell
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.norms: list[np.ndarray] = []
        todo = [(np.arange(len(points)), None, 0)]
        while todo:
            rows, parent, j = todo.pop()
            splits = _split_points(points[rows], arity) if len(rows) > few else points[:0]
            if len(splits) > 1:
                number = len(self.splits)
                dist = _distances(points[rows], splits)
                near = dist.argmin(1)
                self.splits.append(splits)
                self.child.append([0] * len(splits))
                self._measure(dist, near, np.sqrt((points[rows] ** 2).sum(1)))
                todo += [(rows[near == i], number, i) for i in range(len(splits))]
            else:
                number = -1 - len(self.cells)
                self.cells.append(rows)
            if parent is not None:
                self.child[parent][j] = number

    def _measure(self, dist: np.ndarray, near: np.ndarray, norm: np.ndarray) -> None:
        m = dist.shape[1]
        low, high, norms = np.full((m, m), np.inf), np.full((m, m), -np.inf), np.tile([np.inf, -np.inf], (m, 1))
        for j in range(m):
            mine = near == j
            if mine.any():
                low[:, j], high[:, j] = dist[mine].min(0), dist[mine].max(0)
                norms[j] = norm[mine].min(), norm[mine].max()
        self.low.append(low)
        self.high.append(high)
        self.norms.append(norms)

    def descend(self, points: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(node, rows, distances to its split points, nearest one) of every node that ``points`` pass."""
        todo = [(0, np.arange(len(points)))] if self.splits else []
        while todo:
            node, rows = todo.pop()
            dist = _distances(points[rows], self.splits[node])
            near = dist.argmin(1)
            yield node, rows, dist, near
            todo += [(c, rows[near == j]) for j, c in enumerate(self.child[node]) if c >= 0 and (near == j).any()]

    def cell_of(self, points: np.ndarray) -> np.ndarray:
        cell = np.zeros(len(points), np.int64)
        for node, rows, _, near in self.descend(points):
            cell[rows] = -1 - np.array(self.child[node])[near]
        return np.maximum(cell, 0)      # nodes are overwritten further down

    def alive(self, node: int, queries: np.ndarray, square: np.ndarray, least: np.ndarray, most: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Queries x children: whether a child may hold a vector whose product
        with the query lies in one of the query's windows [least, most] (queries
        x windows). ``square``, ``size``: the squared norm and the norm of each query."""
        dist = _distances(queries, self.splits[node])
        low, high, norms = self.low[node], self.high[node], self.norms[node]
        there = np.isfinite(norms[:, 0])
        # What the distance to each split point leaves of each child's distances from the query.
        nearest = np.maximum(np.maximum(dist[:, :, None] - high[None], low[None] - dist[:, :, None]).max(1), 0)
        farthest = (dist[:, :, None] + high[None]).min(1)
        ok = np.zeros(nearest.shape, bool)
        slack = SLACK * (square[:, None] + np.where(there, norms[:, 1], 0)[None] ** 2 + 1)
        for w in range(least.shape[1]):
            # The products that those distances and the norms allow meet the window.
            inner = (square[:, None] + norms[None, :, 0] ** 2 - farthest ** 2) / 2 - slack
            outer = (square[:, None] + norms[None, :, 1] ** 2 - nearest ** 2) / 2 + slack
            cap = size[:, None] * norms[None, :, 1] + slack
            ok |= (inner <= most[:, [w]]) & (np.minimum(outer, cap) >= least[:, [w]]) & (-cap <= most[:, [w]]) & (least[:, [w]] <= most[:, [w]])
        return ok & there[None]

    def visit(self, queries: np.ndarray, least: np.ndarray, most: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(cell, queries) of every cell left over. The windows are read anew at
        each node, so narrowing them in between saves visits."""
        square = (queries ** 2).sum(1)
        size = np.sqrt(square)
        todo = [(0 if self.splits else -1, np.arange(len(queries)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                yield -1 - node, rows
                continue
            with np.errstate(invalid="ignore"):
                ok = self.alive(node, queries[rows], square[rows], least[rows], most[rows], size[rows])
            todo += [(c, rows[ok[:, j]]) for j, c in enumerate(self.child[node]) if ok[:, j].any()]


def search(points: np.ndarray, ids: np.ndarray, labels: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, query_labels: np.ndarray,
           least: np.ndarray, most: np.ndarray, k: int, same: bool) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(query row, window, point row, score) of every point that may be among
    the ``k`` best scores in a query's window, none that is left out. Points
    are of the query's label (``same``) or of others, and not of its id."""
    flat, asked = points.astype(np.float64), queries.astype(np.float64)
    tree = Gnat(flat, LEAF)
    least, most = least.astype(float).copy(), most.astype(float)
    best = np.full((*least.shape, k), -np.inf)
    out = []
    for cell, rows in tree.visit(asked, least, most):
        at = tree.cells[cell]
        score = _products(queries[rows], points[at])
        fits = ((labels[at][None] == query_labels[rows][:, None]) == same) & (ids[at][None] != query_ids[rows][:, None])
        for w in range(least.shape[1]):
            good = fits & (score >= least[rows, w][:, None]) & (score <= most[rows, w][:, None])
            i, j = np.nonzero(good)
            if len(i):
                out.append((rows[i], np.full(len(i), w), at[j], score[i, j]))
                hit = np.unique(i)
                now = np.where(good[hit], score[hit], -np.inf)
                r = rows[hit]
                best[r, w] = -np.sort(-np.concatenate([best[r, w], now], axis=1), axis=1)[:, :k]
                least[r, w] = np.maximum(least[r, w], best[r, w, k - 1])
    return out


class Index:
    """The distributed index: upper levels by dimension, vectors with their cells on disk."""

    def __init__(self, rows: DataFrame, keep: int):
        """``rows``: id, label, dim, bytes. Of rows alike in vector and label the
        ``keep`` smallest ids are held: more of them can't be among so many best."""
        sample = rows.select("dim", "bytes").orderBy(F.xxhash64("id", "bytes")).limit(SAMPLE).toPandas()
        few = max(FEW, -(-len(sample) * PART // max(rows.count(), 1)))      # cells of about a part, while the sample reaches
        self.trees = {int(d): Gnat(_matrix(s["bytes"], int(d)).astype(np.float64), few) for d, s in sample.groupby("dim")}
        place = F.row_number().over(Window.partitionBy("dim", "label", "bytes").orderBy("id"))
        held = rows.withColumn("n", place).where(F.col("n") <= keep).drop("n")
        self.held = materialize(held.withColumn("cell", self.cell()), "gnat-vectors")
        self._measure()
        self.parts = materialize(self.held.groupBy("dim", "cell").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts")), "gnat-cells")

    def cell(self) -> Column:
        """The cell of a vector (``dim``, ``bytes``); 0 for a length that the sample lacks."""
        trees = self.trees

        def find(dims: pd.Series, vectors: pd.Series) -> pd.Series:
            out = np.zeros(len(dims), np.int64)
            for d in dims.unique():
                at = np.flatnonzero(dims == d)
                if int(d) in trees:
                    out[at] = trees[int(d)].cell_of(_matrix(vectors.iloc[at], int(d)).astype(np.float64))
            return pd.Series(out)
        return F.pandas_udf(find, "int")("dim", "bytes")

    def _measure(self) -> None:
        """Ranges and norms over all vectors, in place of the sample's. What
        reaches the driver is a row for each split point and sibling: the tree's size."""
        trees = self.trees

        def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            low, high, norms = {}, {}, {}
            for batch in batches:
                for d, part in batch.groupby("dim"):
                    if int(d) not in trees:
                        continue
                    points = _matrix(part["bytes"], int(d)).astype(np.float64)
                    norm = np.sqrt((points ** 2).sum(1))
                    for node, rows, dist, near in trees[int(d)].descend(points):
                        for j in np.unique(near):
                            mine, key = near == j, (int(d), node, int(j))
                            low[key] = np.minimum(low.get(key, np.inf), dist[mine].min(0))
                            high[key] = np.maximum(high.get(key, -np.inf), dist[mine].max(0))
                            n, old = norm[rows[mine]], norms.get(key, (np.inf, -np.inf))
                            norms[key] = min(old[0], n.min()), max(old[1], n.max())
            yield pd.DataFrame([(*key, i, low[key][i], high[key][i], *norms[key]) for key in low for i in range(len(low[key]))],
                               columns=["dim", "node", "j", "i", "low", "high", "least", "most"])
        every = (self.held.select("dim", "bytes")
                 .mapInPandas(ranges, "dim int, node int, j int, i int, low double, high double, least double, most double")
                 .groupBy("dim", "node", "j", "i").agg(F.min("low"), F.max("high"), F.min("least"), F.max("most")).collect())
        for tree in trees.values():
            for low, high, norms in zip(tree.low, tree.high, tree.norms):
                low[:], high[:], norms[:, 0], norms[:, 1] = np.inf, -np.inf, np.inf, -np.inf
        for d, node, j, i, low, high, least, most in every:
            t = trees[d]
            t.low[node][i, j], t.high[node][i, j], t.norms[node][j] = low, high, (least, most)

    def routed(self, queries: DataFrame) -> DataFrame:
        """``queries`` (dim, bytes, arrays least and most) once for each ``cell`` that is left over."""
        trees = self.trees

        def cells(dims: pd.Series, vectors: pd.Series, least: pd.Series, most: pd.Series) -> pd.Series:
            out: list[list[int]] = [[] for _ in range(len(dims))]
            for d in dims.unique():
                at = np.flatnonzero(dims == d)
                if int(d) not in trees:
                    for a in at:
                        out[a] = [0]
                    continue
                low, high = (np.stack(x.iloc[at].tolist()).astype(float) for x in (least, most))
                for cell, rows in trees[int(d)].visit(_matrix(vectors.iloc[at], int(d)).astype(np.float64), low, high):
                    for r in rows:
                        out[at[r]].append(cell)
            return pd.Series(out)
        return queries.withColumn("cell", F.explode(F.pandas_udf(cells, "array<int>")("dim", "bytes", "least", "most")))

    def best(self, queries: DataFrame, k: int, same: bool) -> DataFrame:
        """``q``, ``window``, ``vec_id``, ``score``, ``rank``: the ``k`` best in each window of each
        query, ties to the smaller id. ``queries``: q, id, label, dim, bytes, cell, least, most."""
        asked = queries.join(self.parts, ["dim", "cell"])
        asked = materialize(asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts"), "gnat-asked")
        # A part goes to as many chunks as its requests fill, and to none if none asks.
        chunks = materialize(asked.groupBy("dim", "cell", "part").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")), "gnat-chunks")
        key = ["dim", "cell", "part", "chunk"]
        data = self.held.join(self.parts, ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        data = data.join(chunks, ["dim", "cell", "part"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        asked = asked.join(chunks, ["dim", "cell", "part"]).withColumn("chunk", F.pmod("q", F.col("chunks")).cast("int"))
        schema = T.StructType([T.StructField("q", T.LongType()), T.StructField("window", T.IntegerType()),
                               T.StructField("vec_id", queries.schema["id"].dataType), T.StructField("score", T.LongType())])

        def find(at, data: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            none = pd.DataFrame({c: [] for c in schema.names})
            if not len(data) or not len(asked):
                return none
            dim, ids = int(at[0]), data["id"].to_numpy()
            least, most = (np.stack(asked[c].tolist()).astype(float) for c in ("least", "most"))
            found = search(_matrix(data["bytes"], dim), ids, data["label"].to_numpy(), _matrix(asked["bytes"], dim),
                           asked["id"].to_numpy(), asked["label"].to_numpy(), least, most, k, same)
            if not found:
                return none
            row, window, at, score = (np.concatenate(c) for c in zip(*found))
            order = np.lexsort((ids[at], -score, window, row))
            row, window, at, score = row[order], window[order], at[order], score[order]
            start = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (window[1:] != window[:-1])))
            first = np.arange(len(row)) - np.repeat(start, np.diff(np.append(start, len(row)))) < k
            return pd.DataFrame({"q": asked["q"].to_numpy()[row[first]], "window": window[first], "vec_id": ids[at[first]], "score": score[first]})

        found = (data.select(*key, "id", "label", "bytes").groupBy(key)
                 .cogroup(asked.select(*key, "q", "id", "label", "bytes", "least", "most").groupBy(key)).applyInPandas(find, schema))
        rank = F.row_number().over(Window.partitionBy("q", "window").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k)

    def complete(self, queries: DataFrame, k: int, same: bool, name: str) -> DataFrame:
        """Both passes: scores to beat from each query's own cell, then every cell that can hold better ones."""
        first = self.best(queries.withColumn("cell", self.cell()), k, same).where(F.col("rank") == k)
        beat = first.groupBy("q").agg(F.map_from_entries(F.collect_list(F.struct("window", F.col("score").cast("double")))).alias("beat"))
        queries = queries.join(materialize(beat, f"gnat-{name}-first"), "q", "left")
        raised = F.transform("least", lambda x, w: F.greatest(x, F.coalesce(F.try_element_at("beat", w), x)))
        routed = self.routed(materialize(queries.withColumn("least", raised).drop("beat"), f"gnat-{name}-queries"))
        return materialize(self.best(routed, k, same), f"gnat-{name}")


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, least_pct: int = 30, most_pct: int = 90,
                   scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    A component counts as floor(scale x); a score is the integer inner product
    with the anchor. An anchor's positives are its ``positives`` highest-scored
    other rows of its label; for each, the ``negatives`` highest-scored rows of
    other labels whose score is from ``least_pct`` to ``most_pct`` percent of the
    positive's (all, if fewer), ties to the smaller id.

    Rows with a null id, label or vector, or a null or non-finite component take
    no part; vectors of other lengths than the anchor's don't either, for that
    anchor. Rows alike in id, label and vector count once; of an id with several
    vectors or labels each is an anchor, and none a candidate of the others.
    An empty table, an anchor without positives, and a positive without
    negatives give no rows. Scores are exact up to 2^53.
    """
    rows = (vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), integers(F.col(vector_col), scale).alias("v"),
                           F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
            .where("id is not null and label is not null and v is not null"))
    pack = F.pandas_udf(lambda vs: pd.Series([np.asarray(v, np.int64).tobytes() for v in vs], dtype=object), "binary")
    rows = rows.select("id", "label", "is_anchor", F.size("v").alias("dim"), pack("v").alias("bytes")).dropDuplicates(["id", "label", "bytes"])
    rows = materialize(rows.withColumn("q", F.xxhash64("id", "label", "bytes")), "gnat-rows")
    index = Index(rows.drop("is_anchor", "q"), max(positives + 1, negatives))

    anchors = rows.where("is_anchor").drop("is_anchor")
    end = lambda x: F.lit(float(x))
    near = index.complete(anchors.withColumns({"least": F.array(end("-inf")), "most": F.array(end("inf"))}), positives, True, "positives")

    # A window for each positive, by rank. Its ends are whole numbers, so nothing is rounded.
    share = lambda pct: (F.col("score").cast("decimal(20,0)") * pct) / 100
    windows = (near.groupBy("q").agg(F.array_sort(F.collect_list(F.struct(      # ``positives`` entries at most
        "rank", F.ceil(share(least_pct)).cast("double").alias("low"), F.floor(share(most_pct)).cast("double").alias("high")))).alias("w")))
    ends = lambda c, missing: F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda i: F.coalesce(F.get(F.col(f"w.{c}"), i), end(missing)))
    asked = anchors.join(windows, "q").withColumns({"least": ends("low", "inf"), "most": ends("high", "-inf")}).drop("w")
    far = index.complete(asked, negatives, False, "negatives")

    chosen = near.join(anchors.select("q", F.col("id").alias("anchor_id")), "q").select(
        "q", (F.col("rank") - 1).alias("window"), "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    far = far.select("q", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return chosen.join(far, ["q", "window"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
