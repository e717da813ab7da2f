"""Exact top-k by inner product: dual-tree search over cover trees.

Vectors are dealt to the nearest of a few anchors (spread over a bounded
sample), and each anchor's vectors to blocks of bounded size. A task builds a
cover tree over a block and one over a chunk of the queries, and walks both
together: for a pair of nodes with centres ``a``, ``b`` and covering radii
``r``, ``s``, no product exceeds ``a.b + r|b| + s|a| + rs``; the pair goes
when that is below the worst kth score of the node's queries.

Two passes: the first searches each query's own anchor only, which gives kth
scores to start from; the second sends a query to every anchor whose covering
radius allows a product that reaches its kth score, and is complete. Of
equal vectors only the ``k + 1`` smallest ids can be among the results, so
no more enter the search, however often a vector repeats.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from strata.session import materialize

ANCHORS = 64
SAMPLE = 2048           # vectors that the anchors are chosen from
BLOCK = 4096            # vectors of a block, about
CHUNK = 1024            # queries of a chunk, about
LEAF, CHILDREN = 128, 16


def integers(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component; null for a vector that is null or
    has a null or non-finite component."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(sound, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _matrix(vectors, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), np.int64).reshape(len(vectors), dim)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products (longs)."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2 ** 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2).sum(1))


def _spread(points: np.ndarray, n: int, first: int, until: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Up to ``n`` rows far from each other, until the others are within
    ``until``; with each point's nearest and its distance."""
    chosen, near, dist = [first], np.zeros(len(points), int), _distances(points, points[first])
    while len(chosen) < n and dist.max() > until:
        far = int(dist.argmax())
        d = _distances(points, points[far])
        near[d < dist] = len(chosen)
        dist = np.minimum(dist, d)
        chosen.append(far)
    return np.array(chosen), near, dist


class CoverTree:
    """Each child covers its points within half its parent's radius where
    CHILDREN centres suffice for that; leaves hold up to LEAF points."""

    def __init__(self, points: np.ndarray):
        self.points = points.astype(np.float64)
        self.centre, self.radius, self.children, self.rows = [], [], [], []
        first = int(_distances(self.points, self.points.mean(0)).argmin())
        self._grow(np.arange(len(points)), first)
        self.norm = np.sqrt((self.points[self.centre] ** 2).sum(1))
        self.radius = np.array(self.radius)

    def _grow(self, rows: np.ndarray, centre: int) -> int:
        """A node over ``rows`` around the point ``centre``; returns its number."""
        todo = [(rows, centre, None)]
        while todo:
            rows, centre, parent = todo.pop()
            node = len(self.centre)
            if parent is not None:
                self.children[parent].append(node)
            dist = _distances(self.points[rows], self.points[centre])
            self.centre.append(centre)
            self.radius.append(float(dist.max()))
            self.children.append([])
            self.rows.append(rows)
            if len(rows) <= LEAF or self.radius[node] == 0:
                continue
            chosen, near, _ = _spread(self.points[rows], CHILDREN, int(dist.argmin()), self.radius[node] / 2)
            todo += [(rows[near == i], int(rows[c]), node) for i, c in enumerate(chosen)]
        return 0


def dual_search(queries: np.ndarray, query_ids: np.ndarray, worst: np.ndarray, points: np.ndarray,
                ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, point row, score) of every point that may be among a query's
    k best: none that is, is left out. ``worst``: a score that the kth best is
    known to reach (-inf if none). A query's own id isn't a candidate."""
    q, x = CoverTree(queries), CoverTree(points)
    worst = worst.astype(float).copy()
    best = np.full((len(queries), k), -np.inf)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def bound(a: int, b: np.ndarray) -> np.ndarray:
        top = (x.points[np.array(x.centre)[b]] @ q.points[q.centre[a]] + q.radius[a] * x.norm[b]
               + x.radius[b] * q.norm[a] + q.radius[a] * x.radius[b])
        return top + 1e-6 * (1 + np.abs(top))

    heap = [(-float(bound(0, np.array([0]))[0]), 0, 0)]
    while heap:
        top, a, b = heapq.heappop(heap)
        if -top < worst[q.rows[a]].min():
            continue
        split_q = bool(q.children[a]) and (q.radius[a] >= x.radius[b] or not x.children[b])
        if split_q or x.children[b]:
            pairs = [(c, np.array([b])) for c in q.children[a]] if split_q else [(a, np.array(x.children[b]))]
            for c, nodes in pairs:
                limit = worst[q.rows[c]].min()
                for n, t in zip(nodes.tolist(), bound(c, nodes).tolist()):
                    if t >= limit:
                        heapq.heappush(heap, (-t, c, n))
            continue
        rows, cols = q.rows[a], x.rows[b]
        score = _products(queries[rows], points[cols])
        good = (score >= worst[rows][:, None]) & (query_ids[rows][:, None] != ids[cols][None])
        i, j = np.nonzero(good)
        if len(i):
            out.append((rows[i], cols[j], score[i, j]))
            changed = np.unique(i)
            now = np.where(good[changed], score[changed], -np.inf)
            r = rows[changed]
            best[r] = -np.sort(-np.concatenate([best[r], now], axis=1), axis=1)[:, :k]
            worst[r] = np.maximum(worst[r], best[r, k - 1])
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none
    rows, cols, score = (np.concatenate(c) for c in zip(*out))
    keep = score >= worst[rows]
    return rows[keep], cols[keep], score[keep]


def _anchors(sample: pd.DataFrame) -> dict[int, np.ndarray]:
    """Anchors of each dimension in the sample."""
    out = {}
    for dim, part in sample.groupby("dim"):
        points = np.array(part["v"].tolist(), np.float64).reshape(len(part), dim)
        out[int(dim)] = points[_spread(points, ANCHORS, 0)[0]]
    return out


def _deal(anchors: dict[int, np.ndarray]):
    """Pandas function: the number of a vector's nearest anchor, and its bytes."""
    def deal(vectors: pd.Series) -> pd.DataFrame:
        node, far = [], []
        for v in vectors:
            near = anchors.get(len(v))
            dist = np.zeros(1) if near is None else _distances(near, np.asarray(v, np.float64))
            node.append(-1 if near is None else int(dist.argmin()))
            far.append(float(dist.min()))
        return pd.DataFrame({"anchor": node, "far": far, "bytes": [np.asarray(v, np.int64).tobytes() for v in vectors]})
    return F.pandas_udf(deal, "anchor int, far double, bytes binary")


def _reach(anchors: dict[int, np.ndarray], radii: dict[tuple[int, int], float]):
    """Pandas function: the anchors among whose vectors a product can reach
    ``worst``. Anchor -1 (a length that the sample lacks) always stays."""
    def reach(vectors: pd.Series, dims: pd.Series, worst: pd.Series) -> pd.Series:
        out = []
        for v, dim, w in zip(vectors, dims, worst.fillna(-np.inf)):
            here = [a for d, a in radii if d == dim]
            q = np.frombuffer(v, np.int64).astype(np.float64)
            top = np.array([q @ anchors[dim][a] + radii[dim, a] * np.sqrt(q @ q) for a in here])
            out.append([a for a, t in zip(here, top) if t + 1e-6 * (1 + abs(t)) >= w] or [-1])
        return pd.Series(out)
    return F.pandas_udf(reach, "array<int>")


def _search(k: int, schema: str):
    def search(key, data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(data) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        dim = int(key[0])
        ids, query_ids = data["id"].to_numpy(), queries["id"].to_numpy()
        i, j, score = dual_search(_matrix(queries["bytes"], dim), query_ids,
                                  queries["worst"].fillna(-np.inf).to_numpy(float), _matrix(data["bytes"], dim), ids, k)
        order = np.lexsort((ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        start = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]])) if len(i) else np.zeros(0, int)
        place = np.arange(len(i)) - np.repeat(start, np.diff(np.append(start, len(i))))
        i, j, score = i[place < k], j[place < k], score[place < k]
        return pd.DataFrame({"query_id": query_ids[i], "vec_id": ids[j], "score": score})
    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: each query's ``k``
    highest integer inner products over all other rows (all of them, if fewer),
    ties to the smaller id. Queries are the rows where ``is_query`` holds.

    Vectors that are null or have a null or non-finite component, and rows with
    a null id, take no part; vectors of other lengths than the query's aren't
    its candidates. A row repeated with the same vector counts once; an id with
    several vectors is a candidate with each, and as a query has the best of all
    its vectors' scores. An empty table gives no rows.
    """
    rows = (vectors.select(F.col(id_col).alias("id"), integers(F.col(vector_col)).alias("v"), is_query.alias("is_query"))
            .where("id is not null and v is not null").dropDuplicates(["id", "v"]).withColumn("dim", F.size("v")))
    sample = rows.orderBy(F.xxhash64("id", "v"), "id").limit(SAMPLE).select("dim", "v").toPandas()
    anchors = _anchors(sample)
    dealt = rows.select("id", "is_query", "dim", _deal(anchors)("v").alias("d"))
    dealt = materialize(dealt.select("id", "is_query", "dim", "d.anchor", "d.far", "d.bytes"), "vectors")

    # The k + 1 smallest ids of each distinct vector.
    place = F.row_number().over(Window.partitionBy("dim", "anchor", "bytes").orderBy("id"))
    data = materialize(dealt.withColumn("n", place).where(F.col("n") <= k + 1).select("id", "dim", "anchor", "far", "bytes"), "candidates")
    nodes = materialize(data.groupBy("dim", "anchor").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"), F.max("far").alias("radius")), "nodes")
    radii = {(r["dim"], r["anchor"]): r["radius"] for r in nodes.where("anchor >= 0").collect()}   # SAMPLE rows at most
    data = (data.join(nodes, ["dim", "anchor"]).select(
        "id", "dim", "anchor", "bytes", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part")))
    asked = dealt.where("is_query").select("id", "dim", "bytes", F.col("anchor").alias("home"))
    blocks = nodes.select("dim", "anchor", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))

    block = ["dim", "anchor", "part"]
    key = [*block, "chunk"]
    id_type = vectors.schema[id_col].dataType
    schema = T.StructType([T.StructField("query_id", id_type), T.StructField("vec_id", id_type), T.StructField("score", T.LongType())])
    ranked = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))

    def search(queries: DataFrame) -> DataFrame:
        # A block is read once for each CHUNK of queries sent to it, and not at all if none is.
        queries = materialize(queries, "asked")
        chunks = materialize(queries.groupBy(block).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")), "chunks")
        near = data.join(chunks, block).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        queries = queries.join(chunks, block).withColumn("chunk", F.pmod(F.xxhash64("id", "bytes"), F.col("chunks")).cast("int"))
        found = (near.select(*key, "id", "bytes").groupBy(key)
                 .cogroup(queries.select(*key, "id", "bytes", "worst").groupBy(key)).applyInPandas(_search(k, schema), schema))
        return found.withColumn("rank", ranked).where(F.col("rank") <= k)

    nowhere = F.lit(None).cast("double").alias("worst")
    home = asked.withColumnRenamed("home", "anchor").join(blocks, ["dim", "anchor"]).select(*block, "id", "bytes", nowhere)
    first = materialize(search(home).where(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("worst")), "first-pass")
    asked = asked.join(first, asked["id"] == first["query_id"], "left").drop("query_id")
    routed = asked.withColumn("anchor", F.explode(_reach(anchors, radii)("bytes", "dim", "worst")))
    return search(routed.join(blocks, ["dim", "anchor"]).select(*block, "id", "bytes", "worst")).select("query_id", "rank", "vec_id", "score")
