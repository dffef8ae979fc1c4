"""Exact greatest inner products by best-first search of M-trees.

Inner products become distances: with M the greatest norm in a tree, a vector x stands at
(x, sqrt(M^2 - |x|^2)) and a query q at (q, 0), so d(q, x)^2 = |q|^2 + M^2 - 2 q.x, and
the nearest are those of greatest inner product. An M-tree keeps vectors in pages. An
entry of an inner page has a routing vector, a covering radius, its distance to the
page's own routing vector, and a child; an entry of a leaf has a vector and that distance.

Queries of a block go down together, page by page, the page of least bound first. Before
any distance of an entry is computed, the triangle inequality on the stored parent
distance must leave some query for it: |d(q, parent) - d(entry, parent)| - radius. A
page is left out for a query when d - radius is beyond its k-th best. Bounds allow for
rounding; scores are integer sums, exact below 2^53.

Vectors are dealt to trees of about ``TREE`` by a hash of their row, so equal vectors do
not meet in one task. Query blocks are joined with trees; each pair of a block and a tree
gives k rows a query, of which a window keeps the best k. This is a stated query set in
blocks against all rows.

Defined cases: vectors that are null, empty or hold nulls or non-finite components take no
part; vectors of different length never meet; a query's own row is no candidate, but rows
that repeat its vec_id are; null vec_ids are candidates, sort first among ties and are no
queries; fewer candidates than k give fewer rows; an empty table gives none; other columns
are not read.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import map_arrow, record, saved

TOP, SCALE, EVERY = 5, 256, 50
TREE, QUERIES_PER_BLOCK = 8192, 512
PAGE, FAN = 64, 16
_NO_ID = np.iinfo(np.int64).min
_PACKED = "dim int, number int, blob binary"
_FOUND = pa.schema([("q_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_FOUND_DDL = "q_row long, query_id long, vec_id long, score long"


class MTree:
    """Pages in flat arrays; ``root`` is the first page."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, seed=0):
        self.vectors, self.ids, self.rows = vectors, ids, rows
        squares = (vectors * vectors).sum(axis=1)
        self.square = float(squares.max())
        self.lift = np.sqrt(np.maximum(self.square - squares, 0))
        self.points = np.concatenate([vectors, self.lift[:, None]], axis=1)
        self.inner: dict[int, tuple] = {}  # page: (points of entries, radii, distances to parent, children)
        self.leaf: dict[int, tuple] = {}  # page: (places of vectors, distances to parent)
        self.random = np.random.default_rng(seed)
        self.pages = 0
        self._page(np.arange(len(vectors)), None)

    def _distances(self, places: np.ndarray, point: np.ndarray) -> np.ndarray:
        return np.sqrt(((self.points[places] - point) ** 2).sum(axis=1))

    def _page(self, places: np.ndarray, parent: np.ndarray | None) -> int:
        """Make the page of these vectors; top-down, by the nearest of pivots picked far apart."""
        number, self.pages = self.pages, self.pages + 1
        to_parent = self._distances(places, parent) if parent is not None else np.zeros(len(places))
        if len(places) <= PAGE:
            self.leaf[number] = (places, to_parent)
            return number
        near = np.full(len(places), np.inf)
        owner, pivots = np.zeros(len(places), np.int64), []
        pick = int(self.random.integers(len(places)))
        for k in range(FAN):
            pivots.append(places[pick])
            d = self._distances(places, self.points[places[pick]])
            owner[d < near] = k
            near = np.minimum(near, d)
            pick = int(near.argmax())
            if near[pick] <= 0:
                break
        groups = [places[owner == k] for k in range(len(pivots))]
        if len(pivots) == 1 or max(map(len, groups)) > 0.95 * len(places):  # equal or nearly equal vectors
            groups = np.array_split(places, -(-len(places) // max(PAGE, len(places) // FAN)))
            pivots = [g[0] for g in groups]
        keep = [(p, g) for p, g in zip(pivots, groups) if len(g)]
        points = self.points[[p for p, _ in keep]]
        radii = np.array([self._distances(g, x).max() for x, (_, g) in zip(points, keep)])
        outer = np.sqrt(((points - parent) ** 2).sum(axis=1)) if parent is not None else np.zeros(len(keep))
        self.inner[number] = (points, radii, outer, [self._page(g, x) for x, (_, g) in zip(points, keep)])
        return number

    def search(self, queries: np.ndarray, own_rows: np.ndarray, k: int):
        """Places and scores of each query's best ``k``, -1 where there are fewer; ties to the smaller id."""
        n = len(queries)
        squares = (queries * queries).sum(axis=1)
        best = np.full((n, k), -np.inf)
        found = np.full((n, k), -1, np.int64)
        slack = 1e-6 * (1 + np.sqrt(squares + self.square))
        self.computed = 0

        def reach(active):
            """The distance beyond which nothing can be among the best."""
            worst = best[active, -1]
            room = np.where(np.isinf(worst), np.inf, squares[active] + self.square - 2 * np.where(np.isinf(worst), 0, worst))
            return np.sqrt(np.maximum(room, 0)) + slack[active]

        heap = [(0.0, 0, np.arange(n), np.zeros(n), np.zeros(n))]
        while heap:
            _, page, active, bound, to_parent = heapq.heappop(heap)
            limit = reach(active)
            still = bound <= limit
            active, to_parent, limit = active[still], to_parent[still], limit[still]
            if not len(active):
                continue
            if page in self.leaf:
                places, apart = self.leaf[page]
                if page:
                    near = (np.abs(to_parent[:, None] - apart) <= limit[:, None]).any(axis=0)
                    places = places[near]
                if not len(places):
                    continue
                self.computed += len(active) * len(places)
                scores = queries[active] @ self.vectors[places].T
                scores[own_rows[active][:, None] == self.rows[places]] = -np.inf
                better = scores.max(axis=1) >= best[active, -1]
                self._merge(active[better], places, scores[better], best, found)
                continue
            points, radii, apart, children = self.inner[page]
            wanted = np.ones(len(children), bool)
            if page:
                wanted = (np.abs(to_parent[:, None] - apart) - radii <= limit[:, None]).any(axis=0)
            wanted = np.flatnonzero(wanted)
            self.computed += len(active) * len(wanted)
            products = queries[active] @ points[wanted, :-1].T
            lengths = (points[wanted] ** 2).sum(axis=1)
            d = np.sqrt(np.maximum(squares[active][:, None] + lengths - 2 * products, 0))
            low = np.maximum(d - radii[wanted], 0)
            for j, c in enumerate(wanted.tolist()):
                go = low[:, j] <= limit
                if go.any():
                    heapq.heappush(heap, (float(low[go, j].min()), children[c], active[go], low[go, j], d[go, j]))
        return found, best

    def _merge(self, active, places, scores, best, found):
        k = best.shape[1]
        every = np.concatenate([best[active], scores], axis=1)
        of = np.concatenate([found[active], np.broadcast_to(places, scores.shape)], axis=1)
        names = np.where(of >= 0, self.ids[of], np.iinfo(np.int64).max)
        order = np.lexsort((names, -every), axis=1)[:, :k]
        at = np.arange(len(active))[:, None]
        best[active] = every[at, order]
        found[active] = np.where(np.isinf(every[at, order]), -1, of[at, order])

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("random", "points")}

    def __setstate__(self, state):
        self.__dict__.update(state)


def _rows_of(group) -> tuple:
    vectors = np.array(group["vector"].tolist(), np.float64)
    ids = group["vec_id"].fillna(_NO_ID).astype("int64").to_numpy()
    return vectors, ids, group["row"].to_numpy(np.int64)


def _build(key, group):
    import pandas as pd

    tree = MTree(*_rows_of(group.sort_values("row")))
    return pd.DataFrame({"dim": [key[0]], "number": [key[1]], "blob": [pickle.dumps(tree)]})


def _block(key, group):
    import pandas as pd

    return pd.DataFrame({"dim": [key[0]], "number": [key[1]], "blob": [pickle.dumps(_rows_of(group.sort_values("row")))]})


def _searcher(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, block in zip(batch.column("tree"), batch.column("block")):
                tree, (queries, ids, rows) = pickle.loads(tree.as_buffer()), pickle.loads(block.as_buffer())
                found, scores = tree.search(queries, rows, k)
                q, j = np.nonzero(found >= 0)
                names = tree.ids[found[q, j]]
                yield record(
                    _FOUND, q_row=rows[q], query_id=ids[q], vec_id=pa.array(names, mask=names == _NO_ID), score=scores[q, j].astype(np.int64)
                )

    return search


def vectors_of(embeddings: DataFrame, scale=SCALE) -> DataFrame:
    """row, vec_id, dim, vector: components floor(scale * x) as double; only whole finite vectors."""
    vector = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    fit = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < 1e300))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where("embedding is not null and size(embedding) > 0").where(fit)
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.size("embedding").alias("dim"), vector.alias("vector"))


def greatest_products(embeddings: DataFrame, k=TOP, every=EVERY, scale=SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the best k of every row whose vec_id is divisible by ``every``."""
    from .shared import ship

    ship(embeddings.sparkSession)
    vectors = saved(vectors_of(embeddings, scale), "vectors")
    queries = vectors.where(F.col("vec_id") % every == 0)
    sizes = vectors.groupBy("dim").agg(F.ceil(F.count("*") / TREE).cast("int").alias("trees"))
    asked = queries.groupBy("dim").agg(F.ceil(F.count("*") / QUERIES_PER_BLOCK).cast("int").alias("blocks"))

    def dealt(rows, counts, name):
        return rows.join(counts, "dim").withColumn("number", F.pmod(F.xxhash64("row"), F.col(name)).cast("int"))

    trees = saved(dealt(vectors, sizes, "trees").groupBy("dim", "number").applyInPandas(_build, _PACKED), "trees")
    blocks = saved(dealt(queries, asked, "blocks").groupBy("dim", "number").applyInPandas(_block, _PACKED), "blocks")
    spread = blocks.join(sizes, "dim").select("dim", F.col("blob").alias("block"), F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("number"))
    pairs = spread.join(trees.withColumnRenamed("blob", "tree"), ["dim", "number"]).select("tree", "block")
    found = map_arrow(pairs, _searcher(k), _FOUND_DDL)
    rank = F.row_number().over(W.partitionBy("q_row").orderBy(F.desc("score"), F.asc_nulls_first("vec_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
