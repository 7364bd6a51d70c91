"""Exact top-k by inner product with a dual-tree search over cover trees.

Vectors are dealt into blocks; each block of queries meets each block of candidates in one task,
which builds a cover tree over both. A node's children lie within its covering radius, and the
centres of children are farther apart than the children's radius. No pair below nodes q and r can
score more than

    <cq, cr> + |cq| rad(r) + |cr| rad(q) + rad(q) rad(r),

so a pair of nodes is left when that is less than the worst k-th score among the queries below q.
The best k of each block are merged per query. Nothing is approximate.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnloom.operators.scale import cut_lineage

K = 5
SCALE = 256
QUERY_EVERY = 50
# Rows of one block of candidates, and of queries.
BLOCK_ROWS = 8192
QUERY_ROWS = 2048
LEAF = 24
_SHRINK = (0.5, 0.7, 0.85)
_EXACT = float(1 << 53)


class CoverTree:
    """Nodes by number: ``center`` (a row), ``radius``, ``children`` or, in a leaf, ``members``."""

    def __init__(self, points: np.ndarray) -> None:
        self.points = points
        self.norm = np.sqrt((points * points).sum(axis=1))
        self.center: list[int] = []
        self.radius: list[float] = []
        self.children: list[np.ndarray | None] = []
        self.members: list[np.ndarray | None] = []
        if len(points):
            self._grow()

    def _distances(self, center: int, rows: np.ndarray) -> np.ndarray:
        gap = self.points[rows] - self.points[center]
        return np.sqrt(np.einsum("ij,ij->i", gap, gap))

    def _node(self, center: int, rows: np.ndarray, far: np.ndarray) -> int:
        self.center.append(center)
        self.radius.append(float(far.max(initial=0.0)))
        self.children.append(None)
        self.members.append(rows)
        return len(self.center) - 1

    def _grow(self) -> None:
        rows = np.arange(len(self.points))
        far = self._distances(0, rows)
        waiting = [(self._node(0, rows, far), rows, far)]
        while waiting:
            node, rows, far = waiting.pop()
            if len(rows) <= LEAF or self.radius[node] == 0:
                continue
            for shrink in _SHRINK:
                net = self._net(self.center[node], rows, far, shrink * self.radius[node])
                if net is not None:
                    children = [(self._node(c, r, f), r, f) for c, r, f in net]
                    self.children[node] = np.array([c for c, _, _ in children])
                    self.members[node] = None
                    waiting.extend(children)
                    break
        self.center = np.array(self.center)
        self.radius = np.array(self.radius)

    def _net(self, center: int, rows: np.ndarray, far: np.ndarray, radius: float):
        """Centres farther apart than ``radius`` that cover ``rows``; the node's own is one.

        None when there would be nearly as many as rows, as in a shell of far-off points.
        """
        near = far <= radius
        net = [(center, rows[near], far[near])]
        rest = rows[~near]
        while len(rest):
            if len(net) > 2 + len(rows) // 8:
                return None
            far = self._distances(int(rest[0]), rest)
            near = far <= radius
            net.append((int(rest[0]), rest[near], far[near]))
            rest = rest[~near]
        return net


def _scores(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        return (a @ b.T).astype(np.int64)
    low, high = -(1 << 63), (1 << 63) - 1
    whole = [[int(x) for x in row] for row in b]
    return np.array(
        [[min(high, max(low, sum(int(x) * y for x, y in zip(q, r)))) for r in whole] for q in a],
        np.int64,
    ).reshape(len(a), len(b))


class Search:
    """The best ``k`` rows for each query; of equal scores the smaller (id, row)."""

    def __init__(self, queries, candidates, ids, uids, own, k: int) -> None:
        self.q, self.r = CoverTree(queries), CoverTree(candidates)
        self.ids, self.uids, self.own, self.k = ids, uids, own, k
        most = [float(np.abs(x).max(initial=0)) for x in (queries, candidates)]
        self.exact = most[0] * most[1] * max(1, queries.shape[1]) < _EXACT
        self.score = np.full((len(queries), k), np.iinfo(np.int64).min)
        self.found = np.full((len(queries), k), -1)
        self.worst = np.full(len(self.q.center), -np.inf)
        if len(queries) and len(candidates):
            self._visit(0, 0)

    def _bound(self, q: int, nodes: np.ndarray) -> np.ndarray:
        cq, rq = self.q.center[q], self.q.radius[q]
        cr, rr = self.r.center[nodes], self.r.radius[nodes]
        nq, nr = self.q.norm[cq], self.r.norm[cr]
        bound = self.r.points[cr] @ self.q.points[cq] + nq * rr + nr * rq + rq * rr
        # rounding of the terms above never makes the bound too small
        return bound + 1e-9 * (nq + rq) * (nr + rr) + 1e-6

    def _visit(self, q: int, r: int) -> None:
        inner_q, inner_r = self.q.children[q], self.r.children[r]
        if inner_r is not None and (inner_q is None or self.r.radius[r] >= self.q.radius[q]):
            bound = self._bound(q, inner_r)
            for at in np.argsort(-bound, kind="stable"):
                if bound[at] < self.worst[q]:
                    break
                self._visit(q, int(inner_r[at]))
        elif inner_q is not None:
            node = np.array([r])
            for child in inner_q.tolist():
                if self._bound(child, node)[0] >= self.worst[child]:
                    self._visit(child, r)
            self.worst[q] = self.worst[inner_q].min()
        else:
            self._leaves(q, self.r.members[r])

    def _leaves(self, q: int, rows: np.ndarray) -> None:
        queries = self.q.members[q]
        least = np.iinfo(np.int64).min
        fresh = _scores(self.q.points[queries], self.r.points[rows], self.exact)
        other = self.uids[rows] != self.own[queries][:, None]
        # what a query has already, or the k-th best here, bars all lower scores
        bar = self.score[queries, -1]
        if len(rows) > self.k:
            at = len(rows) - self.k - 1  # one more, for the query's own row
            bar = np.maximum(bar, np.partition(fresh, at, axis=1)[:, at])
        query, place = np.nonzero((fresh >= bar[:, None]) & other)
        if not len(query):
            return
        old_query, old_place = np.nonzero(self.found[queries] >= 0)
        query = np.concatenate([old_query, query])
        score = np.concatenate([self.score[queries][old_query, old_place], fresh[query[len(old_query):], place]])
        found = np.concatenate([self.found[queries][old_query, old_place], rows[place]])
        order = np.lexsort((self.uids[found], self.ids[found], ~score, query))
        query, score, found = query[order], score[order], found[order]
        begin = np.searchsorted(query, np.arange(len(queries)))
        rank = np.arange(len(query)) - begin[query]
        keep = rank < self.k
        query, rank = query[keep], rank[keep]
        new_score = np.full((len(queries), self.k), least)
        new_found = np.full((len(queries), self.k), -1)
        new_score[query, rank], new_found[query, rank] = score[keep], found[keep]
        self.score[queries], self.found[queries] = new_score, new_found
        full = new_found[:, -1] >= 0
        self.worst[q] = new_score[:, -1].min() if full.all() else -np.inf


def _few_of_equal(vectors: np.ndarray, ids: np.ndarray, uids: np.ndarray, k: int) -> np.ndarray:
    """Rows without those that ``k`` equal vectors with smaller ids always go before."""
    if not vectors.shape[1]:
        same = np.zeros(len(vectors), np.int64)
    else:
        raw = np.ascontiguousarray(vectors).view(np.dtype((np.void, 8 * vectors.shape[1]))).ravel()
        same = np.unique(raw, return_inverse=True)[1].ravel()
    order = np.lexsort((uids, ids, same))
    first = np.flatnonzero(np.diff(same[order], prepend=-1))
    place = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return np.sort(order[place < k])


def _matrix(column: pa.Array, scale: int) -> np.ndarray:
    rows = len(column)
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(values * scale).reshape(rows, -1 if len(values) else 0)


def top_k(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    scale: int = SCALE,
    every: int = QUERY_EVERY,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` best, by inner product of
    ``floor(scale * x)``.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but the
    query's own. Equal scores go to the smaller id, then to the earlier row. Null vectors, those
    that hold a null or a value that is not finite, and rows without an id take no part; vectors
    of different length never meet; scores beyond a long stay at its limits. Repeated rows are
    candidates of each other. Fewer candidates than ``k`` give fewer rows, an empty table none.
    """
    x = F.col(vector_col)
    # stored with their numbers: another plan of the scan could number other rows alike
    rows = cut_lineage(
        df.select(
            F.monotonically_increasing_id().alias("uid"),
            F.col(id_col).cast("long").alias("id"),
            F.transform(x, lambda v: v.cast("double")).alias("v"),
        ).filter(
            F.col("id").isNotNull()
            & F.col("v").isNotNull()
            & F.forall("v", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        )
    )
    is_query = F.col("id") % every == 0
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    blocks = max(1, -(-n // BLOCK_ROWS))
    chunks = max(1, -(-n_queries // QUERY_ROWS))
    size = F.size("v").alias("size")
    candidates = rows.select(
        size,
        F.pmod(F.xxhash64("uid"), F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("chunk"),
        F.lit(False).alias("asks"),
        "uid",
        "id",
        "v",
    )
    queries = rows.filter(is_query).select(
        size,
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        F.pmod(F.xxhash64("uid"), F.lit(chunks)).alias("chunk"),
        F.lit(True).alias("asks"),
        "uid",
        "id",
        "v",
    )

    def tile(table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy()
        ids, uids = table["id"].to_numpy(), table["uid"].to_numpy()
        vectors = _matrix(table["v"], scale)
        own = np.flatnonzero(asks)
        rest = np.flatnonzero(~asks)
        rest = rest[_few_of_equal(vectors[rest], ids[rest], uids[rest], k + 1)]
        search = Search(vectors[own], vectors[rest], ids[rest], uids[rest], uids[own], k)
        q, place = np.nonzero(search.found >= 0)
        hit = search.found[q, place]
        return pa.table(
            {
                "uid": uids[own][q],
                "query_id": ids[own][q],
                "vec_id": ids[rest][hit] if len(hit) else hit,
                "other": uids[rest][hit] if len(hit) else hit,
                "score": search.score[q, place],
            }
        )

    best = (
        candidates.unionByName(queries)
        .groupBy("size", "block", "chunk")
        .applyInArrow(tile, "uid long, query_id long, vec_id long, other long, score long")
    )
    order = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id", "other")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
