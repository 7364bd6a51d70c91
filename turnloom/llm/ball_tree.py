"""Exact ranked search by a sparse ball tree.

A document is a sparse vector over the terms that the queries of a block name: the term's weight
times how much the document says of it, a whole number. A query is a vector of ones, so that a
score is an inner product. Documents of a task go into trees; a node has the mean of its vectors,
the radius of the ball around it that holds them, and its radius along each term: how far a vector
goes beyond the mean there. No document below the node can score more than

    <q, mean> + |q| * radius    or    <q, mean> + <q, radius along each term>,

rounded up. Nodes are visited best first, until the best that is left lies below the query's
k-th score; the vectors of a leaf are scored with whole numbers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnloom.llm import words
from turnloom.operators.scale import cut_lineage

K = 50
# A block of queries: no more terms with repeats, and no more queries (or one query of any size).
BLOCK_TERMS = 1 << 20
BLOCK_QUERIES = 4096
# Entries and vectors of one tree; a longer document makes a tree of its own.
TREE_ENTRIES = 1 << 21
TREE_VECTORS = 1 << 14
LEAF = 8
# Documents that set the scores to beat before the search: those with the smallest hash.
FIRST_LOOK = 1 << 13


def _split(texts: list[bytes | None]) -> tuple[words.Words, np.ndarray]:
    """Terms: runs of ASCII letters, digits and other characters, A-Z in lower case."""
    found = words.split([t and t.lower() for t in texts], marks=True)
    return found, words.hashes(found).view(np.int64)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct terms of each query."""
    for batch in batches:
        texts = words.as_bytes(batch["text"])
        for start, stop in words.text_blocks(texts):
            found, hashes = _split(texts[start:stop])
            ends = found.first
            rows = [np.unique(hashes[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            part = batch.slice(start, stop - start)
            yield pa.RecordBatch.from_arrays(
                [part["uid"], part["id"], pa.array(rows, pa.list_(pa.int64()))],
                ["uid", "id", "terms"],
            )


def _vectors(vocabulary: np.ndarray):
    """``id, n, terms, tf`` of each document: its length and its terms by place in ``vocabulary``."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = max(1, len(vocabulary))
        for batch in batches:
            texts = words.as_bytes(batch["text"])
            for start, stop in words.text_blocks(texts):
                found, hashes = _split(texts[start:stop])
                place = np.searchsorted(vocabulary, hashes)
                place[place == len(vocabulary)] = 0
                known = np.flatnonzero(vocabulary[place] == hashes) if len(vocabulary) else place[:0]
                key, tf = np.unique(found.of_text[known] * size + place[known], return_counts=True)
                ends = np.searchsorted(key, np.arange(stop - start + 1) * size).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["id"].slice(start, stop - start),
                        pa.array(found.counts, pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(key % size, pa.int32())),
                        pa.ListArray.from_arrays(ends, pa.array(tf, pa.int32())),
                    ],
                    ["id", "n", "terms", "tf"],
                )

    return vectors


def weights(df: np.ndarray, n: int) -> np.ndarray:
    """A term's weight by the number of documents that hold it, of ``n``."""
    return np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64)


def impacts(tf: np.ndarray, lengths: np.ndarray, n: int, total: int) -> np.ndarray:
    """What each entry's term frequency counts in a document of that length."""
    if not len(tf):
        return tf
    if 50 * int(lengths.max()) * n < 1 << 63:
        m = 50 + (50 * lengths * n) // total
    else:
        m = np.array([50 + 50 * int(x) * n // total for x in lengths], np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class BallTree:
    """Sparse vectors as ``ends, terms, values``, in the end in the order of the leaves; row ``i``
    is vector ``order[i]`` of those given. ``size`` is the number of terms there are."""

    def __init__(self, ends: np.ndarray, terms: np.ndarray, values: np.ndarray, size: int) -> None:
        self._work = np.zeros(size)
        self.order = np.arange(len(ends) - 1)
        self.ends, self.terms, self.values = ends, terms, values
        self.spans: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        self.radius: list[float] = []
        means: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        waiting = [(0, len(self.order), -1)]
        while waiting:
            start, stop, parent = waiting.pop()
            node = len(self.spans)
            self.spans.append((start, stop))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(node)
            flat, row = self._entries(start, stop)
            terms, mean, square = self._describe(flat, row, stop - start, means)
            if stop - start > LEAF:
                cut = self._cut(start, stop, flat, row, terms, mean, square)
                waiting += [(cut, stop, node), (start, cut, node)]
        self._arrange(means, size)

    def _entries(self, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the entries of these rows, and each entry's row from 0."""
        rows = self.order[start:stop]
        counts = self.ends[rows + 1] - self.ends[rows]
        row = np.repeat(np.arange(len(rows)), counts)
        first = np.cumsum(counts) - counts
        return np.arange(len(row)) + np.repeat(self.ends[rows] - first, counts), row

    def _describe(self, flat: np.ndarray, row: np.ndarray, n: int, means: list):
        """The node's mean and radii; returns the mean and each row's square."""
        order = np.argsort(self.terms[flat], kind="stable")
        sorted_terms, sorted_values = self.terms[flat][order], self.values[flat][order]
        first = np.flatnonzero(np.diff(sorted_terms, prepend=-1))
        terms = sorted_terms[first]
        mean = np.add.reduceat(sorted_values.astype(np.float64), first) / n
        beyond = np.maximum.reduceat(sorted_values, first) - mean
        means.append((terms, mean, np.maximum(beyond, 0)))
        square = np.bincount(row, self.values[flat].astype(np.float64) ** 2, n)
        of_mean = float(mean @ mean)
        far = square - 2 * self._dot(flat, row, n, terms, mean) + of_mean
        # the terms of ``far`` cancel: add more than their rounding
        self.radius.append(float(np.sqrt(max(0.0, far.max()) + 1e-9 * (square.max() + of_mean))))
        return terms, mean, square

    def _dot(self, flat: np.ndarray, row: np.ndarray, n: int, terms: np.ndarray, values: np.ndarray):
        self._work[terms] = values
        out = np.bincount(row, self._work[self.terms[flat]] * self.values[flat], n)
        self._work[terms] = 0
        return out

    def _vector(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.ends[row], self.ends[row + 1]
        return self.terms[a:b], self.values[a:b].astype(np.float64)

    def _cut(self, start: int, stop: int, flat, row, terms, mean, square) -> int:
        """Part the rows by which of two far vectors is nearer; by the middle if that is lopsided."""
        n = stop - start
        rows = self.order[start:stop].copy()
        one = int((square - 2 * self._dot(flat, row, n, terms, mean)).argmax())
        to_one = square - 2 * self._dot(flat, row, n, *self._vector(rows[one])) + square[one]
        two = int(to_one.argmax())
        to_two = square - 2 * self._dot(flat, row, n, *self._vector(rows[two])) + square[two]
        lean = to_one - to_two
        nearer = int((lean <= 0).sum())
        if not n // 16 < nearer < n - n // 16:
            nearer = n // 2
        self.order[start:stop] = rows[np.argsort(lean, kind="stable")]
        return start + nearer

    def _arrange(self, means: list, size: int) -> None:
        flat, row = self._entries(0, len(self.order))
        self.terms, self.values = self.terms[flat], self.values[flat]
        self.ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(self.order)))])
        node = np.repeat(np.arange(len(means)), [len(m[0]) for m in means])
        terms = np.concatenate([m[0] for m in means])
        order = np.argsort(terms, kind="stable")
        self._nodes = node[order]
        self._means = np.concatenate([m[1] for m in means])[order]
        self._along = np.concatenate([m[2] for m in means])[order]
        self._columns = np.searchsorted(terms[order], np.arange(size + 1))
        self.radius = np.array(self.radius)

    def bounds(self, terms: np.ndarray) -> np.ndarray:
        """For each node, what no vector below it can go beyond."""
        parts = [slice(self._columns[t], self._columns[t + 1]) for t in terms]
        nodes = np.concatenate([self._nodes[p] for p in parts])
        mean = np.bincount(nodes, np.concatenate([self._means[p] for p in parts]), len(self.spans))
        along = np.bincount(nodes, np.concatenate([self._along[p] for p in parts]), len(self.spans))
        out = mean + np.minimum(along, np.sqrt(len(terms)) * self.radius)
        return out * (1 + 1e-9) + 1

    def scores(self, node: int, asked: np.ndarray) -> tuple[int, np.ndarray]:
        """The first row of a leaf and its rows' scores; ``asked[t]``: the query has term t."""
        start, stop = self.spans[node]
        a, b = self.ends[start], self.ends[stop]
        hit = np.where(asked[self.terms[a:b]], self.values[a:b], 0)
        total = np.concatenate([[0], np.cumsum(hit)])
        return start, np.diff(total[self.ends[start : stop + 1] - a])


class Best:
    """The ``k`` highest scores above ``floor[q]`` of each query, ties to the smaller id."""

    def __init__(self, queries: list[np.ndarray], size: int, floor: np.ndarray, k: int) -> None:
        self.queries, self.k = queries, k
        self.floor = floor.copy()
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in queries]
        self._asked = np.zeros(size, bool)
        self.scored = self.leaves = 0

    def look_through(self, tree: BallTree, ids: list[np.ndarray]) -> None:
        for q, terms in enumerate(self.queries):
            if len(terms):
                self._best_first(q, terms, tree, ids)

    def _best_first(self, q: int, terms: np.ndarray, tree: BallTree, ids: list[np.ndarray]) -> None:
        bounds = tree.bounds(terms)
        self._asked[terms] = True
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < self.floor[q]:
                break
            children = tree.children[node]
            if not children:
                self._take(q, tree, ids, *tree.scores(node, self._asked))
                self.leaves += 1
            else:
                for child in children:
                    if bounds[child] >= self.floor[q]:
                        heapq.heappush(heap, (-bounds[child], child))
        self._asked[terms] = False

    def _take(self, q: int, tree: BallTree, ids: list[np.ndarray], start: int, scores: np.ndarray) -> None:
        self.scored += len(scores)
        good = np.flatnonzero(scores >= self.floor[q])
        if not len(good):
            return
        owners = [ids[tree.order[start + i]] for i in good.tolist()]
        old_score, old_id = self.found[q]
        score = np.concatenate([old_score, np.repeat(scores[good], [len(o) for o in owners])])
        found = np.concatenate([old_id, *owners])
        keep = np.lexsort((found, -score))[: self.k]
        self.found[q] = score[keep], found[keep]
        if len(keep) == self.k:
            self.floor[q] = max(self.floor[q], score[keep[-1]])


# Stands for a null id, which comes last among equal scores.
_NO_ID = np.iinfo(np.int64).max


class _Gathered:
    """Distinct vectors of some batches, each with the ids of at most ``k`` documents: of copies
    no more can be among the best."""

    def __init__(self, k: int) -> None:
        self.k, self.places, self.entries = k, {}, 0
        self.terms: list[np.ndarray] = []
        self.values: list[np.ndarray] = []
        self.ids: list[list[int]] = []

    def add(self, id_: int, terms: np.ndarray, values: np.ndarray) -> None:
        key = (terms.tobytes(), values.tobytes())
        place = self.places.get(key)
        if place is None:
            self.places[key] = len(self.terms)
            self.terms.append(terms)
            self.values.append(values)
            self.ids.append([id_])
            self.entries += len(terms)
            return
        heap = self.ids[place]  # the largest id, negated, first once it is full
        heap.append(id_)
        if len(heap) >= 2 * self.k:
            self.ids[place] = heapq.nsmallest(self.k, heap)

    @property
    def full(self) -> bool:
        return self.entries >= TREE_ENTRIES or len(self.terms) >= TREE_VECTORS

    def tree(self, size: int) -> tuple[BallTree, list[np.ndarray]]:
        ends = np.concatenate([[0], np.cumsum([len(t) for t in self.terms])])
        ids = [np.array(heapq.nsmallest(self.k, i), np.int64) for i in self.ids]
        return BallTree(ends, np.concatenate(self.terms), np.concatenate(self.values), size), ids


def _search(queries: list[np.ndarray], weight: np.ndarray, n: int, total: int, floor: np.ndarray, k: int):
    """``query, id, score`` of each task's best documents, and a row with its counts."""

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[BallTree, list[np.ndarray]]]:
        held = _Gathered(k)
        for batch in batches:
            ids = batch["id"].fill_null(_NO_ID).to_numpy()
            ends = batch["terms"].offsets.to_numpy()
            ends = ends - ends[0]
            terms = batch["terms"].flatten().to_numpy()
            tf = batch["tf"].flatten().to_numpy().astype(np.int64)
            lengths = np.repeat(batch["n"].to_numpy(), np.diff(ends))
            values = weight[terms] * impacts(tf, lengths, n, total)
            for i in range(len(ids)):
                a, b = ends[i], ends[i + 1]
                held.add(int(ids[i]), terms[a:b], values[a:b])
                if held.full:
                    yield held.tree(len(weight))
                    held = _Gathered(k)
        if held.terms:
            yield held.tree(len(weight))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(queries, len(weight), floor, k)
        for tree, ids in trees(batches):
            best.look_through(tree, ids)
        for q, (score, id_) in enumerate(best.found):
            if len(score):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(score), q)),
                        pa.array(id_, mask=id_ == _NO_ID),
                        pa.array(score),
                    ],
                    ["query", "id", "score"],
                )

    return search


def _block(docs: DataFrame, items, k: int, per_task: int | None = None) -> DataFrame:
    """``uid, item, id, score``: the best documents for one block of queries, by task."""
    spark = docs.sparkSession
    flat = items["terms"].combine_chunks().flatten().to_numpy()
    vocabulary = np.unique(flat)
    ends = np.concatenate([[0], np.cumsum([len(t) for t in items["terms"].to_pylist()])]).astype(int)
    places = np.searchsorted(vocabulary, flat)
    queries = [places[a:b] for a, b in zip(ends[:-1], ends[1:])]
    stored = cut_lineage(
        docs.mapInArrow(_vectors(vocabulary), "id long, n long, terms array<int>, tf array<int>")
    )
    n, total = stored.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    counts = stored.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    df = np.zeros(len(vocabulary), np.int64)
    df[counts["term"].to_numpy()] = counts["count"].to_numpy()
    weight = weights(df, n)
    found = stored.filter(F.size("terms") > 0)
    schema = "query long, id long, score long"
    floor = np.ones(len(queries), np.int64)
    # The k-th score among some documents is one that the best of all do not go below.
    share = min(1.0, FIRST_LOOK / max(1, n))
    some = found.filter(F.pmod(F.xxhash64("id", "n", "terms"), F.lit(1 << 20)) < int(share * (1 << 20)))
    first = some.mapInArrow(_search(queries, weight, n, total, floor, k), schema)
    worst = first.withColumn(
        "rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
    ).filter(F.col("rank") == k)
    for row in worst.select("query", "score").collect():
        floor[row["query"]] = row["score"]
    names = spark.createDataFrame(
        [(i, u, x) for i, (u, x) in enumerate(zip(items["uid"].to_pylist(), items["id"].to_pylist()))],
        "query long, uid long, item long",
    )
    hits = found.mapInArrow(_search(queries, weight, n, total, floor, k), schema)
    return hits.join(F.broadcast(names), "query").drop("query")


def top_documents(
    df: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    item_col: str = "item_id",
    text_col: str = "text",
    k: int = K,
) -> DataFrame:
    """``item_col, rank, id_col, score`` of the ``k`` documents that score highest for each item.

    A term is a run of ASCII letters and digits and of characters beyond ASCII, A-Z in lower case,
    told apart by a hash of 64 bits. A score sums, over the distinct terms of the item, the term's
    weight times its impact in the document, all whole numbers; see ``weights`` and ``impacts``.
    Scores of zero are left out. Equal scores go to the smaller id, then to rows without one.

    Null and empty texts have no terms: such a document is found by no item and not counted, such
    an item gives no rows. Each row of ``df`` is a document and each row of ``items`` an item,
    rows that repeat an id or have none included. Other columns are not looked at. No documents
    or no items give no rows.

    Items are taken in blocks of ``BLOCK_TERMS`` terms or ``BLOCK_QUERIES`` items, whose terms
    every task holds; each block is one pass over the documents.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    asked = items.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(item_col).cast("long").alias("id"),
        F.col(text_col).alias("text"),
    )
    asked = cut_lineage(asked.mapInArrow(_terms, "uid long, id long, terms array<long>"))
    pairs, n = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0)), F.count(F.lit(1))).first()
    blocks = max(1, -(-pairs // BLOCK_TERMS), -(-n // BLOCK_QUERIES))
    block = F.pmod(F.xxhash64("uid"), F.lit(blocks))
    parts = []
    for b in range(blocks):
        part = asked.filter((block == b) & (F.size("terms") > 0)).toArrow()
        if part.num_rows:
            parts.append(_block(docs, part, k))
    if not parts:
        return df.sparkSession.createDataFrame(
            [], f"{item_col} long, rank int, {id_col} long, score long"
        )
    hits = parts[0]
    for part in parts[1:]:
        hits = hits.unionByName(part)
    order = Window.partitionBy("uid").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return (
        hits.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
    )
