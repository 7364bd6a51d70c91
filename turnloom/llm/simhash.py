"""SimHash near-duplicates over a Gray-order hierarchical index.

Of ``d + 1`` blocks of bits, words that differ in at most ``d`` bits agree on one, so each
distinct fingerprint goes to ``d + 1`` buckets (more and smaller ones when there are very many,
see ``bucket_masks``). A bucket sorts its fingerprints by
Gray rank, where neighbours share most bits, and builds a tree over them: a node holds the bits
that all below it share (pattern and mask). A search walks the tree from the root, adds up the
differences on the bits that each node newly fixes, and leaves a whole group as soon as the sum
passes ``d``; it also leaves a group that is already connected to the searcher. A bucket returns
one link per fingerprint that has a neighbour, never all pairs, and rounds of large-star and
small-star joins make components of the links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnloom.llm.words import as_bytes, split, text_blocks
from turnloom.operators.scale import cut_lineage, lookup_join

SHINGLE = 3
MAX_BITS = 3
SEED = 42
# Fingerprints of one bucket that a task takes together; a larger bucket goes to tasks in pairs
# of parts, so that any two of its fingerprints still meet.
BUCKET_ROWS = 1 << 16
# More random fingerprints than these in a bucket call for more bits in its key.
RANDOM_ROWS = 256
_FAN = 8
_SLICE = 2048


# --- fingerprints


def fingerprints(texts: list[bytes | None], shingle: int = SHINGLE) -> np.ndarray:
    """The 64-bit fingerprint of each text; 0 for one without words."""
    out = np.zeros(len(texts), np.uint64)
    for lo, hi in text_blocks(texts):
        words = split([(t or b"").lower() for t in texts[lo:hi]])
        counts = words.counts
        n = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
        owner = np.repeat(np.arange(hi - lo), n)
        bounds = np.concatenate([[0], np.cumsum(n)])
        begin = words.first[owner] + np.arange(len(owner)) - bounds[owner]
        end = np.minimum(begin + shingle, words.first[owner + 1]) - 1
        text, digest = words.text, xxhash.xxh64_intdigest
        values = np.fromiter(
            (
                digest(text[s:e], SEED)
                for s, e in zip(words.starts[begin].tolist(), words.ends[end].tolist())
            ),
            np.uint64,
            len(begin),
        )
        filled = np.flatnonzero(n)
        if len(filled):
            ones = _bit_counts(values, bounds[:-1][filled])
            bits = 2 * ones > n[filled][:, None]
            out[lo + filled] = np.packbits(bits, axis=1).view(">u8").ravel()
    return out


# For each byte a word of eight lanes, one per bit (the highest bit in the first byte).
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()


def _bit_counts(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """How many values of each group have each bit, the highest bit first."""
    sizes = np.diff(np.append(begins, len(values)))
    runs = -(-sizes // 255)  # a lane holds counts up to 255
    first = np.concatenate([[0], np.cumsum(runs)[:-1]])
    inside = np.arange(int(runs.sum())) - np.repeat(first, runs)
    at = np.repeat(begins, runs) + 255 * inside
    octets = values.astype(">u8").view(np.uint8).reshape(-1, 8)
    lanes = np.stack(
        [np.add.reduceat(_LANES[octets[:, i]], at) for i in range(8)], axis=1
    )
    counts = lanes.view(np.uint8).reshape(len(at), 64).astype(np.int64)
    return np.add.reduceat(counts, first, axis=0)


def with_fingerprint(
    df: DataFrame, text: str = "text", name: str = "fingerprint", shingle: int = SHINGLE
) -> DataFrame:
    """``df`` and the fingerprint of ``text`` as a long (the same 64 bits, signed)."""

    @F.arrow_udf("long")
    def fingerprint(column: pa.Array) -> pa.Array:
        return pa.array(fingerprints(as_bytes(column), shingle).view(np.int64))

    return df.withColumn(name, fingerprint(F.col(text)))


def as_hex(fingerprint: str) -> F.Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


# --- the index


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each 64-bit word in the reflected Gray order."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


class GrayIndex:
    """The tree over one bucket. ``levels[0]`` are the fingerprints in Gray order; a node of a
    higher level covers ``_FAN`` consecutive nodes of the level below."""

    def __init__(self, values: np.ndarray) -> None:
        values = np.unique(values)
        self.values = values[np.argsort(gray_rank(values), kind="stable")]
        full = np.full(len(self.values), ~np.uint64(0))
        self.levels = [(self.values, full)]
        while len(self.levels[-1][0]) > 1:
            pattern, mask = self.levels[-1]
            at = np.arange(0, len(pattern), _FAN)
            low, high = np.bitwise_and.reduceat(pattern, at), np.bitwise_or.reduceat(pattern, at)
            shared = np.bitwise_and.reduceat(mask, at) & ~(low ^ high)
            self.levels.append((low & shared, shared))

    def _group(self, labels: np.ndarray) -> list[np.ndarray]:
        """Per level and node: the one component that all below are in, or -1."""
        out = [labels]
        while len(out[-1]) > 1:
            at = np.arange(0, len(out[-1]), _FAN)
            low, high = np.minimum.reduceat(out[-1], at), np.maximum.reduceat(out[-1], at)
            out.append(np.where(low == high, low, -1))
        return out

    def _search(self, rows: np.ndarray, labels: np.ndarray, groups, d: int):
        """Links from ``rows`` to fingerprints of other components, within ``d`` bits."""
        query, node = rows, np.zeros(len(rows), np.int64)
        pattern, mask = self.levels[-1]
        spent = np.bitwise_count((self.values[query] ^ pattern[node]) & mask[node])
        keep = (spent <= d) & (groups[-1][node] != labels[query])
        query, node, spent = query[keep], node[keep], spent[keep]
        for level in range(len(self.levels) - 2, -1, -1):
            pattern, mask = self.levels[level]
            above = self.levels[level + 1][1]
            child = (node[:, None] * _FAN + np.arange(_FAN)).ravel()
            query, node, spent = (np.repeat(x, _FAN) for x in (query, node, spent))
            inside = child < len(pattern)
            query, parent, spent, child = query[inside], node[inside], spent[inside], child[inside]
            fresh = mask[child] & ~above[parent]
            spent = spent + np.bitwise_count((self.values[query] ^ pattern[child]) & fresh)
            keep = (spent <= d) & (groups[level][child] != labels[query])
            query, node, spent = query[keep], child[keep], spent[keep]
        return query, node

    def components(self, d: int) -> np.ndarray:
        """For each value, in Gray order, the place of the first of its component."""
        n = len(self.values)
        labels = np.arange(n)
        for gap in range(1, min(_FAN, n)):
            near = np.bitwise_count(self.values[gap:] ^ self.values[:-gap]) <= d
            at = np.flatnonzero(near)
            labels = connect(labels, at, at + gap)
        # A part that many links join is met again and again: short slices first.
        lo, step = 0, 64
        while lo < n:
            rows = np.arange(lo, min(n, lo + step))
            a, b = self._search(rows, labels, self._group(labels), d)
            labels = connect(labels, a, b)
            lo, step = lo + step, min(_SLICE, 2 * step)
        return labels


def connect(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join components: ``labels[x]`` is the smallest place of x's component."""
    while len(a):
        p, q = labels[a], labels[b]
        apart = p != q
        if not apart.any():
            break
        a, b, p, q = a[apart], b[apart], p[apart], q[apart]
        low, high = np.minimum(p, q), np.maximum(p, q)
        root = np.arange(len(labels))
        np.minimum.at(root, high, low)
        while True:
            higher = root[root]
            if (higher == root).all():
                break
            root = higher
        labels = root[labels]
    return labels


def _bucket_links(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    """Links from each fingerprint to the first of its component in its bucket."""
    held = list(batches)
    if not held:
        return
    table = pa.Table.from_batches(held)
    bucket, fp = (table[c].to_numpy() for c in ("bucket", "fp"))
    order = np.argsort(bucket, kind="stable")
    bucket, fp = bucket[order], fp[order].view(np.uint64)
    edges = np.flatnonzero(np.diff(bucket)) + 1
    starts = np.concatenate([[0], edges])
    sizes = np.diff(np.concatenate([starts, [len(bucket)]]))
    for start, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        values = fp[start : start + size]
        if size == 2:
            if 0 < np.bitwise_count(values[0] ^ values[1]) <= d:
                yield _links(values[:1], values[1:])
            continue
        index = GrayIndex(values)
        root = index.components(d)
        linked = np.flatnonzero(root != np.arange(len(root)))
        if len(linked):
            yield _links(index.values[linked], index.values[root[linked]])


def _links(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
    )


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 1 << 16):
    """Few large batches instead of many small ones."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def bucket_masks(rows: int, max_bits: int = MAX_BITS) -> list[int]:
    """Sets of bits such that any two words within ``max_bits`` agree on all bits of one set.

    Of ``m`` blocks of bits, ``max_bits`` can hold all differences; the sets are the choices of
    the others. ``m`` is the least for which even buckets of ``rows`` random words stay small.
    """
    for m in range(max_bits + 1, max_bits + 4):
        cuts = [64 * i // m for i in range(m + 1)]
        whole = [((1 << hi) - (1 << lo)) for lo, hi in zip(cuts, cuts[1:])]
        masks = [sum(chosen) for chosen in combinations(whole, m - max_bits)]
        if rows >> min(x.bit_count() for x in masks) < RANDOM_ROWS:
            break
    return masks


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``(a, b)`` that connect what is within ``max_bits``, from distinct ``fp`` longs.

    Not every pair: per bucket a link from each fingerprint to the first of its component.
    """
    if not 0 <= max_bits < 16:
        raise ValueError("max_bits must be from 0 to 15")
    masks = bucket_masks(fps.count(), max_bits)
    signed = [x - (1 << 64) if x >> 63 else x for x in masks]
    keys = [
        F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(x))) for i, x in enumerate(signed)
    ]
    rows = fps.select("fp", F.explode(F.array(*keys)).alias("key"))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BUCKET_ROWS)
    parts = sizes.select("key", F.ceil(F.col("n") / BUCKET_ROWS).cast("int").alias("parts"))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    bucketed = (
        lookup_join(rows, parts, "key")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64("fp"), "parts").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(F.xxhash64("key", low, high).alias("bucket"), "fp")
    )

    def search(batches):
        return _gathered(_bucket_links(batches, max_bits))

    return bucketed.repartition("bucket").mapInArrow(search, "a long, b long")


# --- components


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of ``edges(a, b)``; ``root`` is the smallest reachable.

    Large-star joins every larger neighbour to the smallest one, small-star every smaller one;
    in turn they reach stars in about as many rounds as the diameter has binary digits.
    """
    current = cut_lineage(
        edges.filter("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before = None
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            lookup_join(both, least, "a", "inner")
            .filter("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            lookup_join(large, least, "a", "inner")
            .select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
            .select(F.col("e.a"), F.col("e.m").alias("b"))
            .filter("a != b")
            .distinct()
        )
        current = cut_lineage(small)
        state = tuple(
            current.agg(
                F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
            ).first()
        )
        if state == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per row of ``df``: its id, ``fp`` (long) and ``component_id``.

    ``component_id`` is the smallest id that links of at most ``max_bits`` differing bits reach,
    the row's own included. A null or empty text has fingerprint 0 and is linked as any other;
    a null id is passed over when the smallest is taken, so the result is null only if all ids
    reached are. Repeated rows stay, each with the same component. Other columns are ignored.
    """
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    docs = cut_lineage(with_fingerprint(docs, "text", "fp", shingle).select("id", "fp"))
    distinct = docs.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(distinct.select("fp"), max_bits))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = lookup_join(rooted.select("fp", "root"), named, "root", "inner").select(
        "fp", "component_id"
    )
    return lookup_join(docs, by_fp, "fp", "inner").select(
        F.col("id").alias(id_col), "fp", "component_id"
    )


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` of which one document stays per group of near-duplicates.

    The document with the smallest id stays. Rows that share an id are one document: of those
    that stay, the one whose text has the smallest hash is kept. A row without an id names no
    document and stays.
    """
    found = near_duplicates(df.filter(F.col(id_col).isNotNull()), id_col, text_col)
    stays = found.filter(F.col(id_col) == F.col("component_id")).select(id_col).distinct()
    held = df.filter(F.col(id_col).isNotNull()).join(stays, id_col, "left_semi")
    place = "_place_in_document"
    order = Window.partitionBy(id_col).orderBy(F.xxhash64(text_col))
    one = held.withColumn(place, F.row_number().over(order)).filter(F.col(place) == 1).drop(place)
    return one.unionByName(df.filter(F.col(id_col).isNull()))
