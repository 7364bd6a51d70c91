"""Best-fit packing by a configuration linear program over the histogram of lengths.

A configuration is a set of lengths that fit in one sequence. The program asks for the fewest
configurations that hold every length as often as it occurs; its size depends on the capacity,
not on the corpus. Multiplicative weights solve it: a length that is behind gains weight, and one
knapsack table over the weights prices a good configuration around each length at once. The
solution is rounded to whole sequences without taking more pieces than there are, and what
remains is packed best-fit by decreasing length. Only the histogram reaches the driver, and only
the plan, whose size the capacity bounds, goes back.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnloom.llm.byte_bpe import Vocabulary
from turnloom.llm.words import blocks
from turnloom.operators.scale import cut_lineage

CAPACITY = 2048
END_ID = 0
# Of each length's pieces, the share that one round may take; how a weight falls with each such
# share; what counts as nearly the best price; and the share of the volume left to best fit.
STEP = 0.25
DECAY = 0.95
NEARLY = 0.003
REST = 0.3

# Characters that the library is given at once.
CHAIN = 1 << 14

Configuration = tuple[int, ...]  # lengths, the longest first


# --- the program


def price(weights: np.ndarray, capacity: int) -> np.ndarray:
    """Unbounded knapsack: the most weight that fits in each capacity from 0 up.

    ``weights[l]`` is the weight of length ``l``; 0 for lengths that do not take part.
    """
    best = np.zeros(capacity + 1)
    lengths = np.flatnonzero(weights)
    value = weights[lengths]
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right").tolist()
    for c in range(1, capacity + 1):
        k = upto[c]
        gain = (value[:k] + best[c - lengths[:k]]).max() if k else 0.0
        best[c] = gain if gain > best[c - 1] else best[c - 1]
    return best


def _filled(
    first: int, weights: np.ndarray, best: np.ndarray, open_: np.ndarray
) -> Configuration:
    """``first`` and, in the room beside it, what the table prices highest of ``open_``."""
    chosen, free = [first], len(best) - 1 - first
    while free > 0:
        k = int(np.searchsorted(open_, free, side="right"))
        if not k:
            break
        at = int((weights[open_[:k]] + best[free - open_[:k]]).argmax())
        chosen.append(int(open_[at]))
        free -= chosen[-1]
    return tuple(sorted(chosen, reverse=True))


def fractional(counts: np.ndarray, capacity: int) -> tuple[dict[Configuration, float], float]:
    """Amounts of configurations that hold most of ``counts``, and a lower bound for all of it.

    A length's weight starts as its size (the best price while every sequence can be filled)
    and falls with each share of its pieces that is held. Per round, configurations that are
    worth nearly the best price take up to ``STEP`` of each length, disjointly; rounds end when
    ``REST`` of the volume is left, which goes to best fit with what rounding leaves.
    """
    lengths = np.flatnonzero(counts)
    amounts: dict[Configuration, float] = {}
    volume = float(lengths @ counts[lengths])
    fullest = price(np.where(counts > 0, np.arange(capacity + 1.0), 0.0), capacity)[capacity]
    left, touched = counts.astype(float), np.zeros(capacity + 1)
    bound = 0.0
    while lengths @ left[lengths] > REST * volume:
        weights = np.zeros(capacity + 1)
        weights[lengths] = lengths * DECAY ** touched[lengths]
        # over all lengths: weights and the best price bound the whole program from below
        if not bound:
            bound = float(weights @ counts) / price(weights, capacity)[capacity]
        weights[left <= 0] = 0
        best = price(weights, capacity)
        open_ = np.flatnonzero(left > 0)
        room = np.minimum(left, STEP * counts)
        order = np.argsort(-(weights[open_] + best[capacity - open_]), kind="stable")
        taken = False
        for first in open_[order].tolist():
            while room[first] > 0:
                chosen = _filled(first, weights, best, open_[room[open_] > 0])
                worth = sum(weights[x] for x in chosen)
                if sum(chosen) < fullest or worth < (1 - NEARLY) * best[capacity]:
                    break
                taken = True
                parts = Counter(chosen)
                amount = min(room[p] / k for p, k in parts.items())
                for p, k in parts.items():
                    room[p] -= amount * k
                    left[p] -= amount * k
                    touched[p] += amount * k / counts[p] / STEP
                    for x in (room, left):
                        if x[p] < 1e-9 * counts[p]:
                            x[p] = 0.0
                amounts[chosen] = amounts.get(chosen, 0.0) + amount
        if not taken:
            break
    return amounts, bound


def best_fit(counts: np.ndarray, capacity: int) -> Counter:
    """Whole sequences for ``counts``, best fit by decreasing length, equal steps at once."""
    left = counts.astype(np.int64).copy()
    plan: Counter = Counter()
    while True:
        present = np.flatnonzero(left)
        if not len(present):
            return plan
        chosen, free = [], capacity
        while True:
            at = int(np.searchsorted(present, free, side="right")) - 1
            while at >= 0 and chosen.count(int(present[at])) >= left[present[at]]:
                at -= 1
            if at < 0:
                break
            chosen.append(int(present[at]))
            free -= chosen[-1]
        times = min(left[p] // k for p, k in Counter(chosen).items())
        for p in chosen:
            left[p] -= times
        plan[tuple(chosen)] += int(times)


def rounded(amounts: dict[Configuration, float], counts: np.ndarray, capacity: int) -> Counter:
    """Whole sequences for ``counts``: amounts rounded down, then single ones while pieces last."""
    left = counts.astype(np.int64).copy()
    plan: Counter = Counter()
    rest = []
    for chosen, amount in sorted(amounts.items(), key=lambda x: (-x[1], x[0])):
        parts = Counter(chosen)
        times = min(int(amount), *(int(left[p] // k) for p, k in parts.items()))
        if times:
            plan[chosen] += times
            for p, k in parts.items():
                left[p] -= times * k
        rest.append((amount - int(amount), sum(chosen), chosen))
    # the fullest first; a fraction of one sequence at a time
    for _, _, chosen in sorted(rest, key=lambda x: (-x[1], -x[0], x[2])):
        parts = Counter(chosen)
        if all(left[p] >= k for p, k in parts.items()):
            plan[chosen] += 1
            for p, k in parts.items():
                left[p] -= k
    plan.update(best_fit(left, capacity))
    return plan


def solve(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[Counter, float]:
    """How often each configuration is used to hold the histogram, and a lower bound.

    Where best fit alone needs fewer sequences than the rounded program, its plan counts.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    full, counts[capacity] = int(counts[capacity]), 0
    amounts, bound = fractional(counts, capacity)
    plan = min(rounded(amounts, counts, capacity), best_fit(counts, capacity), key=Counter.total)
    if full:
        plan[(capacity,)] += full
    return plan, bound + full


def slots(plan: Counter) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the ``r``-th piece of a length goes.

    Sorted keys ``length << 40 | r`` from which a run of pieces begins, the sequence of the
    first of the run (the next go to the next sequences) and the offset in it.
    """
    runs: list[tuple[int, int, int]] = []
    placed: Counter = Counter()
    sequence = 0
    for chosen, times in sorted(plan.items(), reverse=True):
        offset = 0
        for length in chosen:
            runs.append((length << 40 | placed[length], sequence, offset))
            placed[length] += times
            offset += length
        sequence += times
    runs.sort()
    keys, sequences, offsets = zip(*runs) if runs else ((), (), ())
    return tuple(np.array(x, np.int64) for x in (keys, sequences, offsets))


# --- the pieces


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Starts and lengths of the pieces of ``n`` tokens; only the first may be shorter."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


class IdBytes(Vocabulary):
    """Ids as unsigned 32-bit numbers (little-endian, as all machines Spark runs on)."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        # of a byte-level token each character stands for one byte
        self.sizes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, number in vocabulary.items():
            self.sizes[number] = len(token)

    def resolve(self, pieces: list[str]) -> list[bytes]:
        """Pieces go to the library as chains of many: the call costs more than the merges."""
        out = [b""] * len(pieces)
        own = [i for i, p in enumerate(pieces) if _chains(p)]
        rest = [i for i, p in enumerate(pieces) if not _chains(p)]
        for a, b in blocks((len(pieces[i]) for i in own), CHAIN):
            chain = [pieces[i] for i in own[a:b]]
            found = self._parted("".join(chain), [len(p.encode()) for p in chain])
            if found is None:
                rest += own[a:b]
            else:
                for i, ids in zip(own[a:b], found):
                    out[i] = ids
        for i, ids in zip(rest, self.encode([pieces[i] for i in rest])):
            out[i] = self.value(ids)
        return out

    def _parted(self, text: str, sizes: list[int]) -> list[bytes] | None:
        """The ids of each part of ``text``; None where a token lies across two."""
        ids = np.array(self.encode([text])[0], np.uint32)
        upto, stops = np.cumsum(self.sizes[ids]), np.cumsum(sizes)
        cuts = np.searchsorted(upto, stops)
        if cuts[-1] >= len(upto) or (upto[cuts] != stops).any():
            return None
        raw, ends = ids.tobytes(), (4 * (cuts + 1)).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def value(self, ids: list[int]) -> bytes:
        return array("I", ids).tobytes()


def _chains(piece: str) -> bool:
    """Whether there is a cut before the piece wherever a word goes before it."""
    return len(piece) > 1 and piece[0] in " \n" and not (piece[1].isspace() or piece[-1].isspace())


@lru_cache(maxsize=4)
def encoder(path: str) -> IdBytes:
    """One per worker, which keeps it between tasks."""
    return IdBytes(path)


def _pieces(path: str, capacity: int):
    schema = pa.schema(
        [
            ("id", pa.int64()),
            ("piece", pa.int32()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("ids_crc32", pa.int64()),
            ("part", pa.int32()),
            ("place", pa.int64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = END_ID.to_bytes(4, "little")
        words = encoder(path)
        seen: Counter = Counter()
        part = TaskContext.get().partitionId()
        for batch in batches:
            rows: list[list] = [[] for _ in schema]
            texts = batch.column(1).to_pylist()
            for key, found in zip(batch.column(0).to_pylist(), words.values(texts)):
                ids = b"".join(found) + end
                view = memoryview(ids)
                for i, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    crc = zlib.crc32(view[4 * start : 4 * (start + length)])
                    row = (key, i, start, length, crc, part, seen[length])
                    seen[length] += 1
                    for column, value in zip(rows, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema
            )

    return run


def pack(
    df: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id and offset.

    A document is its ids and one end id; a null or empty text is the end id alone. Only what is
    longer than ``capacity`` is cut. Rows with a null id and repeated rows are packed as any
    other. Other columns are ignored. An empty table gives no rows.
    """
    schema = "id long, piece int, start long, length long, ids_crc32 long, part int, place long"
    pieces = cut_lineage(
        df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
            _pieces(path, capacity), schema
        )
    )
    # the rank of a piece among those of its length: how many in earlier parts, and its place
    counted = cut_lineage(
        pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    )
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select(
        "part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    histogram = {
        r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }  # at most one row per length
    plan, _ = solve(histogram, capacity)
    table = df.sparkSession.sparkContext.broadcast(slots(plan))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sequences, starts = table.value
        for batch in batches:
            key = batch["length"].to_numpy() << 40 | batch["rank"].to_numpy()
            at = np.searchsorted(keys, key, side="right") - 1
            columns = [batch[c] for c in ("id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequences[at] + key - keys[at]), pa.array(starts[at])],
                names=[*"id piece start length ids_crc32 sequence_id offset".split()],
            )

    ranked = pieces.join(offsets, ["part", "length"]).select(
        "id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place")).alias("rank")
    )
    return ranked.mapInArrow(
        place,
        "id long, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    ).withColumnRenamed("id", id_col)
