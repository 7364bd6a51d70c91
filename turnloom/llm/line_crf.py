"""Quality by labelling lines: a linear-chain conditional random field marks each line as content
or boilerplate, and the share of words in content lines decides whether a document is kept.

Lines are described by yes-or-no features of their bytes and words, one bit each. The field has a
weight per label and feature and one per pair of neighbouring labels; it is trained by gradient on
a bounded sample of labelled documents, whose lines take the document's label, and decoded with
the Viterbi algorithm, all documents of a block in step.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.llm.words import _is_white, as_bytes, hashes, split, text_blocks

# The sample of labelled documents for training: a bound, not a share.
TRAIN_DOCUMENTS = 3000
CONTENT_SHARE = 0.5
MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
ROUNDS = 60
SYMBOLS = b"#*$%&|<>"

_kinds = np.zeros((6, 256), bool)
_kinds[0][list(SYMBOLS)] = True
_kinds[1][[c for c in range(128) if chr(c).isupper()]] = True
_kinds[2][[c for c in range(128) if chr(c).islower()] + list(range(0xC0, 256))] = True
_kinds[3][[c for c in range(128) if chr(c).isdigit()]] = True
_kinds[4][list(b"!?")] = True
_kinds[5] = ~_is_white
# the first byte of a character
_begins = np.ones(256, bool)
_begins[0x80:0xC0] = False


class Lines(NamedTuple):
    """Lines with a word, of a block of texts."""

    features: np.ndarray  # one bit per feature
    words: np.ndarray  # number of words
    first: np.ndarray  # first[d]: the first line of text d


class Counts(NamedTuple):
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray


FEATURES = 40


def _bins(value: np.ndarray, edges: tuple[float, ...]) -> np.ndarray:
    """One bit, of ``len(edges) + 1``: which bin the value is in."""
    return np.uint64(1) << np.searchsorted(np.array(edges), value, side="right").astype(np.uint64)


def _sums(values: np.ndarray, begins: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``values`` from each place of ``begins`` to the next."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return np.diff(np.append(total[begins], total[n]))


def describe(texts: list[bytes | None]) -> tuple[Lines, Counts]:
    """The lines and counts of a block of texts."""
    parts = [t or b"" for t in texts]
    raw = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    ends = np.cumsum([len(p) + 1 for p in parts], dtype=np.int64)
    breaks = np.flatnonzero(raw == 10)
    begins = np.concatenate([[0], breaks[:-1] + 1])
    kinds = [_sums(k[raw], begins, len(raw)) for k in _kinds]
    white = _is_white[raw]
    opens = ~white
    opens[1:] &= white[:-1]
    n_words = _sums(opens, begins, len(raw))
    chars = _sums(_begins[raw] & ~white, begins, len(raw))
    of_text = np.searchsorted(ends, begins, side="right")
    texts_n = len(parts)
    per_text = lambda x: np.bincount(of_text, x, texts_n).astype(np.int64)

    # equal lines of one text
    lengths = breaks - begins
    dup = np.zeros(len(begins), bool)
    seen: set = set()
    whole = raw.tobytes()
    filled = np.flatnonzero(n_words)
    last = -1
    for i, d, a, b in zip(filled.tolist(), of_text[filled].tolist(), begins[filled].tolist(), breaks[filled].tolist()):
        if d != last:
            seen, last = set(), d
        line = whole[a:b]
        if line in seen:
            dup[i] = True
        seen.add(line)

    words = split(texts)
    counts = Counts(
        words.counts.astype(np.int64),
        per_text(chars),
        per_text(kinds[0]),
        per_text(dup),
        repeat_words(words, REPEAT_WINDOW),
    )

    keep = filled
    letters = np.maximum(1, kinds[1] + kinds[2])[keep]
    marks = np.maximum(1, kinds[5])[keep]
    n = n_words[keep]
    final = raw[np.maximum(begins, breaks - 1)][keep]
    first = np.searchsorted(of_text[keep], np.arange(texts_n + 1))
    place = np.arange(len(keep)) - first[of_text[keep]]
    groups = [
        _bins(n, (2, 4, 8, 16, 32)),
        _bins(kinds[0][keep] / n, (0.01, 0.2, 0.8, 2)),
        _bins(kinds[1][keep] / letters, (0.01, 0.1, 0.3, 0.6)),
        _bins(kinds[3][keep] / marks, (0.01, 0.1, 0.3)),
        _bins(kinds[4][keep] / n, (0.01, 0.3, 0.9)),
        _bins(chars[keep] / n, (2.5, 4, 6, 9)),
        _bins(dup[keep], (0.5,)),
        _bins(np.isin(final, list(b".!?\"'")), (0.5,)),
        _bins(place, (1,)),
        _bins(lengths[keep], (40, 400)),
    ]
    sizes = (6, 5, 5, 4, 4, 5, 2, 2, 2, 3)
    bits, shift = np.zeros(len(keep), np.uint64), 0
    for group, size in zip(groups, sizes):
        bits |= group << np.uint64(shift)
        shift += size
    return Lines(bits, n, first), counts


def repeat_words(words, window: int) -> np.ndarray:
    """Per text, the words in windows that the text holds twice or more, the first included.

    Exact: ranks of words, then of pairs, fours and so on, each the rank of a pair of ranks.
    """
    texts_n = len(words.first) - 1
    n = len(words.starts)
    out = np.zeros(texts_n, np.int64)
    if n < window:
        return out
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    # words of a text that occur once in it start no repeated window: most texts end here
    of_text = words.of_text
    rank = _word_ranks(words, of_text)
    size = 1
    while size < window:
        pair = rank[:-size].astype(np.uint64) << np.uint64(32) | rank[size:].astype(np.uint64)
        rank = np.unique(pair, return_inverse=True)[1].astype(np.uint32)
        size *= 2
    inside = of_text[: len(rank)] == of_text[window - 1 :]
    at = np.flatnonzero(inside)
    key = of_text[at].astype(np.uint64) << np.uint64(32) | rank[at].astype(np.uint64)
    _, back, times = np.unique(key, return_inverse=True, return_counts=True)
    begins = at[times[back] > 1]
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, begins, 1)
    np.add.at(depth, begins + window, -1)
    covered = np.cumsum(depth)[:n] > 0
    return np.bincount(of_text[covered], minlength=texts_n).astype(np.int64)


def _word_ranks(words, of_text: np.ndarray) -> np.ndarray:
    """A number per word, the same for equal words only."""
    value, rank = np.unique(hashes(words), return_inverse=True)
    first = np.full(len(value), len(rank), np.int64)
    np.minimum.at(first, rank, np.arange(len(rank)))
    # equal hashes of unequal words would show in their lengths or bytes
    lengths = words.ends - words.starts
    if (lengths != lengths[first[rank]]).any():
        seen: dict[bytes, int] = {}
        return np.array(
            [seen.setdefault(words.text[a:b], len(seen)) for a, b in zip(words.starts, words.ends)],
            np.uint32,
        )
    return rank.astype(np.uint32)


# --- the field


class Field(NamedTuple):
    """Weights for label 1 (content) against label 0, and of label changes."""

    weights: np.ndarray
    bias: float
    stay: np.ndarray  # stay[a, b]: weight of label b behind label a


def _matrix(features: np.ndarray) -> np.ndarray:
    return ((features[:, None] >> np.arange(FEATURES, dtype=np.uint64)) & np.uint64(1)).astype(
        np.float64
    )


def _steps(first: np.ndarray):
    """Lines in step: texts by falling number of lines, and for each step its lines."""
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    longest = int(counts.max(initial=0))
    active = np.searchsorted(-counts[order], -np.arange(1, longest + 1), side="right")
    return order, active


def train(lines: np.ndarray, first: np.ndarray, label: np.ndarray, rounds: int = ROUNDS) -> Field:
    """The field that makes the labels of the documents' lines most likely (with a small penalty).

    ``lines``: feature bits, ``first[d]``: the first line of document ``d``, ``label[d]``: 0 or 1.
    """
    x = _matrix(lines)
    gold = np.repeat(label, np.diff(first)).astype(np.int64)
    order, active = _steps(first)
    w, bias, stay = np.zeros(FEATURES), 0.0, np.zeros((2, 2))
    size = max(1, len(lines))
    # documents, not lines, are what is judged: each weighs the same
    weight = np.repeat(1 / np.maximum(1, np.diff(first)), np.diff(first))
    total = max(1, len(first) - 1)
    memory = [np.zeros(FEATURES + 5), np.zeros(FEATURES + 5)]
    for turn in range(1, rounds + 1):
        score = x @ w + bias
        node, pair = _marginals(score, stay, first, order, active, weight)
        off = weight * (gold - node)
        inner = np.flatnonzero(np.diff(np.repeat(np.arange(len(first) - 1), np.diff(first))) == 0)
        truth = np.zeros((2, 2))
        np.add.at(truth, (gold[inner], gold[inner + 1]), weight[inner + 1])
        grad = np.concatenate([x.T @ off, [off.sum()], (truth - pair).ravel()]) / total
        grad -= 1e-3 * np.concatenate([w, [bias], stay.ravel()])
        memory[0] = 0.9 * memory[0] + 0.1 * grad
        memory[1] = 0.99 * memory[1] + 0.01 * grad * grad
        step = 0.2 * (memory[0] / (1 - 0.9**turn))
        step /= np.sqrt(memory[1] / (1 - 0.99**turn)) + 1e-8
        w, bias = w + step[:FEATURES], bias + step[FEATURES]
        stay = stay + step[FEATURES + 1 :].reshape(2, 2)
    del size
    return Field(w, float(bias), stay)


def _marginals(score, stay, first, order, active, weight):
    """P(label 1) of each line, and weighted expected pairs of neighbouring labels."""
    n = len(score)
    forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
    begin, counts = first[:-1][order], np.diff(first)[order]
    edge = np.exp(stay)
    local = np.exp(np.stack([np.zeros(n), score], axis=1) - np.maximum(0, score)[:, None])
    for t, k in enumerate(active):
        at = begin[:k] + t
        now = local[at] if t == 0 else local[at] * (forward[at - 1] @ edge)
        forward[at] = now / now.sum(axis=1, keepdims=True)
    for t in range(len(active) - 1, -1, -1):
        at = begin[: active[t]] + t
        now = np.ones((len(at), 2))
        more = counts[: active[t]] > t + 1
        follow = at[more] + 1
        now[more] = (local[follow] * backward[follow]) @ edge.T
        backward[at] = now / now.sum(axis=1, keepdims=True)
    node = forward * backward
    node /= node.sum(axis=1, keepdims=True)
    pair = np.zeros((2, 2))
    for t in range(1, len(active)):
        at = begin[: active[t]] + t
        joint = forward[at - 1][:, :, None] * edge * (local[at] * backward[at])[:, None, :]
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        pair += (joint * weight[at][:, None, None]).sum(axis=0)
    return node[:, 1], pair


def decode(field: Field, lines: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The most likely labels of all lines (Viterbi)."""
    score = _matrix(lines) @ field.weights + field.bias
    order, active = _steps(first)
    begin, counts = first[:-1][order], np.diff(first)[order]
    n = len(lines)
    best, from_ = np.zeros((n, 2)), np.zeros((n, 2), np.int8)
    local = np.stack([np.zeros(n), score], axis=1)
    for t, k in enumerate(active):
        at = begin[:k] + t
        if t == 0:
            best[at] = local[at]
            continue
        way = best[at - 1][:, :, None] + field.stay
        from_[at] = way.argmax(axis=1)
        best[at] = way.max(axis=1) + local[at]
    label = np.zeros(n, np.int8)
    for t in range(len(active) - 1, -1, -1):
        k = active[t]
        at = begin[:k] + t
        ends = counts[:k] == t + 1
        label[at[ends]] = best[at[ends]].argmax(axis=1)
        inner = at[~ends]
        label[inner] = from_[inner + 1, label[inner + 1]]
    return label


# --- Spark


def sample_lines(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    limit: int = TRAIN_DOCUMENTS,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature bits, document bounds and labels of at most ``limit`` labelled documents.

    Those with the smallest hash of their id; the same at every size of cluster.
    """
    chosen = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .filter("id is not null and label in (0, 1)")
        .groupBy("id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(limit)
    )

    @F.arrow_udf("binary")
    def bits(column: pa.Array) -> pa.Array:
        texts, out = as_bytes(column), []
        for lo, hi in text_blocks(texts):
            lines, _ = describe(texts[lo:hi])
            out.extend(
                lines.features[a:b].tobytes() for a, b in zip(lines.first, lines.first[1:])
            )
        return pa.array(out, pa.binary())

    rows = (
        documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(F.broadcast(chosen), "id")  # at most ``limit`` rows
        .select("id", "label", bits("text").alias("bits"))
        .orderBy("id", "bits")
        .limit(2 * limit)  # repeated ids
        .collect()
    )
    found = [np.frombuffer(r["bits"], np.uint64) for r in rows]
    first = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int64)
    lines = np.concatenate([np.zeros(0, np.uint64), *found])
    return lines, first, np.array([r["label"] for r in rows], np.int64)


def fit(documents: DataFrame, labels: DataFrame, **names) -> Field:
    """Train on labelled documents; without any, a field for which every line is content."""
    lines, first, label = sample_lines(documents, labels, **names)
    if not len(label) or not len(lines) or label.min() == label.max():
        only = 1.0 if not len(label) or label.max() == 1 else -1.0
        return Field(np.zeros(FEATURES), only, np.zeros((2, 2)))
    return train(lines, first, label)


RULES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "content_share double, base_failed boolean, kept boolean"
)


def judge(field: Field, text: str | Column = "text") -> Column:
    """A struct of counts and the verdict on a text column.

    ``content_share`` is the share of words in lines marked as content, null without words. A
    null or empty text has no words and fails the base rules; so does a text of fewer than
    ``MIN_WORDS`` words or with over ``MAX_REPEAT_PERCENT`` percent of them in repeated windows.
    """

    def verdicts(column: pa.Array) -> pa.Array:
        texts = as_bytes(column)
        parts = []
        for lo, hi in text_blocks(texts):
            lines, counts = describe(texts[lo:hi])
            label = decode(field, lines.features, lines.first)
            total = np.concatenate([[0], np.cumsum(lines.words * label)])
            content = total[lines.first[1:]] - total[lines.first[:-1]]
            n = counts.n_words
            share = np.where(n > 0, content / np.maximum(1, n), np.nan)
            failed = (n < MIN_WORDS) | (100 * counts.n_repeat_words > MAX_REPEAT_PERCENT * n)
            kept = ~failed & (share >= CONTENT_SHARE)
            arrays = [*(pa.array(c, pa.int64()) for c in counts)]
            arrays.append(pa.array(share, pa.float64(), mask=n == 0))
            arrays += [pa.array(failed), pa.array(kept)]
            names = [x.split()[0] for x in RULES.split(", ")]
            parts.append(pa.StructArray.from_arrays(arrays, names=names))
        if parts:
            return pa.concat_arrays(parts)
        return pa.array([], pa.struct([(x.split()[0], pa.int64()) for x in RULES.split(", ")]))

    return F.arrow_udf(verdicts, RULES)(F.col(text) if isinstance(text, str) else text)
