"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other. Each is a logistic regression on the words of a text
and on the probabilities that the links before it gave. For training these probabilities come from
models that did not see the document (out of fold), as they will be when the chain is used.

A text is the set of its words and word beginnings, without case and marks, as numbers of
``BITS`` bits. Per category
the words that differ most between its documents and the others become features.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.llm.words import as_bytes, mix, prefix_hashes, split, text_blocks

# The sample of labelled documents for training: a bound, not a share.
TRAIN_DOCUMENTS = 4000
BITS = 22
# Bytes of word beginnings that are features too: a word is often met in other forms.
PREFIXES = (4, 5, 6, 7)
FOLDS = 5
FEATURES = 200
# A word counts for a category when enough of its documents have it (not just copies of a few)
# and the difference is beyond chance.
MIN_SHARE = 0.03
MIN_DOCUMENTS = 4
MIN_Z = 6
PENALTY = 0.02
THRESHOLD = 0.5


class Link(NamedTuple):
    """One category: its features, their weights, those of earlier probabilities, the constant."""

    words: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    bias: float


def word_numbers(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """``(text, number)`` of all words and word beginnings of a block of texts, once each."""
    words = split([(t or b"").lower() for t in texts], marks=True)
    word, value = prefix_hashes(words, PREFIXES)
    number = (mix(value) >> np.uint64(64 - BITS)).astype(np.int64)
    return words.of_text[word] if len(word) else word, number


# --- training


def _chosen(doc: np.ndarray, word: np.ndarray, label: np.ndarray) -> np.ndarray:
    """The words whose document frequency differs most between the two classes."""
    size = int(word.max(initial=0)) + 1
    positive, negative = label.sum(), len(label) - label.sum()
    with_word = np.bincount(word, minlength=size)
    in_positive = np.bincount(word, label[doc], size)
    rate = with_word / len(label)
    spread = np.sqrt(rate * (1 - rate) * (1 / max(1, positive) + 1 / max(1, negative)))
    gap = in_positive / max(1, positive) - (with_word - in_positive) / max(1, negative)
    z = np.abs(gap) / np.maximum(spread, 1e-12)
    common = np.maximum(in_positive / max(1, positive), (with_word - in_positive) / max(1, negative))
    z[common < MIN_SHARE] = 0
    best = np.argsort(-z, kind="stable")[:FEATURES]
    return np.sort(best[z[best] >= MIN_Z])


def _design(doc, word, n: int, chosen: np.ndarray) -> np.ndarray:
    """Rows of 0 and 1: which of the chosen words a document has."""
    x = np.zeros((n, len(chosen)))
    at = np.searchsorted(chosen, word)
    at[at == len(chosen)] = 0
    hit = chosen[at] == word if len(chosen) else np.zeros(len(word), bool)
    x[doc[hit], at[hit]] = 1
    return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Weights, the constant last: Newton's method with a ridge."""
    x = np.column_stack([x, np.ones(len(x))])
    ridge = np.full(x.shape[1], penalty * len(y) / 100)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = _sigmoid(x @ w)
        gradient = x.T @ (y - p) - ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9)
        step = np.linalg.solve(curve, gradient)
        w = w + step * min(1.0, 5 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def _fit_link(doc, word, rows: np.ndarray, earlier: np.ndarray, y: np.ndarray) -> Link:
    """A link fitted on the documents ``rows``."""
    number = np.full(len(y), -1)
    number[rows] = np.arange(len(rows))
    inside = number[doc] >= 0
    own_doc, own_word, own_y = number[doc[inside]], word[inside], y[rows]
    chosen = _chosen(own_doc, own_word, own_y)
    x = _design(own_doc, own_word, len(rows), chosen)
    w = logistic(np.column_stack([x, earlier[rows]]), own_y)
    k = len(chosen)
    return Link(chosen, w[:k], w[k:-1], float(w[-1]))


def _predict(link: Link, doc, word, n: int, earlier: np.ndarray) -> np.ndarray:
    return _sigmoid(_design(doc, word, n, link.words) @ link.weights + earlier @ link.earlier + link.bias)


def train(doc, word, labels: np.ndarray, fold: np.ndarray) -> list[Link]:
    """The chain for the columns of ``labels``, in their order."""
    n = len(labels)
    earlier = np.zeros((n, 0))
    chain = []
    for column in range(labels.shape[1]):
        y = labels[:, column].astype(float)
        unseen = np.zeros(n)
        for f in range(FOLDS):
            rows, rest = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            if not len(rest):
                continue
            link = _fit_link(doc, word, rows, earlier, y) if len(rows) else None
            held = np.full(n, -1)
            held[rest] = np.arange(len(rest))
            inside = held[doc] >= 0
            unseen[rest] = (
                _predict(link, held[doc[inside]], word[inside], len(rest), earlier[rest])
                if link
                else y.mean()
            )
        chain.append(_fit_link(doc, word, np.arange(n), earlier, y))
        earlier = np.column_stack([earlier, unseen])
    return chain


# --- Spark


def fit(
    documents: DataFrame,
    labels: DataFrame,
    categories: dict[str, str],
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = TRAIN_DOCUMENTS,
) -> dict[str, Link]:
    """The chain for ``categories`` (name to SQL condition over ``labels``), in their order.

    Trained on at most ``limit`` labelled documents, those with the smallest hash of their id. A
    null label is no member of a category. Without labelled documents no text is in any category.
    """
    named = [F.coalesce(F.expr(c), F.lit(False)).cast("int").alias(f"y{i}") for i, c in enumerate(categories.values())]
    chosen = (
        labels.select(F.col(id_col).alias("id"), *named)
        .filter("id is not null")
        .groupBy("id")
        .agg(*[F.max(f"y{i}").alias(f"y{i}") for i in range(len(named))])
        .orderBy(F.xxhash64("id"), "id")
        .limit(limit)
    )

    @F.arrow_udf("binary")
    def numbers(column: pa.Array) -> pa.Array:
        texts, out = as_bytes(column), []
        for lo, hi in text_blocks(texts):
            doc, word = word_numbers(texts[lo:hi])
            key = np.unique(doc << BITS | word)
            cuts = np.searchsorted(key, np.arange(1, hi - lo) << BITS)
            low = (key & ((1 << BITS) - 1)).astype(np.uint32)
            out.extend(w.tobytes() for w in np.split(low, cuts))
        return pa.array(out, pa.binary())

    rows = (
        documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(F.broadcast(chosen), "id")  # at most ``limit`` rows
        .withColumn("words", numbers("text"))
        .groupBy("id", *[f"y{i}" for i in range(len(named))])
        .agg(F.min("words").alias("words"))  # of rows that share an id
        .orderBy("id")
        .collect()
    )
    if not rows:
        none = np.zeros(0)
        return {
            name: Link(none.astype(np.int64), none, np.zeros(i), -30.0)
            for i, name in enumerate(categories)
        }
    sizes = [len(r["words"]) // 4 for r in rows]
    y = np.array([[r[f"y{i}"] for i in range(len(named))] for r in rows])
    fold = (mix(np.array([r["id"] for r in rows], np.int64).view(np.uint64)) % np.uint64(FOLDS)).astype(int)
    word = np.frombuffer(b"".join(r["words"] for r in rows), np.uint32)
    doc = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
    del rows
    # what fewer documents have than any feature needs is left out before the arrays grow
    often = np.bincount(word, minlength=1 << BITS).astype(np.int32) >= MIN_DOCUMENTS
    keep = often[word]
    doc, word = doc[keep], (np.cumsum(often, dtype=np.int32) - 1)[word[keep]]
    numbers = np.flatnonzero(often)
    chain = train(doc, word, y, fold)
    return {n: link._replace(words=numbers[link.words]) for n, link in zip(categories, chain)}


def probabilities(chain: dict[str, Link], text: str | Column = "text") -> Column:
    """A struct with the probability of each category; a null text has no words."""
    names = list(chain)
    union = np.unique(np.concatenate([c.words for c in chain.values()])) if chain else np.zeros(0)
    place = np.full(1 << BITS, -1, np.int32)
    place[union.astype(np.int64)] = np.arange(len(union))
    weights = np.zeros((len(chain), len(union)))
    for row, link in zip(weights, chain.values()):
        row[np.searchsorted(union, link.words)] = link.weights

    def score(column: pa.Array) -> pa.Array:
        texts = as_bytes(column)
        out = [[] for _ in names]
        for lo, hi in text_blocks(texts):
            doc, word = word_numbers(texts[lo:hi])
            at = place[word]
            known = at >= 0
            key = np.unique(doc[known] * (len(union) + 1) + at[known])
            own, feature = key // (len(union) + 1), key % (len(union) + 1)
            earlier = np.zeros((hi - lo, 0))
            for i, link in enumerate(chain.values()):
                total = np.bincount(own, weights[i][feature], hi - lo)
                p = _sigmoid(total + earlier @ link.earlier + link.bias)
                out[i].append(p)
                earlier = np.column_stack([earlier, p])
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate([np.zeros(0), *o])) for o in out], names=names
        )

    schema = ", ".join(f"`{n}` double" for n in names)
    return F.arrow_udf(score, schema)(F.col(text) if isinstance(text, str) else text)
