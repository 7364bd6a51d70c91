"""Trigram language-model scores from tries in Elias-Fano levels.

Words are counted exactly, and every word keeps its own n-grams. The most frequent ones, at most
``VOCABULARY``, have ids as a shorter code; any other word is coded by its hash, which a message
lists once, and brings its count to the shards that ask for it. Which words have ids changes the
size of messages and no probability. Each shard numbers the words it holds. N-grams are dealt
into shards by their middle word v; a shard's trie has

    v                      the contexts of the shard
    v -> w                 successors, with the probability of w behind v
    v -> u                 the words before v, with a back-off weight
    (v, u) -> w            successors of the pair, with the probability of w behind u v

Ids of a level are made monotone by the pointer of the level above and stored as Elias-Fano
sequences; a successor of a pair is stored not by its id but by its place among the successors of
v. Probabilities (absolute discounting, interpolated down to single words) are quantised. A trie
is one run of bytes that can be mapped into memory as it is. Texts are scored where the tries are:
each distinct trigram of a block of texts goes to its shard with the texts that hold it, and only
sums per text come back. The ids of the texts travel with their block, so that no row is told by
its place in a scan that is read again.
"""

from __future__ import annotations

import struct
from tempfile import SpooledTemporaryFile
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.llm.words import as_bytes, hashes, mix, split, text_blocks
from turnloom.operators.scale import cut_lineage

ID_BITS = 20
VOCABULARY = (1 << ID_BITS) - 2
BEGIN, FIRST_ID = 1, 2
# Codes of words below are ids, the others hashes; so it is with places in a message or a shard.
TAIL = 1 << ID_BITS
# Bits of a word in the trigrams of a message, which lists at most TAIL hashes.
LOCAL_BITS = ID_BITS + 1
DISCOUNT = 0.75
# Training tokens of one shard, about. A middle word with more is split by the word before it.
SHARD_TOKENS = 1 << 19
BLOCK_BYTES = 4 << 20
# Packed messages of a shard that wait in memory.
SPOOL_BYTES = 64 << 20
# The hash that stands for the end of a text, counted as a token.
END = np.uint64(0x5851F42D4C957F2D)
_LOCAL = np.int64((1 << LOCAL_BITS) - 1)


# --- Elias-Fano


def ef_encode(values: np.ndarray) -> bytes:
    """A non-decreasing sequence: low bits packed, high parts as steps in unary."""
    n = len(values)
    top = int(values[-1]) + 1 if n else 1
    low_bits = max(0, (top // max(1, n)).bit_length() - 1)
    values = values.astype(np.uint64)
    high = (values >> np.uint64(low_bits)).astype(np.int64)
    upper = np.zeros(n + (int(high[-1]) if n else 0) + 1, np.uint8)
    upper[high + np.arange(n)] = 1
    shifts = np.arange(low_bits, dtype=np.uint64)
    low = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    low, upper = np.packbits(low.ravel()).tobytes(), np.packbits(upper).tobytes()
    return struct.pack("<QBQQ", n, low_bits, len(low), len(upper)) + low + upper


def ef_decode(data: memoryview | bytes, at: int = 0) -> tuple[np.ndarray, int]:
    """The sequence at ``at`` of a buffer, and where it ends."""
    n, low_bits, low_size, upper_size = struct.unpack_from("<QBQQ", data, at)
    at += struct.calcsize("<QBQQ")
    low = np.unpackbits(np.frombuffer(data, np.uint8, low_size, at), count=n * low_bits)
    at += low_size
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, upper_size, at)))[:n]
    at += upper_size
    values = (ones - np.arange(n)) << low_bits
    if low_bits:
        values = values + low.reshape(n, low_bits) @ (1 << np.arange(low_bits))
    return values.astype(np.int64), at


def quantise(values: np.ndarray) -> bytes:
    """Numbers as one byte each: 256 bins with as many values in each, told by their means."""
    n = len(values)
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    # equal values share a bin
    edges = np.unique(ranked[np.arange(256) * n // 256]) if n else np.zeros(1)
    codes = np.searchsorted(edges, values, side="right") - 1
    means = np.bincount(codes, values, len(edges)) / np.maximum(1, np.bincount(codes, minlength=len(edges)))
    return struct.pack("<QQ", n, len(edges)) + means.astype("<f8").tobytes() + codes.astype(np.uint8).tobytes()


def dequantise(data: memoryview | bytes, at: int) -> tuple[np.ndarray, int]:
    n, bins = struct.unpack_from("<QQ", data, at)
    at += struct.calcsize("<QQ")
    means = np.frombuffer(data, "<f8", bins, at)
    at += means.nbytes
    return means[np.frombuffer(data, np.uint8, n, at)], at + n


def _find(sequence: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``values`` in a sorted sequence, and which are there."""
    at = np.searchsorted(sequence, values)
    at[at == len(sequence)] = 0
    there = sequence[at] == values if len(sequence) else np.zeros(len(values), bool)
    return at, there


# --- a trie


def _triples(pair, w, count, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of counts by ``v u`` (in ``pair``) and ``w``, in order."""
    if 3 * bits <= 63:
        order = np.argsort(pair << bits | w, kind="stable")
    else:
        order = np.lexsort((w, pair))
    pair, w, count = pair[order], w[order], count[order]
    if not len(pair):
        return pair, w, count
    fresh = np.ones(len(pair), bool)
    fresh[1:] = (np.diff(pair) != 0) | (np.diff(w) != 0)
    first = np.flatnonzero(fresh)
    return pair[first], w[first], np.add.reduceat(count, first).astype(np.int64)


def build(key3, count3, key2, count2, log_p1: np.ndarray) -> bytes:
    """The trie of trigrams given as ``v u w`` of ``ID_BITS`` bits each."""
    return build_wide(key3 >> ID_BITS, key3 & (TAIL - 1), count3, key2, count2, log_p1, ID_BITS)


def build_wide(pair3, w3, count3, key2, count2, log_p1: np.ndarray, bits: int) -> bytes:
    """The trie of trigram counts (``v u`` in ``pair3``) and of the bigram counts ``v w`` of
    contexts that are split over shards (``key2``); other bigrams are sums of the trigrams."""
    mask = np.int64((1 << bits) - 1)
    pair, w3, count3 = _triples(pair3, w3, count3, bits)
    split_v = np.unique(key2 >> bits)
    v3 = pair >> bits
    own = ~_find(split_v, v3)[1]
    key2 = np.concatenate([key2, (v3 << bits | w3)[own]])
    count2 = np.concatenate([count2, count3[own]])
    order = np.argsort(key2, kind="stable")
    key2, count2 = _summed(key2[order], count2[order])
    v2, w2 = key2 >> bits, key2 & mask

    contexts, first2 = np.unique(v2, return_index=True)
    index2 = np.searchsorted(contexts, v2)
    total2 = np.bincount(index2, count2, len(contexts))
    kinds2 = np.bincount(index2, minlength=len(contexts))
    back2 = DISCOUNT * kinds2 / np.maximum(total2, 1)
    p2 = (count2 - DISCOUNT) / total2[index2] + back2[index2] * 10 ** log_p1[w2]

    pairs, first3 = np.unique(pair, return_index=True)
    index3 = np.searchsorted(pairs, pair)
    total3 = np.bincount(index3, count3, len(pairs))
    back3 = DISCOUNT * np.bincount(index3, minlength=len(pairs)) / np.maximum(total3, 1)
    place2 = np.searchsorted(key2, v3 << bits | w3)
    p3 = (count3 - DISCOUNT) / total3[index3] + back3[index3] * p2[place2]

    v_of_pair = np.searchsorted(contexts, pairs >> bits)
    # a successor of a pair: its place among those of v, behind all places of earlier pairs
    base3 = np.concatenate([[0], np.cumsum(kinds2[v_of_pair])]).astype(np.int64)
    relative = place2 - first2[v_of_pair][index3]
    return b"".join(
        [
            ef_encode(contexts),
            ef_encode(np.append(first2, len(key2))),
            ef_encode((index2 << bits) + w2),
            ef_encode((v_of_pair << bits) + (pairs & mask)),
            ef_encode(np.append(first3, len(pair))),
            ef_encode(base3[index3] + relative),
            quantise(np.log10(p2)),
            quantise(np.log10(back2)),
            quantise(np.log10(p3)),
            quantise(np.log10(back3)),
        ]
    )


def _summed(key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(key):
        return key.astype(np.int64), count.astype(np.int64)
    first = np.flatnonzero(np.diff(key, prepend=key[0] - 1))
    return key[first], np.add.reduceat(count, first).astype(np.int64)


class Trie:
    """A trie over any buffer: bytes, or a file mapped into memory."""

    def __init__(self, data: memoryview | bytes, bits: int = ID_BITS) -> None:
        self.bits = bits
        at, levels, numbers = 0, [], []
        for _ in range(6):
            level, at = ef_decode(data, at)
            levels.append(level)
        for _ in range(4):
            values, at = dequantise(data, at)
            numbers.append(values)
        self.contexts, self.first2, self.words, self.pairs, self.first3, self.triples = levels
        self.p2, self.back2, self.p3, self.back3 = numbers
        kinds = np.diff(self.first2)
        self.base3 = np.concatenate([[0], np.cumsum(kinds[self.pairs >> bits])])

    def score(self, key: np.ndarray, log_p1: np.ndarray) -> np.ndarray:
        """log10 of the probability of each trigram's last word (keys ``v u w``)."""
        bits, mask = self.bits, (1 << self.bits) - 1
        return self.score_wide(key >> 2 * bits, (key >> bits) & mask, key & mask, log_p1)

    def score_wide(self, v, u, w, log_p1: np.ndarray) -> np.ndarray:
        at_v, has_v = _find(self.contexts, v)
        at_w, has_w = _find(self.words, (at_v << self.bits) + w)
        has_w &= has_v
        out = log_p1[w]
        out = np.where(has_w, _at(self.p2, at_w), out + np.where(has_v, _at(self.back2, at_v), 0))
        at_u, has_u = _find(self.pairs, (at_v << self.bits) + u)
        has_u &= has_v
        relative = at_w - self.first2[at_v]
        at_3, has_3 = _find(self.triples, self.base3[at_u] + relative)
        has_3 &= has_u & has_w
        return np.where(has_3, _at(self.p3, at_3), out + np.where(has_u, _at(self.back3, at_u), 0))


def _at(values: np.ndarray, place: np.ndarray) -> np.ndarray:
    return values[place] if len(values) else np.zeros(len(place))


# --- texts as tokens


class Vocabulary(NamedTuple):
    hashes: np.ndarray  # of the words with ids, sorted; id = place + FIRST_ID
    counts: np.ndarray
    log_p1: np.ndarray  # by id
    denominator: float  # of single words' probabilities
    parts: np.ndarray  # by id: over how many shards the n-grams around it are dealt
    shards: int


def tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of each text, its end behind them, and bounds per text."""
    words = split([(t or b"").lower() for t in texts])
    value = np.insert(hashes(words), words.first[1:], END)
    value[value < TAIL] += np.uint64(TAIL)  # below are the ids
    return value, words.first + np.arange(len(words.first))


class _Index:
    """The words with ids by the leading bits of their hashes."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        bits = max(1, len(vocabulary.hashes).bit_length())
        self.shift = np.uint64(64 - bits)
        # no word has the hash zero
        self.hashes = np.append(vocabulary.hashes, np.uint64(0))
        sizes = np.bincount((vocabulary.hashes >> self.shift).astype(np.int64), minlength=1 << bits)
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)

    def codes(self, value: np.ndarray) -> np.ndarray:
        bucket = (value >> self.shift).astype(np.int64)
        at, end = self.first[bucket], self.first[bucket + 1]
        out, own = value.copy(), np.arange(len(value))
        while len(own):
            found = self.hashes[at] == value[own]
            out[own[found]] = at[found] + FIRST_ID
            more = np.flatnonzero(~found & (at + 1 < end))
            own, at, end = own[more], at[more] + 1, end[more]
        return out


def _tail(*codes: np.ndarray) -> np.ndarray:
    """The words without ids, sorted."""
    return np.unique(np.concatenate([c[c >= TAIL] for c in codes]))


def _places(codes: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Ids, and places in ``tail`` behind them; what is not there has the place behind the last."""
    places = codes.astype(np.int64)
    behind = np.flatnonzero(codes >= TAIL)
    if len(behind):
        at, there = _find(tail, codes[behind])
        places[behind] = TAIL + np.where(there, at, len(tail))
    return places


def _coded(places: np.ndarray, tail: np.ndarray) -> np.ndarray:
    codes = places.astype(np.uint64)
    if len(tail):
        behind = np.flatnonzero(places >= TAIL)
        codes[behind] = tail[places[behind] - TAIL]
    return codes


def _before(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``v`` and ``u`` of each token; a text begins behind two ``BEGIN``."""
    v, u = np.roll(codes, 1), np.roll(codes, 2)
    starts = first[:-1]
    v[starts] = u[starts] = BEGIN
    second = starts[np.diff(first) > 1] + 1
    u[second] = BEGIN
    return v, u


def _parts(vocabulary: Vocabulary, v: np.ndarray) -> np.ndarray:
    """Over how many shards the n-grams around ``v`` are dealt."""
    return vocabulary.parts[np.where(v < TAIL, v, BEGIN - 1).astype(np.int64)]


def _shard(vocabulary: Vocabulary, v: np.ndarray, u: np.ndarray) -> np.ndarray:
    return _shard_of(vocabulary, v, mix(u) % _parts(vocabulary, v).astype(np.uint64))


def _shard_of(vocabulary: Vocabulary, v: np.ndarray, part: np.ndarray) -> np.ndarray:
    word = np.where(v < TAIL, v << np.uint64(40) | part.astype(np.uint64), v)
    return (mix(word) % np.uint64(vocabulary.shards)).astype(np.int64)


# --- messages


def _packed(*columns: np.ndarray) -> bytes:
    """Integer columns, the first sorted and stored as steps; bytes of equal weight together, as
    many as the column's largest number has. Columns but the first hold no negative numbers."""
    columns = [np.ascontiguousarray(c, dtype=np.int64).view(np.uint64) for c in columns]
    if len(columns[0]):
        columns[0] = np.diff(columns[0], prepend=np.uint64(0))
    widths = [(int(c.max(initial=0)).bit_length() + 7) // 8 for c in columns]
    head = struct.pack(f"<B{len(columns)}Q{len(columns)}B", len(columns), *map(len, columns), *widths)
    planes = (
        (c >> np.uint64(8 * i)).astype(np.uint8).tobytes()
        for c, width in zip(columns, widths)
        for i in range(width)
    )
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(planes))


def _unpacked(blob: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = data[0]
    sizes = struct.unpack_from(f"<{n}Q{n}B", data, 1)
    at, out = 1 + 9 * n, []
    for size, width in zip(sizes[:n], sizes[n:]):
        column = np.zeros(size, np.uint64)
        for i in range(width):
            plane = np.frombuffer(data, np.uint8, size, at).astype(np.uint64)
            column |= plane << np.uint64(8 * i)
            at += size
        out.append(column.view(np.int64))
    out[0] = np.cumsum(out[0])
    return out


def _head(data: bytes) -> list[np.ndarray]:
    """Columns of the head of a block: ids, flags, tokens, known tokens, base score."""
    (texts,) = struct.unpack_from("<Q", data)
    packed = len(data) - 8 * texts
    return [*_unpacked(data[8:packed]), np.frombuffer(data, "<f8", texts, packed)]


def _halves(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return words >> np.uint64(32), words & np.uint64(0xFFFFFFFF)


def _whole(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return high.astype(np.uint64) << np.uint64(32) | low.astype(np.uint64)


def _cuts(sorted_: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of equal values."""
    edges = np.flatnonzero(np.diff(sorted_)) + 1
    bounds = np.concatenate([[0], edges, [len(sorted_)]]).tolist()
    return [(a, b) for a, b in zip(bounds, bounds[1:]) if b > a]


def _batch(rows: list[tuple], names: str, kinds: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=names.split()
    )


# --- Spark


def _documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return df.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(crc % 5 == 1, F.lit(False)).alias("held_out"),
        F.col(text_col).alias("text"),
    )


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, n)``: how often each word hash occurs in texts that are not held out."""

    def count(batches):
        for batch in batches:
            texts = as_bytes(batch.column(0))
            for lo, hi in text_blocks(texts, BLOCK_BYTES):
                parts = [tokens(texts[a + lo : b + lo])[0] for a, b in text_blocks(texts[lo:hi])]
                value, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value.view(np.int64)), pa.array(n)], names=["word", "n"]
                )

    texts = docs.filter("not held_out").select("text")
    return texts.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary_of(counts: DataFrame) -> tuple[Vocabulary, dict]:
    """The words with ids (all that occur at least so often that they fit), and totals.

    The others are coded by their hashes, with the same probabilities.
    """
    spectrum = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n"))
    # one row per distinct count, from the top until the vocabulary is full
    least, words = 1, 0
    total = distinct = 0
    for row in spectrum.toLocalIterator():
        total += row["n"] * row["words"]
        distinct += row["words"]
        if words + row["words"] <= VOCABULARY and words == distinct - row["words"]:
            words, least = distinct, row["n"]
    if words == 0:
        least = 1 << 62
    table = counts.filter(F.col("n") >= least).toArrow()  # at most VOCABULARY rows
    value = table["word"].to_numpy().view(np.uint64)
    order = np.argsort(value)
    value, n = value[order], table["n"].to_numpy()[order]
    denominator = total + 0.5 * (distinct + 1)
    p1 = np.concatenate([[1.0, 1.0], n + 0.5]) / max(denominator, 0.5)
    at, there = _find(value, np.array([END]))
    ends = int(n[at[0]]) if there[0] else 0
    by_id = np.concatenate([[0, ends], n])
    parts = np.maximum(1, -(-by_id // SHARD_TOKENS)).astype(np.int64)
    shards = max(1, -(-total // SHARD_TOKENS))
    facts = {"tokens": total, "distinct": distinct, "denominator": denominator}
    return Vocabulary(value, n, np.log10(p1), max(denominator, 0.5), parts, shards), facts


_MESSAGE = "shard long, block long, texts binary, blob binary"
_MESSAGE_KINDS = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]


def _blocks(batch, index: _Index):
    """Blocks of texts: their range in the batch, trigrams, the text each belongs to (its place in
    the block), and the hashes of words that have places behind the ids."""
    texts = as_bytes(batch["text"])
    for lo, hi in text_blocks(texts, BLOCK_BYTES):
        codes, firsts = [], [np.zeros(1, np.int64)]
        for a, b in text_blocks(texts[lo:hi]):
            value, first = tokens(texts[lo + a : lo + b])
            codes.append(index.codes(value))
            firsts.append(first[1:] + firsts[-1][-1])
        w, first = np.concatenate(codes), np.concatenate(firsts)
        owner = np.repeat(np.arange(hi - lo), np.diff(first))
        tail = _tail(w)
        if len(tail) <= TAIL:
            w = _places(w, tail)
            yield (lo, hi), _key(*_before(w, first), w), owner, tail
            continue
        # a very long text with more words than a message lists
        v, u = _before(w, first)
        for at in range(0, len(w), TAIL // 3):
            own = slice(at, at + TAIL // 3)
            tail = _tail(v[own], u[own], w[own])
            yield (lo, hi), _key(*(_places(c[own], tail) for c in (v, u, w))), owner[own], tail


def _key(v: np.ndarray, u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return v << 2 * LOCAL_BITS | u << LOCAL_BITS | w


def _apart(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return key >> 2 * LOCAL_BITS, (key >> LOCAL_BITS) & _LOCAL, key & _LOCAL


def _asked(docs: DataFrame, shared) -> DataFrame:
    """Messages to shards: the distinct trigrams of a block of texts, how often texts to learn
    from hold each, and which texts hold it how often. A message without trigrams heads a block, or
    a part of a very long text: ids, tokens, and what words with ids add to the base score."""

    def ask(batches):
        vocabulary = shared.value
        index = _Index(vocabulary)
        for batch in batches:
            uid = batch["uid"].to_numpy()
            no_id = batch["id"].is_null().to_numpy(zero_copy_only=False)
            ids = batch["id"].fill_null(0).to_numpy()
            held_out = batch["held_out"].to_numpy(zero_copy_only=False)
            for (lo, hi), key, owner, tail in _blocks(batch, index):
                block, learned = int(uid[lo]), ~held_out[lo:hi]
                w = key & _LOCAL
                coded = w < TAIL
                tokens_ = np.bincount(owner, minlength=hi - lo)
                known = np.bincount(owner[coded], minlength=hi - lo)
                base = np.bincount(owner[coded], vocabulary.log_p1[w[coded]], hi - lo)
                flags = no_id[lo:hi] + 2 * held_out[lo:hi]
                head = _packed(ids[lo:hi], flags, tokens_, known)
                head = struct.pack("<Q", hi - lo) + head + base.astype("<f8").tobytes()
                row = (block % vocabulary.shards, block, head, None)
                yield _batch([row], "shard block texts blob", _MESSAGE_KINDS)
                order = np.lexsort((owner, key))
                key, owner = key[order], owner[order]
                # equal trigrams of one text are one entry, with a number
                fresh = np.ones(len(key), bool)
                fresh[1:] = (np.diff(key) != 0) | (np.diff(owner) != 0)
                at = np.flatnonzero(fresh)
                times = np.diff(np.append(at, len(key)))
                key, owner = key[at], owner[at]
                v, u, _ = _apart(key)
                shard = _shard(vocabulary, _coded(v, tail), _coded(u, tail))
                order = np.argsort(shard, kind="stable")
                rows = []
                for a, b in _cuts(shard[order]):
                    own = order[a:b]
                    kinds, begin, n = np.unique(key[own], return_index=True, return_counts=True)
                    seen = np.add.reduceat(times[own] * learned[owner[own]], begin)
                    texts, place = np.unique(owner[own], return_inverse=True)
                    # the hashes of the words that the message names
                    slot = np.zeros(0, np.int64)
                    if len(tail):
                        slot = np.unique(np.concatenate([c[c >= TAIL] for c in _apart(kinds)])) - TAIL
                    blob = _packed(kinds, n, seen, place, times[own], slot, *_halves(tail[slot]))
                    rows.append((int(shard[own[0]]), block, _packed(texts), blob))
                yield _batch(rows, "shard block texts blob", _MESSAGE_KINDS)

    return docs.select("uid", "id", "held_out", "text").mapInArrow(ask, _MESSAGE)


def _split_pairs(docs: DataFrame, shared) -> DataFrame:
    """Messages with the bigrams of contexts that are split, for each of their shards.

    Counted whole first, so that every part of a context knows all its successors.
    """

    def message(shard: np.ndarray, v: np.ndarray, w: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(shard, kind="stable")
        rows = []
        for a, b in _cuts(shard[order]):
            own = order[a:b]
            tail = _tail(w[own])
            key = v[own].astype(np.int64) << 32 | _places(w[own], tail)
            own, key = own[np.argsort(key)], np.sort(key)
            rows.append((int(shard[own[0]]), None, None, _packed(key, n[own], *_halves(tail))))
        return _batch(rows, "shard block texts blob", _MESSAGE_KINDS)

    def count(batches):
        vocabulary = shared.value
        index = _Index(vocabulary)
        split_ids = np.flatnonzero(vocabulary.parts > 1)
        split_ids = split_ids[split_ids >= FIRST_ID]
        split_words = vocabulary.hashes[split_ids - FIRST_ID]
        for batch in batches:
            texts = as_bytes(batch["text"])
            for lo, hi in text_blocks(texts, BLOCK_BYTES):
                value, first = tokens(texts[lo:hi])
                # only what stands behind a split word is looked up
                at, there = _find(split_words, value[:-1])
                there[first[1:-1] - 1] = False
                behind = np.flatnonzero(there)
                v, w = split_ids[at[behind]], value[behind + 1]
                if vocabulary.parts[BEGIN] > 1:
                    v = np.concatenate([v, np.full(hi - lo, BEGIN)])
                    w = np.concatenate([w, value[first[:-1]]])
                w = index.codes(w)
                tail = _tail(w)
                pair, n = np.unique(v << 32 | _places(w, tail), return_counts=True)
                v, w = (pair >> 32).astype(np.uint64), _coded(pair & 0xFFFFFFFF, tail)
                place = mix(mix(v) ^ w) % np.uint64(vocabulary.shards)
                yield message(place.astype(np.int64), v, w, n)

    def deal(table: pa.Table) -> pa.Table:
        vocabulary = shared.value
        v, w, n = _gathered_pairs([_pairs(_unpacked(b)) for b in table["blob"].to_pylist()])
        times = _parts(vocabulary, v)
        row = np.repeat(np.arange(len(v)), times)
        part = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
        shard = _shard_of(vocabulary, v[row], part)
        own = np.lexsort((row, shard))
        # parts of one word can share a shard: a pair goes there once
        first = np.ones(len(own), bool)
        first[1:] = (np.diff(shard[own]) != 0) | (np.diff(row[own]) != 0)
        own = own[first]
        return pa.Table.from_batches([message(shard[own], v[row[own]], w[row[own]], n[row[own]])])

    return (
        docs.filter("not held_out")
        .select("text")
        .mapInArrow(count, _MESSAGE)
        .groupBy("shard")
        .applyInArrow(deal, _MESSAGE)
    )


def _pairs(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``v``, ``w`` and counts of a message of bigrams."""
    key, n, high, low = columns
    return (key >> 32).astype(np.uint64), _coded(key & 0xFFFFFFFF, _whole(high, low)), n


def _joined(parts: list[tuple], width: int) -> list[np.ndarray]:
    """Columns of many messages; the last is a count, the others are codes."""
    none = [np.zeros(0, np.uint64)] * (width - 1) + [np.zeros(0, np.int64)]
    return [np.concatenate(c) for c in zip(none, *parts)]


def _gathered_pairs(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of counts by bigram over many messages."""
    v, w, n = _joined(parts, 3)
    tail = _tail(w)
    key = v.astype(np.int64) << 32 | _places(w, tail)
    order = np.argsort(key, kind="stable")
    key, n = _summed(key[order], n[order])
    return (key >> 32).astype(np.uint64), _coded(key & 0xFFFFFFFF, tail), n


def _tail_counts(docs: DataFrame, counts: DataFrame, shared) -> DataFrame:
    """Messages with the counts of words without ids, for each shard that asks for one."""

    def want(batches):
        vocabulary = shared.value
        index = _Index(vocabulary)
        for batch in batches:
            for _, key, _, tail in _blocks(batch, index):
                v, u, w = _apart(key[(key & _LOCAL) >= TAIL])
                shard = _shard(vocabulary, _coded(v, tail), _coded(u, tail))
                rows = np.unique(shard << LOCAL_BITS | w)
                word = tail[(rows & _LOCAL) - TAIL].view(np.int64)
                columns = [pa.array(rows >> LOCAL_BITS), pa.array(word)]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "word"])

    def message(table: pa.Table) -> pa.Table:
        word, n = table["word"].to_numpy(), table["n"].to_numpy()
        order = np.argsort(word)
        row = (table["shard"][0].as_py(), None, b"", _packed(word[order], n[order]))
        return pa.Table.from_batches([_batch([row], "shard block texts blob", _MESSAGE_KINDS)])

    return (
        docs.select("text")
        .mapInArrow(want, "shard long, word long")
        .distinct()
        .join(counts, "word")
        .groupBy("shard")
        .applyInArrow(message, _MESSAGE)
    )


class _Shard:
    """One shard in its task: first all messages are learned from, then all are scored.

    Between the two, messages wait packed; those of a very large shard wait in a scratch file of
    the task, so that memory holds the distinct n-grams of the shard and no more.
    """

    def __init__(self) -> None:
        self.pairs: list = []
        self.triples: list = []
        self.counts: list = []
        self.held = 0
        self.waiting = SpooledTemporaryFile(max_size=SPOOL_BYTES)

    def learn(self, block: int | None, texts: bytes | None, blob: bytes) -> None:
        columns = _unpacked(blob)
        if block is None:
            if texts is None:
                self.pairs.append(_pairs(columns))
            else:
                self.counts.append((columns[0].view(np.uint64), columns[1]))
            return
        seen = columns[2] > 0
        self.triples.append((*self._words(columns, seen), columns[2][seen]))
        self.held += int(seen.sum())
        if self.held > 4 * SHARD_TOKENS:
            *codes, n = _joined(self.triples, 4)
            tail = _tail(*codes)
            bits = (TAIL + len(tail)).bit_length()
            v, u, w = (_places(c, tail) for c in codes)
            pair, w, n = _triples(v << bits | u, w, n, bits)
            vuw = (pair >> bits, pair & ((1 << bits) - 1), w)
            self.triples = [(*(_coded(c, tail) for c in vuw), n)]
            self.held = 0
        self.waiting.write(struct.pack("<qII", block, len(texts), len(blob)) + texts + blob)

    @staticmethod
    def _words(columns: list[np.ndarray], own=slice(None)) -> list[np.ndarray]:
        """``v``, ``u`` and ``w`` of the trigrams of a message."""
        key, slot, tail = columns[0][own], columns[5], _whole(*columns[6:])
        out = []
        for places in _apart(key):
            codes = places.astype(np.uint64)
            if len(slot):
                behind = np.flatnonzero(places >= TAIL)
                codes[behind] = tail[np.searchsorted(slot, places[behind] - TAIL)]
            out.append(codes)
        return out

    def answers(self, vocabulary: Vocabulary):
        """``(block, texts, sums)`` of each message: by text the score, how many tokens are learned
        words without ids, and what all tokens without ids add to the base score."""
        *codes, n3 = _joined(self.triples, 4)
        v2, w2, n2 = _joined(self.pairs, 3)
        words, n1 = _joined(self.counts, 2)
        # every word of the shard; the place behind them is that of all words never learned
        tail = _tail(*codes, w2, words)
        bits = (TAIL + len(tail)).bit_length()
        count = np.zeros(len(tail) + 1)
        count[np.searchsorted(tail, words)] = n1
        by_id = np.zeros(TAIL)
        by_id[: len(vocabulary.log_p1)] = vocabulary.log_p1
        log_p1 = np.concatenate([by_id, np.log10((count + 0.5) / vocabulary.denominator)])
        v, u, w = (_places(c, tail) for c in codes)
        key2 = _places(v2, tail) << bits | _places(w2, tail)
        trie = Trie(build_wide(v << bits | u, w, n3, key2, n2, log_p1, bits), bits)
        self.triples = self.pairs = []
        self.waiting.seek(0)
        while head := self.waiting.read(16):
            block, texts, size = struct.unpack("<qII", head)
            texts = self.waiting.read(texts)
            columns = _unpacked(self.waiting.read(size))
            _, n, _, place, times = columns[:5]
            v, u, w = (_places(c, tail) for c in self._words(columns))
            p = np.repeat(trie.score_wide(v, u, w, log_p1), n) * times
            sums = [np.bincount(place, p)]
            rare = np.zeros(len(sums[0]))
            w = np.repeat(w, n)
            own = np.flatnonzero(w >= TAIL)
            if len(own):
                place, times, w = place[own], times[own], w[own]
                rare = np.bincount(place, times * (count[w - TAIL] > 0), len(rare))
                sums.append(np.bincount(place, times * log_p1[w], len(rare)))
            texts = _packed(_unpacked(texts)[0], rare)
            yield block, texts, np.concatenate(sums).astype("<f8").tobytes()
        self.waiting.close()


def _answered(docs: DataFrame, counts: DataFrame, shared, tail: bool) -> DataFrame:
    """Per text: id, ``held_out``, ``tokens``, ``known``, ``base`` and ``score``."""
    messages = _asked(docs, shared)
    if (shared.value.parts > 1).any():
        messages = messages.unionByName(_split_pairs(docs, shared))
    if tail:
        messages = messages.unionByName(_tail_counts(docs, counts, shared))

    def answer(batches):
        current, shard = None, None
        names, kinds = "block head texts sums", [pa.int64(), pa.binary(), pa.binary(), pa.binary()]

        def done():
            if shard is not None:
                rows = []
                for block, texts, sums in shard.answers(shared.value):
                    rows.append((block, None, texts, sums))
                    if len(rows) == 64:
                        yield _batch(rows, names, kinds)
                        rows = []
                yield _batch(rows, names, kinds)

        for batch in batches:
            heads = []
            for number, block, texts, blob in zip(*(batch[c].to_pylist() for c in ("shard", "block", "texts", "blob"))):
                if blob is None:
                    heads.append((block, texts, None, None))
                    continue
                if number != current:
                    yield from done()
                    current, shard = number, _Shard()
                shard.learn(block, texts, blob)
            yield _batch(heads, names, kinds)
        yield from done()

    def add(table: pa.Table) -> pa.Table:
        heads = [_head(h) for h in sorted(table["head"].drop_null().to_pylist())]
        ids, flags = heads[0][:2]
        counted, known, base = (np.sum(c, axis=0) for c in list(zip(*heads))[2:])
        score = np.zeros(len(ids))
        answers = zip(table["texts"].drop_null().to_pylist(), table["sums"].drop_null().to_pylist())
        # in an order of their own, so that sums are the same each time
        for texts, sums in sorted(answers):
            place, rare = _unpacked(texts)
            sums = np.frombuffer(sums, "<f8").reshape(-1, len(place))
            score[place] += sums[0]
            known[place] += rare
            if len(sums) > 1:
                base[place] += sums[1]
        columns = [pa.array(ids, mask=flags % 2 == 1), flags >= 2, counted, known, base, score]
        return pa.table(dict(zip("id held_out tokens known base score".split(), columns)))

    return (
        messages.repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(answer, "block long, head binary, texts binary, sums binary")
        .groupBy("block")  # the messages of one block of texts, from all shards
        .applyInArrow(add, "id long, held_out boolean, tokens long, known long, base double, score double")
    )


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``
    and ``score``, the trigram model's log10 probability of the text.

    Learns from the rows whose ``crc32(id) mod 5`` is not 1; a null id is learned from. A null
    text is an empty one: its end is its only token. Repeated rows count and are scored each.
    With nothing to learn from, all probability lies on unseen words. ``df`` is read more than
    once and must hold the same rows each time, in any partitions; other columns are ignored.
    """
    spark = df.sparkSession
    docs = _documents(df, id_col, text_col)
    counts = cut_lineage(word_counts(docs))
    vocabulary, facts = vocabulary_of(counts)
    shared = spark.sparkContext.broadcast(vocabulary)  # bounded by VOCABULARY

    rows = _answered(docs, counts, shared, facts["distinct"] > len(vocabulary.hashes))
    return rows.select(
        F.col("id").alias(id_col),
        "held_out",
        F.col("tokens").alias("n_tokens"),
        F.col("known").alias("n_known"),
        F.lit(facts["tokens"]).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
    )
