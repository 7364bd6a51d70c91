"""Words of many texts at once, as numpy arrays over one byte buffer.

A word is a run of bytes other than the six ASCII white spaces. In UTF-8 no other character
holds those bytes, so a text need not be decoded to be cut into words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np

# Bytes of text that are looked at together; a longer text makes a block of its own.
BLOCK_BYTES = 1 << 21
HASH_BYTES = 1 << 17
WHITE = bytes([0x20, *range(0x09, 0x0E)])
# Words and hashes: positions beyond this many bytes reuse the table with another factor.
_SPAN = 64
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

_is_white = np.zeros(256, bool)
_is_white[list(WHITE)] = True
# Everything in ASCII that is neither a letter nor a digit.
_is_mark = np.zeros(256, bool)
_is_mark[[c for c in range(128) if not chr(c).isalnum()]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finalizer: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x += _FACTOR
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


# One random number for each place in a word and byte there.
_TABLE = mix(np.arange(_SPAN * 256, dtype=np.uint64))


class Words(NamedTuple):
    """``text``: every word followed by one space. ``first[d]``: the first word of text ``d``."""

    text: bytes
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def of_text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def split(texts: list[bytes | None], marks: bool = False) -> Words:
    """The words of each text; a null text has none.

    With ``marks``, ASCII characters other than letters and digits part words too.
    """
    parts = [t or b"" for t in texts]
    ends = np.cumsum([len(p) + 1 for p in parts], dtype=np.int64)
    raw = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    white = (_is_mark if marks else _is_white)[raw]
    last = np.ones(len(raw), bool)
    last[1:] = white[:-1]
    opens = np.flatnonzero(~white & last)
    closes = np.flatnonzero(white & ~last)
    first = np.concatenate([[0], np.searchsorted(opens, ends)])
    keep = ~(white & last)
    if keep.all():
        text, starts, stops = raw.copy(), opens, closes
    else:
        place = np.cumsum(keep) - 1
        text, starts, stops = raw[keep], place[opens], place[closes]
    text[stops] = 0x20
    return Words(text.tobytes(), starts, stops, first)


def blocks(sizes: Iterable[int], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items whose sizes add up to about ``limit``."""
    start = total = 0
    place = -1
    for place, size in enumerate(sizes):
        if total and total + size > limit:
            yield start, place
            start, total = place, 0
        total += size
    if place >= start:
        yield start, place + 1


def text_blocks(texts: list[bytes | None], limit: int = BLOCK_BYTES):
    """Blocks of ``texts`` as ``(start, stop)``."""
    return blocks((len(t or b"") + 1 for t in texts), limit)


def as_bytes(column) -> list[bytes | None]:
    """An Arrow column of strings as UTF-8."""
    import pyarrow as pa

    return column.cast(pa.binary()).to_pylist()


def _byte_values(words: Words) -> np.ndarray:
    """The table's number for each byte of ``words.text``, by its place in its word."""
    text = np.frombuffer(words.text, np.uint8)
    lengths = (words.ends - words.starts + 1).astype(np.int32)
    place = np.arange(len(text), dtype=np.int32)
    place -= np.repeat(words.starts.astype(np.int32), lengths)
    values = _TABLE[((place & (_SPAN - 1)) << 8) | text]
    if int(lengths.max(initial=0)) > _SPAN:
        far = np.flatnonzero(place >= _SPAN)
        turns = place[far] // _SPAN
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(int(turns.max()), _FACTOR, np.uint64), dtype=np.uint64)
            values[far] *= powers[turns - 1]
    return values


def hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word: the sum of the table's numbers for its bytes.

    Taken ``HASH_BYTES`` at a time: the numbers of more bytes leave the processor's cache.
    """
    out = np.zeros(len(words.starts), np.uint64)
    start = 0
    while start < len(out):
        begin = int(words.starts[start])
        stop = max(start + 1, int(np.searchsorted(words.ends, begin + HASH_BYTES)))
        starts, ends = words.starts[start:stop] - begin, words.ends[start:stop] - begin
        part = Words(words.text[begin : int(words.ends[stop - 1]) + 1], starts, ends, words.first)
        with np.errstate(over="ignore"):
            out[start:stop] = np.add.reduceat(_byte_values(part), starts)
        start = stop
    return out


def prefix_hashes(words: Words, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """``(word, hash)`` of each word whole and of its first ``sizes`` bytes where it is longer."""
    n = len(words.starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_byte_values(words), dtype=np.uint64)])
        owners, values = [np.arange(n)], [total[words.ends] - total[words.starts]]
        for size in sizes:
            at = np.flatnonzero(words.ends - words.starts > size)
            start = words.starts[at]
            owners.append(at)
            # told apart from a whole word of the same bytes
            values.append((total[start + size] - total[start]) ^ np.uint64(size))
    return np.concatenate(owners), np.concatenate(values)


def chained(hash_: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` consecutive words, by doubling; ``len - n + 1`` values."""
    factor = np.uint64(0xD6E8FEB86659FD93)
    with np.errstate(over="ignore"):
        out, have, run, size, power = None, 0, hash_, 1, factor
        while True:
            if n & size:
                if out is None:
                    out = run
                else:
                    step = np.uint64(pow(int(factor), have, 1 << 64))
                    m = len(run) - have
                    out = out[:m] + step * run[have:] if m > 0 else hash_[:0]
                have += size
            if have == n:
                return out[: max(0, len(hash_) - n + 1)]
            run = run[:-size] + power * run[size:] if len(run) > size else hash_[:0]
            size, power = 2 * size, power * power
