"""Substring deduplication by super-k-mers.

A window is ``WINDOW`` consecutive words of a document. Its minimiser is the smallest hash of the
``MINI`` consecutive words in it; neighbouring windows mostly share it, so a run of windows with
one minimiser travels as one packed string to the minimiser's bucket. Equal windows have equal
minimisers and meet there, where sorting brings them together; the words themselves are compared,
so the result is exact. All but the first of equal windows are reported as spans of words.

A minimiser with very many runs would fill a bucket. Those are counted first; their runs are
dealt over several buckets by document, each bucket settles its own, and only the first of equal
windows of each bucket go on to a second round, single, dealt by the whole window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.llm.words import Words, as_bytes, chained, hashes, mix, split, text_blocks
from turnloom.operators.scale import cut_lineage

WINDOW = 20
MINI = 3
# Runs of one minimiser that a bucket takes, and minimisers that can be known as frequent.
HOT_RUNS = 4096
HOT_MINIMISERS = 1 << 20
# Bytes of packed strings per bucket, about; and bytes of text packed together.
BUCKET_BYTES = 8 << 20
PACK_BYTES = 4 << 20

_SPANS = "uid long, begin long, stop long"


# --- windows of a block of texts


def runs(words: Words, window: int, mini: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window (as places of their first words) and minimiser of each run."""
    n = len(words.starts) - window + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none.astype(np.uint64)
    low = mix(chained(hashes(words), mini))
    width, have = window - mini + 1, 1
    while 2 * have <= width:
        low, have = np.minimum(low[:-have], low[have:]), 2 * have
    if have < width:
        low = np.minimum(low[: have - width], low[width - have :])
    of_text = words.of_text
    at = np.flatnonzero(of_text[:n] == of_text[window - 1 :])
    if not len(at):
        return none, none, none.astype(np.uint64)
    fresh = np.ones(len(at), bool)
    fresh[1:] = (
        (np.diff(at) != 1) | (low[at[1:]] != low[at[:-1]]) | (of_text[at[1:]] != of_text[at[:-1]])
    )
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(at)) - 1
    return at[first], at[last], low[at[first]]


# --- messages: records of runs, packed

_HEAD = [("doc", np.int64), ("uid", np.int64), ("start", np.uint32), ("n", np.uint32), ("hot", np.uint8)]


def pack_records(columns: dict[str, np.ndarray], texts: list[bytes]) -> bytes:
    head = b"".join(columns[name].astype(kind).tobytes() for name, kind in _HEAD)
    body = len(texts).to_bytes(4, "little") + head + b"".join(texts)
    return zstandard.ZstdCompressor(level=1).compress(body)


def unpack_records(blob: bytes) -> tuple[dict[str, np.ndarray], bytes]:
    body = zstandard.ZstdDecompressor().decompress(blob)
    rows, at = int.from_bytes(body[:4], "little"), 4
    columns = {}
    for name, kind in _HEAD:
        columns[name] = np.frombuffer(body, kind, rows, at)
        at += columns[name].nbytes
    return columns, body[at:]


def _dealt(part: np.ndarray, columns: dict[str, np.ndarray], texts: list[bytes]):
    """One message per part that has records."""
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for rows in np.split(order, cuts):
        if len(rows):
            yield (
                int(part[rows[0]]),
                pack_records({k: v[rows] for k, v in columns.items()}, [texts[r] for r in rows]),
            )


def _message_batch(messages: list[tuple[int, bytes]]) -> pa.RecordBatch:
    parts, blobs = zip(*messages) if messages else ((), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(parts, pa.int64()), pa.array(blobs, pa.binary())], names=["part", "blob"]
    )


# --- a bucket


def settle(blobs: list[bytes], window: int):
    """The spans of windows that start earlier in the bucket, and the other windows of hot runs.

    Spans as ``(uid, begin, stop)`` in words; the others as ``(hash, columns, texts)``.
    """
    parts = [unpack_records(b) for b in blobs]
    cols = {k: np.concatenate([c[k] for c, _ in parts]) for k, _ in _HEAD}
    text = b"".join(t for _, t in parts)
    words = split([text])
    if len(words.starts) != int(cols["n"].sum(dtype=np.int64)):
        raise ValueError("packed words were not cut as they were packed")
    n = cols["n"].astype(np.int64)
    ends = np.cumsum(n)
    # records in the order of documents, then of places
    order = np.lexsort((cols["start"], cols["uid"], cols["doc"]))
    cols = {k: v[order] for k, v in cols.items()}
    from_, n = (ends - n)[order], n[order]
    counts = n - window + 1
    offset = np.concatenate([[0], np.cumsum(counts)])
    record = np.repeat(np.arange(len(n)), counts)
    within = np.arange(len(record)) - offset[record]
    place = from_[record] + within
    value = chained(hashes(words), window)[place]
    owner = _first_equal(value)
    if not _same_words(words, place, owner, record, window):
        owner = _first_equal_words(words, place, window)
    again = np.flatnonzero(owner != np.arange(len(owner)))
    # neighbouring windows of a record make one span
    fresh = np.ones(len(again), bool)
    fresh[1:] = (np.diff(again) != 1) | (record[again[1:]] != record[again[:-1]])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(again)) - 1 if len(again) else first
    a, b = again[first], again[last]
    begin = cols["start"][record[a]].astype(np.int64) + within[a]
    stop = cols["start"][record[b]].astype(np.int64) + within[b] + window
    spans = (cols["uid"][record[a]], begin, stop)

    single = np.flatnonzero((owner == np.arange(len(owner))) & (cols["hot"][record] > 0))
    at = record[single]
    columns = {
        "doc": cols["doc"][at],
        "uid": cols["uid"][at],
        "start": cols["start"][at].astype(np.int64) + within[single],
        "n": np.full(len(at), window),
        "hot": np.zeros(len(at)),
    }
    s, e = words.starts[place[single]], words.ends[place[single] + window - 1] + 1
    texts = [words.text[x:y] for x, y in zip(s.tolist(), e.tolist())]
    return spans, (mix(value[single]), columns, texts)


def _first_equal(value: np.ndarray) -> np.ndarray:
    """For each place the first place that has the same value."""
    order = np.argsort(value, kind="stable")
    fresh = np.ones(len(value), bool)
    fresh[1:] = value[order[1:]] != value[order[:-1]]
    owner = np.empty(len(value), np.int64)
    owner[order] = order[np.flatnonzero(fresh)][np.cumsum(fresh) - 1] if len(value) else order
    return owner


def _same_words(words: Words, place, owner, record, window: int) -> bool:
    """Whether windows that a hash held equal have the same words."""
    again = np.flatnonzero(owner != np.arange(len(owner)))
    if not len(again):
        return True
    held = owner[again]
    fresh = np.ones(len(again), bool)
    fresh[1:] = (
        (np.diff(again) != 1)
        | (np.diff(held) != 1)
        | (record[again[1:]] != record[again[:-1]])
        | (record[held[1:]] != record[held[:-1]])
    )
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(again)) - 1
    text, end = words.text, window - 1
    bounds = zip(
        words.starts[place[again[first]]].tolist(),
        words.ends[place[again[last]] + end].tolist(),
        words.starts[place[held[first]]].tolist(),
        words.ends[place[held[last]] + end].tolist(),
    )
    return all(text[a:b] == text[c:d] for a, b, c, d in bounds)


def _first_equal_words(words: Words, place, window: int) -> np.ndarray:
    """As ``_first_equal``, by the words themselves."""
    seen: dict[bytes, int] = {}
    bounds = zip(words.starts[place].tolist(), words.ends[place + window - 1].tolist())
    return np.fromiter(
        (seen.setdefault(words.text[a:b], i) for i, (a, b) in enumerate(bounds)),
        np.int64,
        len(place),
    )


# --- Spark


def _numbered(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """Rows with a number, stored: a later plan of the scan could cut it otherwise and number
    other rows alike."""
    return cut_lineage(
        df.select(
            F.monotonically_increasing_id().alias("uid"),
            F.col(id_col).cast("long").alias("doc"),
            F.col(text_col).alias("text"),
            *more,
        )
    )


def _hot_minimisers(docs: DataFrame, window: int, mini: int) -> tuple[np.ndarray, np.ndarray]:
    """The minimisers of more than ``HOT_RUNS`` runs, sorted, and over how many buckets to deal."""

    def count(batches):
        for batch in batches:
            texts = as_bytes(batch.column(0))
            for lo, hi in text_blocks(texts):
                values, n = np.unique(runs(split(texts[lo:hi]), window, mini)[2], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values.view(np.int64)), pa.array(n)], names=["mini", "n"]
                )

    hot = (
        docs.select("text")
        .mapInArrow(count, "mini long, n long")
        .groupBy("mini")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") > HOT_RUNS)
        .orderBy(F.desc("n"), "mini")
        .limit(HOT_MINIMISERS)
        .collect()
    )
    hot.sort(key=lambda r: r["mini"] % (1 << 64))
    values = np.array([r["mini"] for r in hot], np.int64).view(np.uint64)
    return values, np.array([-(-r["n"] // HOT_RUNS) for r in hot], np.int64)


def repeated_spans(
    docs: DataFrame, window: int = WINDOW, mini: int = MINI
) -> DataFrame:
    """Spans of words ``(uid, begin, stop)`` of ``docs(uid, doc, text)`` that start earlier too."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, round(3 * size / BUCKET_BYTES))
    hot = spark.sparkContext.broadcast(_hot_minimisers(docs, window, mini))

    def pack(batches):
        hot_values, hot_salts = hot.value
        for batch in batches:
            uid = batch["uid"].to_numpy()
            doc = batch["doc"].fill_null(np.iinfo(np.int64).max).to_numpy()
            texts = as_bytes(batch["text"])
            for lo, hi in text_blocks(texts, PACK_BYTES):
                words = split(texts[lo:hi])
                first, last, value = runs(words, window, mini)
                owner = words.of_text[first] if len(first) else first
                at = np.searchsorted(hot_values, value)
                at[at == len(hot_values)] = 0
                is_hot = hot_values[at] == value if len(hot_values) else np.zeros(len(value), bool)
                salts = hot_salts[at] if len(hot_values) else np.ones(len(value), np.int64)
                salt = mix(uid[lo + owner]) % salts.astype(np.uint64)
                key = np.where(is_hot, mix(value ^ mix(salt)), value)
                columns = {
                    "doc": doc[lo + owner],
                    "uid": uid[lo + owner],
                    "start": first - words.first[owner],
                    "n": last - first + window,
                    "hot": is_hot,
                }
                s, e = words.starts[first], words.ends[last + window - 1] + 1
                held = [words.text[a:b] for a, b in zip(s.tolist(), e.tolist())]
                yield _message_batch(list(_dealt((key % np.uint64(parts)), columns, held)))

    def first_round(table: pa.Table) -> pa.Table:
        (uid, begin, stop), (value, columns, texts) = settle(table["blob"].to_pylist(), window)
        messages = list(_dealt(value % np.uint64(parts), columns, texts))
        none = [None] * len(messages)
        spans = [None] * len(uid)
        return pa.table(
            {
                "uid": pa.array([*uid.tolist(), *none], pa.int64()),
                "begin": pa.array([*begin.tolist(), *none], pa.int64()),
                "stop": pa.array([*stop.tolist(), *none], pa.int64()),
                "part": pa.array([*spans, *(p for p, _ in messages)], pa.int64()),
                "blob": pa.array([*spans, *(b for _, b in messages)], pa.binary()),
            }
        )

    def second_round(table: pa.Table) -> pa.Table:
        (uid, begin, stop), _ = settle(table["blob"].to_pylist(), window)
        return pa.table({"uid": uid, "begin": begin, "stop": stop})

    settled = cut_lineage(
        docs.mapInArrow(pack, "part long, blob binary")
        .groupBy("part")
        .applyInArrow(first_round, f"{_SPANS}, part long, blob binary")
    )
    rest = (
        settled.filter("part is not null")
        .select("part", "blob")
        .groupBy("part")
        .applyInArrow(second_round, _SPANS)
    )
    return settled.filter("uid is not null").select("uid", "begin", "stop").unionByName(rest)


def _without(text: pa.Array, spans: pa.Array) -> pa.Array:
    kept, n_words, n_removed = [], [], []
    for t, s in zip(as_bytes(text), spans.to_pylist()):
        words = split([t])
        n = len(words.starts)
        depth = np.zeros(n + 1, np.int64)
        for span in s or ():
            depth[span["begin"]] += 1
            depth[span["stop"]] -= 1
        stays = np.cumsum(depth)[:n] == 0
        # runs of words that stay, each as it lies in the text
        edges = np.flatnonzero(np.diff(np.concatenate([[0], stays.view(np.int8), [0]])))
        kept.append(
            b" ".join(
                words.text[words.starts[a] : words.ends[b - 1]]
                for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())
            ).decode()
        )
        n_words.append(n)
        n_removed.append(n - int(stays.sum()))
    return pa.StructArray.from_arrays(
        [pa.array(kept, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())],
        names=["kept", "n_words", "n_removed"],
    )


def _with_kept(docs: DataFrame, window: int, mini: int) -> DataFrame:
    spans = (
        repeated_spans(docs, window, mini)
        .groupBy("uid")
        .agg(F.collect_list(F.struct("begin", "stop")).alias("spans"))
    )
    without = F.arrow_udf(_without, "kept string, n_words long, n_removed long")
    # at most one row per uid on either side
    return docs.join(spans, "uid", "left").withColumn("out", without("text", "spans"))


def remove_repeats(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    mini: int = MINI,
) -> DataFrame:
    """One row per row of ``df``: ``uid``, id, ``kept`` text, ``n_words`` and ``n_removed``.

    A word is removed when it lies in a window whose words also start earlier: in a document with
    a smaller id, or before it in the same one; windows are judged on the input. Kept words are
    joined by one space. A null text has no words and is kept as an empty one. A null id comes
    after all others; rows that share an id come in the order of the rows. ``df`` is read once and
    stored with ``uid``, the row's place in that reading; other columns are ignored.
    """
    found = _with_kept(_numbered(df, id_col, text_col), window, mini)
    return found.select("uid", F.col("doc").alias(id_col), "out.kept", "out.n_words", "out.n_removed")


def with_kept_text(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    mini: int = MINI,
) -> DataFrame:
    """``df`` with each text replaced by what ``remove_repeats`` keeps of it."""
    others = [F.col(c) for c in df.columns if c != text_col]
    row = [F.struct(*others).alias("row")] if others else []
    found = _with_kept(_numbered(df, id_col, text_col, *row), window, mini)
    return found.select(
        *[
            F.col("out.kept").alias(c) if c == text_col else F.col("row").getField(c).alias(c)
            for c in df.columns
        ]
    )
