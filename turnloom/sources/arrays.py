"""JSON array files of any size, read by many tasks.

A file is cut at a separator, ``}`` or a comma, wherever it stands; the text source does that in
parts of a file like for lines. Whether a separator closes an element depends on all that comes
before: whether a string is open and how many brackets are. Each chunk knows how many quotes and
brackets it adds. For files of several blocks a first pass adds these up by block; running sums
over the few blocks of a file give the state each block is entered in. A second pass puts the
chunks of a block together to elements in the order they are read, where they are read. Only the
text at the edges of blocks, which may belong to an element that lies across them, is moved. No
file is a single value.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnloom.functions.response import allow_repeated_keys, strict_json
from turnloom.operators.scale import cut_lineage

# Executors need not have this package installed: the functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Characters of fragments handed back at a time; a longer fragment is handed back alone.
_CHARS = 4 << 20

NOT_AN_ARRAY = "not an array"


def _count(text: Column, *chars: str) -> Column:
    """How often any of the characters occurs."""
    kept = F.translate(text, "".join(chars), "")
    return (F.octet_length(text) - F.octet_length(kept)).cast("long")


def _depth(text: Column, start_quoted: bool) -> Column:
    """Opened less closed brackets outside of strings, for a text without escapes."""
    whole = F.concat(F.lit('"'), text) if start_quoted else text
    bare = F.regexp_replace(whole, r'"[^"]*+"?', "")
    return _count(bare, "[", "{") - _count(bare, "]", "}")


def pin_splits(spark: SparkSession) -> None:
    """Cut small inputs the same in every plan, however many executors there are by then."""
    name = "spark.sql.files.minPartitionNum"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(spark.sparkContext.defaultParallelism))


def _chunks(spark: SparkSession, path: str | list[str], separator: str, **options: str) -> DataFrame:
    """The files cut at the separator; ``_part`` says that a block is not the whole file."""
    start, length = F.col("_metadata.file_block_start"), F.col("_metadata.file_block_length")
    size = F.col("_metadata.file_size")
    # an escape never has the separator for its second character
    plain = F.regexp_replace("_text", r"(?s)\\.", "")
    return (
        spark.read.options(**options)
        .option("lineSep", separator)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("_path"),
            start.alias("_block"),
            size.alias("_bytes"),
            ((start > 0) | (start + length < size)).alias("_part"),
            F.col("value").alias("_text"),
        )
        .withColumn("_plain", plain)
        .withColumns(
            {
                "_quotes": _count(F.col("_plain"), '"'),
                "_depth0": _depth(F.col("_plain"), False),
                "_depth1": _depth(F.col("_plain"), True),
            }
        )
        .drop("_plain")
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """The slices of a batch that lie in one block, which its first two columns name."""
    paths, blocks = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
    change = (np.diff(paths.indices.to_numpy()) != 0) | (np.diff(blocks) != 0)
    cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield (paths[a].as_py(), int(blocks[a])), a, b


def _added(quoted: int, quotes: np.ndarray, depth0: np.ndarray, depth1: np.ndarray, closing: int):
    """Whether a string is open at the end of each chunk, entered in a string or not, and how many
    brackets the chunk with its separator, which closes ``closing`` of them, leaves open."""
    ends = (quoted + np.cumsum(quotes)) % 2
    before = np.concatenate(([quoted], ends[:-1]))
    return ends, np.where(before == 1, depth1, depth0) - np.where(ends == 0, closing, 0)


_SUMS = "_path string, _block long, _q long, _d0 long, _d1 long"


def _block_sums(closing: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What each block adds, entered outside of a string and inside."""
    names = ["_path", "_block", "_q", "_d0", "_d1"]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, q, below = None, 0, [0, 0]
        for batch in batches:
            done = []
            quotes, depth0, depth1 = (batch.column(i).to_numpy() for i in (2, 3, 4))
            for run, a, b in _runs(batch):
                if run != key:
                    if key is not None:
                        done.append((*key, q, *below))
                    key, q, below = run, 0, [0, 0]
                chunks = quotes[a:b], depth0[a:b], depth1[a:b]
                for entered in (0, 1):
                    below[entered] += int(_added((q + entered) % 2, *chunks, closing)[1].sum())
                q = (q + int(quotes[a:b].sum())) % 2
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*key, q, *below)], names)

    return sums


def _with_state(chunks: DataFrame, closing: int) -> DataFrame:
    """Add ``_quoted``, whether a string is open at the start of a chunk's block, and ``_level``,
    how many brackets are. A plan that cuts the files otherwise than the sums did fails."""
    sums = (
        chunks.filter("_part")
        .select("_path", "_block", "_quotes", "_depth0", "_depth1")
        .mapInArrow(_block_sums(closing), _SUMS)
        .groupBy("_path", "_block")
        .agg(*[F.first(c).alias(c) for c in ("_q", "_d0", "_d1")])
    )
    earlier = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sums.withColumn("_quoted", F.coalesce(F.sum("_q").over(earlier), F.lit(0)) % 2)
    adds = F.when(F.col("_quoted") == 1, F.col("_d1")).otherwise(F.col("_d0"))
    blocks = blocks.withColumn("_level", F.coalesce(F.sum(adds).over(earlier), F.lit(0)))
    # one row per block behind the first: broadcast, as the chunks must stay in their order
    entered = cut_lineage(blocks.filter("_block > 0").select("_path", "_block", "_quoted", "_level"))

    def known(name: str) -> Column:
        cut_anew = F.raise_error(F.lit("the files were cut anew since their blocks were summed"))
        return F.when(F.col("_block") == 0, F.lit(0)).otherwise(
            F.coalesce(F.col(name), cut_anew.cast("long"))
        )

    return chunks.join(F.broadcast(entered), ["_path", "_block"], "left").withColumns(
        {"_quoted": known("_quoted").cast("long"), "_level": known("_level").cast("long")}
    )


_FRAGMENT = (
    "_path string, _block long, _bytes long, _number long, _ended boolean, _final boolean, "
    "_edge boolean, _text string"
)


def _put_together(
    separator: str, closing: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The text up to each separator that ends an element, numbered within its block.

    What follows the last one is a fragment too. The last fragment of a block is ``_final``, and
    those that other blocks of the file may go on with are ``_edge``.
    """
    names = [c.split()[0] for c in _FRAGMENT.split(", ")]
    types = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    schema = pa.schema([(c.split()[0], types[c.split()[1]]) for c in _FRAGMENT.split(", ")])

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, quoted, level, number, size, part = None, 0, 0, 0, 0, False
        # an ended fragment waits until it is known whether it is the block's last one
        waiting: str | None = None
        pieces: list[str] = []
        rows: list[tuple] = []
        chars = 0

        def row(text: str, ended: bool, final: bool) -> None:
            nonlocal number, chars
            edge = part and (final or (number == 0 and key[1] > 0))
            rows.append((*key, size, number, ended, final, edge, text))
            chars += len(text)
            number += 1

        def close() -> None:
            nonlocal waiting
            if waiting is not None:
                row(waiting, True, not pieces)
            if pieces:
                row(separator.join(pieces), False, True)
            waiting = None
            pieces.clear()

        def full() -> pa.RecordBatch:
            nonlocal chars
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], names
            )
            rows.clear()
            chars = 0
            return batch

        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            numbers = [columns[n].to_numpy() for n in ("_quotes", "_depth0", "_depth1")]
            texts = columns["_text"].to_pylist()
            for run, a, b in _runs(batch):
                if run != key:
                    if key is not None:
                        close()
                    key, number = run, 0
                    quoted, level, size, part = (
                        columns[n][a].as_py() for n in ("_quoted", "_level", "_bytes", "_part")
                    )
                ends, adds = _added(quoted, *(x[a:b] for x in numbers), closing)
                levels = level + np.cumsum(adds)
                quoted, level = int(ends[-1]), int(levels[-1])
                start = a
                for stop in (np.flatnonzero((ends == 0) & (levels == 1)) + a + 1).tolist():
                    if waiting is not None:
                        row(waiting, True, False)
                    waiting = separator.join(pieces + texts[start:stop])
                    pieces.clear()
                    start = stop
                    if chars > _CHARS:
                        yield full()
                pieces += texts[start:b]
        if key is not None:
            close()
        if rows:
            yield full()

    return fragments


def _fragments(chunks: DataFrame, separator: str) -> DataFrame:
    """``_path, _block, _bytes, _number, _ended, _final, _edge, _text``: see ``_put_together``."""
    closing = 1 if separator == "}" else 0
    return (
        _with_state(chunks, closing)
        .select(
            "_path", "_block", "_bytes", "_part", "_quoted", "_level",
            "_quotes", "_depth0", "_depth1", "_text",
        )
        .mapInArrow(_put_together(separator, closing), _FRAGMENT)
    )


def _across(edges: DataFrame, separator: str) -> DataFrame:
    """``_path, _bytes, _first, _last, _text``: fragments at the edges of blocks, put together."""
    # a fragment that a block does not end goes on in the blocks behind it
    ends = edges.filter("_final").select(
        "_path", "_block", (F.col("_number") + F.col("_ended").cast("long")).alias("_done")
    )
    earlier = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = cut_lineage(
        ends.select("_path", "_block", F.coalesce(F.sum("_done").over(earlier), F.lit(0)).alias("_before"))
    )
    joined = (
        edges.join(before, ["_path", "_block"])
        .withColumn("_number", F.col("_number") + F.col("_before"))
        .groupBy("_path", "_bytes", "_number")
        .agg(
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("_block", "_text"))), lambda c: c["_text"]
                ),
                separator,
            ).alias("_text")
        )
    )
    last = F.max("_number").over(Window.partitionBy("_path"))
    return joined.select(
        "_path", "_bytes", (F.col("_number") == 0).alias("_first"),
        (F.col("_number") == last).alias("_last"), "_text",
    )


def _judged(fragments: DataFrame, separator: str, keep: Sequence[str] = ()) -> DataFrame:
    """``_path, _items, _bad, _other``: the elements, if any, that each fragment holds."""
    # separators gone from the end of a chunk: a fragment that ends at one gets its brace back
    brace = F.lit("}" if separator == "}" else "")
    text = F.btrim(
        F.when(F.col("_last"), F.col("_text")).otherwise(F.concat("_text", brace)), F.lit(" \t\n\r")
    )
    first = F.col("_first")
    opens = F.when(first, F.substring("_whole", 1, 1) == "[").otherwise(
        # behind a brace comes the comma; at a comma the text was cut
        (F.substring("_whole", 1, 1) == ",") if separator == "}" else F.lit(True)
    )
    stripped = F.when(
        first | F.lit(separator == "}"), F.substr("_whole", F.lit(2))
    ).otherwise(F.col("_whole"))
    shut = F.col("_whole").endswith("]")
    ended = fragments.withColumn("_whole", text).withColumn(
        "_closed_only", F.col("_last") & ~first & (F.col("_whole") == "]") & F.lit(separator == "}")
    )
    body = F.when(F.col("_last"), F.substr(stripped, F.lit(1), F.length(stripped) - 1)).otherwise(stripped)
    parsed = ended.withColumn(
        "_items",
        F.when(F.col("_closed_only"), F.parse_json(F.lit("[]"))).when(
            opens & (shut | ~F.col("_last")), strict_json(F.concat(F.lit("["), body, F.lit("]")))
        ),
    ).withColumn("_size", F.size(F.try_variant_get("_items", "$", "array<variant>")))
    # text that opens an array or element must hold one
    empty = ~F.col("_closed_only") & (F.col("_size") == 0) & ~(first & F.col("_last"))
    return parsed.select(
        "_path",
        "_items",
        (F.col("_items").isNull() | empty).alias("_bad"),
        (
            first
            & ~F.substring("_whole", 1, 1).isin("[", "")
            & (
                ~F.col("_last")
                # a last separator is not part of its chunk, but of the file
                | strict_json(
                    F.when(F.octet_length("_text") < F.col("_bytes"), F.concat("_whole", brace))
                    .otherwise(F.col("_whole"))
                ).isNotNull()
            )
        ).alias("_other"),
        *keep,
    )


def array_elements(
    spark: SparkSession, path: str | list[str], separator: str = "}", **options: str
) -> tuple[DataFrame, DataFrame]:
    """``(_path, _item)`` with a variant for each element of files that hold one array, and
    ``(_path, error)`` for the files that do not: ``invalid JSON`` or ``not an array``.

    The separator is ``}`` for arrays of objects and a comma for arrays of texts or numbers; the
    result is the same, but a text without any separator goes through one task as one value.
    No element of a faulty file is returned. ``[]`` has no elements; files without a byte are
    passed over, as Spark's readers do. The session keeps the way files are cut from then on, as
    they are read twice.
    """
    if separator not in ("}", ","):
        raise ValueError("the separator is } or a comma")
    allow_repeated_keys(spark)
    pin_splits(spark)
    edge = F.col("_edge")
    fragments = _fragments(_chunks(spark, path, separator, **options), separator).withColumns(
        {
            "_first": (F.col("_block") == 0) & (F.col("_number") == 0),
            "_last": F.col("_final"),
            "_at_edge": F.when(edge, F.col("_text")),
            "_text": F.when(~edge, F.col("_text")),
        }
    )
    place = ["_block", "_bytes", "_number", "_ended", "_final"]
    stored = cut_lineage(_judged(fragments, separator, keep=["_edge", "_at_edge", *place]))
    edges = stored.filter("_edge").select("_path", *place, F.col("_at_edge").alias("_text"))
    across = cut_lineage(_judged(_across(edges, separator), separator))
    parsed = stored.filter("not _edge").select(*across.columns).unionByName(across)
    files = parsed.groupBy("_path").agg(
        F.bool_or("_bad").alias("_bad"), F.bool_or("_other").alias("_other")
    )
    # stored, so that its size is known and the elements need not be moved to leave out a few files
    faults = cut_lineage(
        files.filter("_bad").select(
            "_path", F.when(F.col("_other"), F.lit(NOT_AN_ARRAY)).otherwise("invalid JSON").alias("error")
        )
    )
    good = parsed.join(faults.select("_path"), "_path", "left_anti")
    items = F.explode(F.try_variant_get("_items", "$", "array<variant>"))
    return good.select("_path", items.alias("_item")), faults
