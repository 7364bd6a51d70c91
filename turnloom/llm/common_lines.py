"""Drop lines that many documents share.

Lines are exploded with their position and a hash of their normalised form; distinct documents are
counted per hash; lines over the threshold lose their places; what stays is put together by
position. Only hashes and positions move for the counts, and each text moves once, to meet the
positions it loses. It is all columns of Spark: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.operators.scale import cut_lineage, lookup_join

MIN_CHARS = 40
MIN_DOCUMENTS = 5
WHITE = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower_ascii(text: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def _two_hashes(*columns: Column) -> list[Column]:
    """128 bits, as two hashes with different seeds; never null."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)]


def _without(lines: Column, places: Column) -> Column:
    """``lines`` without those at the sorted ``places`` (from 0): the runs between them."""

    def run(i: Column) -> Column:
        begin = F.when(i == 0, F.lit(0)).otherwise(F.get(places, i - 1) + 1)
        end = F.coalesce(F.get(places, i), F.size(lines))
        return F.slice(lines, begin + 1, end - begin)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(places)), run))


def drop_common_lines(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """``id_col, kept, n_lines, n_dropped`` for each row.

    Texts are split at ``\\n``. A line's key is the line without white space at both ends, A-Z in
    lower case. Keys of ``min_chars`` code points or more that ``min_documents`` or more documents
    hold lose all their lines except in the largest id holding them. ``kept`` joins the other
    lines by ``\\n``; where all go, it is empty.

    A null or empty text is one empty line. Rows that share an id are one document, rows without
    an id are one document too, whose id is the smallest. Repeated rows each give a row. Other
    columns of ``df`` are not looked at. An empty table gives no rows.
    """
    docs = df.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    r1, r2 = _two_hashes(F.col("id"), F.col("text"))
    docs = docs.withColumns({"r1": r1, "r2": r2})
    key = F.btrim("line", F.lit(WHITE))
    h1, h2 = _two_hashes(key)
    lines = (
        docs.filter(F.octet_length("text") >= min_chars)
        .select("id", "r1", "r2", F.posexplode(F.split(_lower_ascii(F.col("text")), "\n")).alias("place", "line"))
        .filter((F.octet_length("line") >= min_chars) & (F.char_length(key) >= min_chars))
        .select("id", "r1", "r2", "place", h1.alias("h1"), h2.alias("h2"))
    )
    # Two steps, so that a line in a third of all documents is no group of as many rows.
    common = cut_lineage(
        lines.select("h1", "h2", "id")
        .distinct()
        .groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("documents"), F.max("id").alias("keeper"))
        .filter(F.col("documents") >= min_documents)
        .select("h1", "h2", "keeper")
    )
    places = (
        lookup_join(lines, common, ["h1", "h2"], "inner")
        .filter(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy("r1", "r2")
        .agg(F.sort_array(F.collect_set("place")).alias("places"))
    )
    split = F.split("text", "\n")
    dropped = F.coalesce(F.size("places"), F.lit(0))
    kept = F.when(
        F.col("places").isNull(), F.col("text")
    ).otherwise(F.array_join(_without(split, F.col("places")), "\n"))
    return lookup_join(docs, places, ["r1", "r2"]).select(
        F.col("id").alias(id_col),
        kept.alias("kept"),
        (F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)
        .cast("long")
        .alias("n_lines"),
        dropped.cast("long").alias("n_dropped"),
    )
