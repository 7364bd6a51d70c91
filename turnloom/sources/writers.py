"""Writers for corpora, rejects, datasets and reports."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnloom.functions.response import allow_repeated_keys, strict_json
from turnloom.sources.arrays import array_elements

_NESTED = (T.ArrayType, T.MapType, T.StructType)


def write_jsonl(df: DataFrame, path: str, keep_nulls: bool = False, mode: str = "error") -> None:
    """One object per line in UTF-8; null fields are left out unless kept."""
    df.write.mode(mode).option("ignoreNullFields", str(not keep_nulls).lower()).json(path)


def append_by_language(df: DataFrame, path: str) -> None:
    """Append each row under its language: the part of ``custom_id`` before the first ``_``."""
    if "language_code" not in df.columns:
        df = df.withColumn("language_code", F.split_part("custom_id", F.lit("_"), F.lit(1)))
    df.write.mode("append").partitionBy("language_code").json(path)


def write_rejects(bad: DataFrame, path: str, mode: str = "append") -> None:
    """Id, custom id, error and whole content of every rejected row."""
    columns = [
        (F.col(c) if c in bad.columns else F.lit(None).cast("string").alias(c))
        for c in ("id", "custom_id", "error", "content")
    ]
    bad.select(*columns).write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_csv_flat(
    df: DataFrame, path: str, columns: Sequence[str] | None = None, mode: str = "error"
) -> None:
    """CSV with a header; nested values as JSON text, missing ones empty."""
    flat = [
        F.to_json(c).alias(c) if isinstance(df.schema[c].dataType, _NESTED) else F.col(c)
        for c in (columns or df.columns)
    ]
    (
        df.select(*flat)
        .write.mode(mode)
        .option("header", "true")
        .option("escape", '"')
        .option("emptyValue", "")
        .csv(path)
    )


def jsonl_to_csv(spark: SparkSession, src: str, dst: str) -> None:
    """Convert JSON lines: the first record's keys make the header, bad lines are skipped.

    The first record is that of the first file by name. A line counts only as one whole object.
    """
    allow_repeated_keys(spark)
    lines = spark.read.text(src).filter(F.trim("value") != "")
    place = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start")]
    first = lines.orderBy(*place, F.monotonically_increasing_id()).select("value").first()
    if first is None:
        return
    keys = spark.range(1).select(F.json_object_keys(F.lit(first["value"]))).first()[0]
    if keys is None:
        raise ValueError("the first line is not a JSON object")
    row = F.try_variant_get(strict_json("value"), "$", "map<string, variant>")
    cells = []
    for key in dict.fromkeys(keys):
        cell = F.try_element_at("_row", F.lit(key))
        text = F.when(F.schema_of_variant(cell) == "STRING", cell.cast("string"))
        null = F.schema_of_variant(cell) == "VOID"
        cells.append(F.when(~null, F.coalesce(text, F.to_json(cell))).alias(key))
    rows = lines.select(row.alias("_row")).filter(F.col("_row").isNotNull()).select(*cells)
    write_csv_flat(rows, dst)


def write_dataset(df: DataFrame, path: str, mode: str = "error") -> None:
    """Each split to its own folder in Parquet, and a CSV copy beside it."""
    df.write.mode(mode).partitionBy("split").parquet(path)
    write_csv_flat(df, f"{path}_csv", mode=mode)


def convert_tree(
    spark: SparkSession, src: str, dst: str, schema: T.StructType, pattern: str = "*.json"
) -> DataFrame:
    """Rewrite every array file below ``src`` as lines below ``dst``, in the same folders.

    ``sub/a.json`` becomes the folder ``sub/a`` with the lines in one or more parts. The lines
    are written beside first, one folder per file, and each folder is then put in its place.
    Returns the files that hold no array, with the reason.
    """
    items, faults = array_elements(
        spark, src, recursiveFileLookup="true", pathGlobFilter=pattern
    )
    root = F.regexp_replace(F.lit(src), r"^[a-z]+:/*|/+$", "")
    # names of files come escaped
    named = F.url_decode(F.replace("_path", F.lit("+"), F.lit("%2B")))
    below = F.regexp_replace(
        F.substr(named, F.instr(named, root) + F.length(root)), r"^/+|\.[^./]*$", ""
    )
    row = F.try_variant_get("_item", "$", schema.simpleString())
    beside = f"{dst.rstrip('/')}/_beside-{uuid.uuid4().hex}"
    (
        items.select(below.alias("_file"), row.alias("row"))
        .select("_file", "row.*")
        .write.partitionBy("_file")
        .json(beside)
    )
    _put_in_place(spark, beside, dst)
    return faults.select(F.col("_path").alias("path"), "error")


def _put_in_place(spark: SparkSession, beside: str, dst: str) -> None:
    """Each ``_file=…`` folder to the relative path it names."""
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    top = path_of(beside)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(top):
        name = status.getPath().getName()
        if name.startswith("_file="):
            place = path_of(f"{dst.rstrip('/')}/{unquote(name.removeprefix('_file='))}")
            fs.mkdirs(place.getParent())
            if not fs.rename(status.getPath(), place):
                raise OSError(f"{place} is there already")
    fs.delete(top, True)


def write_stats(stats: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The formatted report as CSV and as a Markdown table with notes.

    One row per language, so one file is enough.
    """
    stats.coalesce(1).write.mode(mode).option("header", "true").csv(f"{path}/csv")
    spark = stats.sparkSession
    head = ["# Corpus statistics", "", "| " + " | ".join(stats.columns) + " |"]
    head.append("|" + "|".join("---" for _ in stats.columns) + "|")
    # The notes below the table.
    notes = [
        "",
        "## Notes",
        "",
        "- **MLU**: Mean Length of Utterance (average number of words per utterance)",
        "- **AAC Utterances**: Utterances from AAC users",
        "- **Non-AAC Utterances**: Utterances from communication partners",
    ]

    def block(place: int, lines: list[str]) -> DataFrame:
        rows = [(place, i, line) for i, line in enumerate(lines)]
        return spark.createDataFrame(rows, "part int, pos long, value string")

    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in stats.columns]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    is_total = F.col(f"`{stats.columns[0]}`") == "TOTAL"
    body = stats.select(
        F.when(is_total, 2).otherwise(1).alias("part"),
        F.lit(0).cast("long").alias("pos"),
        line.alias("value"),
    )
    table = block(0, head).unionByName(body).unionByName(block(3, notes))
    ordered = table.orderBy("part", "pos", "value").select("value")
    ordered.coalesce(1).write.mode(mode).text(f"{path}/markdown")


