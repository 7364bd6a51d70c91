"""Readers for the files a corpus is built from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnloom.functions.response import allow_repeated_keys, strict_json
from turnloom.schemas import TRIPLE
from turnloom.sources.arrays import NOT_AN_ARRAY, array_elements, pin_splits

_BAD = "_corrupt"
# A text of this size is still surely below Spark's limit of a variant.
MOST_BYTES = 64 << 20


def read_jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """One object per line; a bad line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_tolerant(
    spark: SparkSession, path: str | list[str], schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the text of bad lines with their file; blank lines are skipped."""
    allow_repeated_keys(spark)
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("value").alias("content"),
        F.try_variant_get(strict_json("value"), "$", schema.simpleString()).alias("_row"),
    )
    good = parsed.filter(F.col("_row").isNotNull()).select("_row.*")
    return good, parsed.filter(F.col("_row").isNull()).select("path", "content")


def _whole_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Small files as one value each; one that is larger than a value can be fails the read."""
    read = spark.read.text(path, wholetext=True)
    too_large = F.concat(F.lit("too large for one value: "), F.col("_metadata.file_path"))
    return read.select(
        F.col("_metadata.file_path").alias("_path"),
        F.when(F.octet_length("value") > MOST_BYTES, F.raise_error(too_large).cast("string"))
        .otherwise(F.col("value"))
        .alias("value"),
    )


def _typed(items: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """The elements as rows; one of another type is a row of nulls."""
    typed = F.try_variant_get("_item", "$", schema.simpleString())
    return items.select(*keep, typed.alias("_row")).select(*keep, "_row.*")


def _no_faults(faults: DataFrame, like: DataFrame) -> DataFrame:
    """No rows; a failure where there is a fault."""
    told = F.raise_error(F.concat(F.col("error"), F.lit(": "), F.col("_path")))
    return faults.select(
        *[told.cast(f.dataType).alias(f.name) if not i else F.lit(None).cast(f.dataType).alias(f.name)
          for i, f in enumerate(like.schema.fields)]
    )


def read_json_array(
    spark: SparkSession, path: str | list[str], schema: T.StructType, with_path: bool = False
) -> DataFrame:
    """Files that each hold one array, of any size; any other content fails the read."""
    items, faults = array_elements(spark, path)
    rows = _typed(items, schema, ["_path"] if with_path else [])
    return rows.unionByName(_no_faults(faults, rows))


def read_records(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Lines, an array, or an object with a ``data`` array, told apart file by file.

    A file is one of lines when its first line is an object of its own. Only the names of
    the files come to the driver, which lists them for the scan anyway; files of lines and
    arrays are then read in parts, and only objects are read whole.
    """
    text = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
        F.trim("value").alias("_text"),
    )
    first = text.groupBy("_path").agg(
        F.min_by("_text", F.struct("_block", "_line")).alias("_first")
    )
    is_lines = F.col("_first").startswith("{") & F.col("_first").endswith("}")
    shapes = first.select("_path", is_lines.alias("lines")).collect()
    by_line = [r["_path"] for r in shapes if r["lines"]]
    rest = [r["_path"] for r in shapes if not r["lines"]]
    out = spark.createDataFrame([], schema)
    if by_line:
        out = out.unionByName(read_jsonl(spark, by_line, schema))
    if rest:
        items, faults = array_elements(spark, rest)
        rows = _typed(items, schema)
        out = out.unionByName(rows)
        objects = [r["_path"] for r in faults.filter(F.col("error") == NOT_AN_ARRAY).collect()]
        out = out.unionByName(_no_faults(faults.filter(F.col("error") != NOT_AN_ARRAY), rows))
        if objects:
            parsed = _whole_files(spark, objects).withColumn("_json", F.parse_json("value"))
            data = F.try_variant_get("_json", "$.data", "variant")
            guard = F.raise_error(F.concat(F.lit("not a JSON array: "), F.col("_path")))
            array = F.when(F.schema_of_variant(data).startswith("ARRAY"), data).otherwise(
                F.parse_json(guard.cast("string"))
            )
            inner = F.explode(F.try_variant_get(array, "$", "array<variant>")).alias("_item")
            out = out.unionByName(_typed(parsed.select(inner), schema))
    return out


def read_triples(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Head, relation and tail of every three-field line, trimmed; other lines are dropped."""
    with_bad = T.StructType([*TRIPLE.fields, T.StructField(_BAD, T.StringType())])
    paths = [paths] if isinstance(paths, str) else _existing(spark, paths)
    options = {
        "sep": "\t",
        "quote": '"',
        "escape": '"',
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _BAD,
    }
    # parsed whole, so that a line is judged by all its fields whichever are selected later
    rows = (
        spark.read.text(paths)
        .filter(F.trim("value") != "")
        .select(F.from_csv("value", with_bad.toDDL(), options).alias("_row"))
        .select("_row.*")
    )
    trimmed = [
        F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"(?U)^\s+|\s+$", "").alias(c)
        for c in TRIPLE.names
    ]
    return rows.filter(F.col(_BAD).isNull()).select(*trimmed)


def _existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The paths that exist; a missing one is reported and left out."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    kept = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(conf).globStatus(p):
            kept.append(path)
        else:
            print(f"warning: {path} not found")
    return kept


def language_of(path: Column, lang_from: str = "name") -> Column:
    """Language of a file: its name from the last ``_`` to the dot, or its folder's name."""
    if lang_from == "name":
        stem = F.regexp_extract(path, r"(?:^|[_/])([^_/.]*)(?:\.[^_/]*)?$", 1)
        return F.when(stem != "", stem).otherwise("unknown")
    return F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)


def read_corpus(
    spark: SparkSession, glob: str, schema: T.StructType, lang_from: str = "name"
) -> DataFrame:
    """Conversations of all matching files with their language and their place.

    A bad line fails the read.

    ``_file``, ``_block`` and ``_line`` order the rows as in the files: blocks of a large
    file are read apart, ``_length`` bytes each, and lines count within a block. The session
    keeps the way files are cut from then on, so that later plans number the lines alike.
    """
    pin_splits(spark)
    rows = (
        spark.read.schema(schema)
        .option("mode", "FAILFAST")
        .json(glob)
        .select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.col("_metadata.file_block_length").alias("_length"),
            F.monotonically_increasing_id().alias("_line"),
        )
        .withColumn("language_code", language_of(F.col("_file"), lang_from))
    )
    if lang_from == "parent":
        rows = rows.filter(
            ~F.col("language_code").startswith(".")
            & (F.col("language_code") != "language_generation")
        )
    return rows


def load_splits(spark: SparkSession, path: str) -> DataFrame:
    """A dataset with ``train`` and ``test`` parts, labelled; else the dataset as it is."""
    parts = [f"{path}/split={s}" for s in ("train", "test")]
    plain = [f"{path}/{s}" for s in ("train", "test")]
    for names in (parts, plain):
        if len(_existing_quietly(spark, names)) == 2:
            train, test = (
                spark.read.parquet(p).withColumn("split", F.lit(s))
                for p, s in zip(names, ("train", "test"))
            )
            return train.unionByName(test, allowMissingColumns=True)
    return spark.read.parquet(path)


def _existing_quietly(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(conf).exists(p):
            out.append(path)
    return out


def load_templates(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(lang_code, template_id, template)`` from a bare list, ``templates`` or ``json``."""
    parsed = _whole_files(spark, path).withColumn("_json", F.try_parse_json("value"))
    lists = F.coalesce(
        F.try_variant_get("_json", "$", "array<string>"),
        F.try_variant_get("_json", "$.templates", "array<string>"),
        F.try_variant_get("_json", "$.json", "array<string>"),
        F.array().cast("array<string>"),
    )
    return parsed.select(
        F.regexp_extract("_path", r"([^/]+)\.[^./]*$", 1).alias("lang_code"),
        F.posexplode(lists).alias("template_id", "template"),
    )


def load_substitutions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(lang_code, key, pos, value)`` from ``{key: [values]}`` files."""
    parsed = _whole_files(spark, path).withColumn("_json", F.try_parse_json("value"))
    entries = F.try_variant_get("_json", "$", "map<string, array<string>>")
    return parsed.select(
        F.regexp_extract("_path", r"([^/]+)\.[^./]*$", 1).alias("lang_code"),
        F.explode(entries).alias("key", "values"),
    ).select("lang_code", "key", F.posexplode("values").alias("pos", "value"))


def list_files(spark: SparkSession, path: str | list[str], pattern: str = "*") -> DataFrame:
    """``(path, modified, size)`` of the files below a folder, without their content."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))
    )
