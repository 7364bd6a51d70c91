"""The tables through the writers and back through the readers.

Files lie below the session's shared folder, each run in a folder of its own.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.registry import query
from checks.views import envelopes, table, triples, turns, with_views
from turnloom.operators.sampling import split_exact
from turnloom.operators.scale import shared_folder
from turnloom.operators.stats import source_summary
from turnloom.operators.turns import assign_in_file_order
from turnloom.schemas import CONVERSATION
from turnloom.sources import readers, writers
from turnloom.streaming.ingest import ingest_stream, read_finished

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("lang", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/turnloom-files-{uuid.uuid4().hex}"


def _documents(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang", "text")


@query("SELECT doc_id, lang, text FROM documents")
def jsonl_round_trip(spark, d):
    path = _folder(spark)
    writers.write_jsonl(_documents(spark, d), path)
    return readers.read_jsonl(spark, path, DOCUMENT)


@query(
    """SELECT doc_id, lang, text, NULL AS content FROM documents WHERE lang <> 'es'
    UNION ALL SELECT NULL, NULL, NULL, '{"doc_id":' || doc_id FROM documents WHERE lang = 'es'"""
)
def tolerant_jsonl(spark, d):
    """Spanish documents are written as broken lines."""
    path = _folder(spark)
    whole = F.to_json(F.struct("doc_id", "lang", "text"))
    broken = F.concat(F.lit('{"doc_id":'), F.col("doc_id").cast("string"))
    lines = _documents(spark, d).select(F.when(F.col("lang") == "es", broken).otherwise(whole))
    lines.write.text(path)
    good, bad = readers.read_jsonl_tolerant(spark, path, DOCUMENT)
    return good.unionByName(bad.select("content"), allowMissingColumns=True)


@query(with_views("triples") + "SELECT head, relation, tail FROM triples WHERE relation <> 'LARGE'")
def triples_round_trip(spark, d):
    """Triples of one relation are written with a fourth field, which drops them."""
    path = _folder(spark)
    more = F.when(F.col("relation") == "LARGE", F.lit("more"))
    lines = triples(spark, d).select(
        F.concat_ws("\t", "head", "relation", F.concat("tail", F.lit(" ")), more)
    )
    lines.write.text(path)
    return readers.read_triples(spark, [path])


@query("SELECT lang AS language_code, lang || '_' || doc_id AS custom_id, text FROM documents")
def append_by_language(spark, d):
    path = _folder(spark)
    rows = _documents(spark, d).select(
        F.concat_ws("_", "lang", F.col("doc_id").cast("string")).alias("custom_id"), "text"
    )
    first = F.col("custom_id") < "en_5"
    writers.append_by_language(rows.filter(first), path)
    writers.append_by_language(rows.filter(~first), path)
    schema = "custom_id string, text string, language_code string"
    return spark.read.schema(schema).json(path).select("language_code", "custom_id", "text")


@query(
    """SELECT doc_id, lang, CASE WHEN row_number() OVER (ORDER BY md5(doc_id || '|0'))
    <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM documents"""
)
def dataset_round_trip(spark, d):
    path = _folder(spark)
    docs = table(spark, d, "documents").select("doc_id", "lang")
    writers.write_dataset(split_exact(docs, ["doc_id"]), path)
    return readers.load_splits(spark, path).select("doc_id", "lang", "split")


@query("SELECT count(*) AS records FROM documents")
def source_records(spark, d):
    path = _folder(spark)
    writers.write_jsonl(_documents(spark, d), path)
    summary = source_summary(spark.read.schema(DOCUMENT).json(path))
    return summary.filter(F.col("size_kb") > 0).agg(F.sum("records").alias("records"))


@query(
    with_views("nested")
    + """SELECT 'c' AS language_code, custom_id, CASE WHEN n IN (2, 3) THEN 'recovered'
    ELSE 'ok' END AS status, 'scene ' || conversation_id AS scene FROM nested WHERE n <> 4
    GROUP BY custom_id, n, conversation_id"""
)
def streamed_responses(spark, d):
    """Response files through the stream in two runs; a third finds nothing new."""
    path = _folder(spark)
    lines = envelopes(spark, d).select("value")
    early = F.col("value").contains("scene 1")

    def run():
        query_ = ingest_stream(
            spark, f"{path}/in", f"{path}/out", f"{path}/rejects", f"{path}/checkpoint"
        )
        query_.awaitTermination()

    lines.filter(early).write.mode("append").text(f"{path}/in")
    run()
    lines.filter(~early).write.mode("append").text(f"{path}/in")
    run()
    run()
    schema = "custom_id string, status string, scene string, language_code string"
    return read_finished(spark, f"{path}/out", schema).select(
        "language_code", "custom_id", "status", "scene"
    )


def _array_files(spark, d, path: str) -> None:
    """Documents as arrays, one file per source, the elements in several lines.

    One task writes a file, line by line; no file is a single value.
    """
    element = F.to_json(F.struct("doc_id", "lang", "text"))
    spaced = F.concat(F.lit("  "), F.replace(element, F.lit(',"lang"'), F.lit(',\n   "lang"')))
    folder = F.coalesce(F.nullif("source", F.lit("")), F.lit("__HIVE_DEFAULT_PARTITION__"))
    (
        table(spark, d, "documents")
        .select(folder.alias("source"), spaced.alias("value"))
        .repartition("source")
        .mapInArrow(_in_brackets(), "source string, place long, value string")
        .select(F.coalesce("source", F.lit("")).alias("source"), "place", "value")
        .sortWithinPartitions("source", "place")
        .select("source", "value")
        .write.partitionBy("source")
        .text(path)
    )


def _in_brackets():
    """Lines of one array per source: a comma behind every element but the last."""

    def lines(batches):
        last, places = {}, {}
        for batch in batches:
            out = []
            for source, value in zip(*(column.to_pylist() for column in batch.columns)):
                place = places[source] = places.get(source, 0) + 1
                out.append((source, place, f"{last[source]}," if source in last else "["))
                last[source] = value
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["source", "place", "value"])
        for source, value in last.items():
            ends = [(source, places[source] + 1, value), (source, places[source] + 2, "]")]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*ends)], ["source", "place", "value"])

    return lines


@query("SELECT doc_id, lang, text FROM documents")
def json_array(spark, d):
    path = _folder(spark)
    _array_files(spark, d, path)
    return readers.read_json_array(spark, f"{path}/*", DOCUMENT)


@query("SELECT doc_id, lang, text FROM documents UNION ALL SELECT doc_id, lang, NULL FROM documents")
def any_records(spark, d):
    """Arrays, and lines beside them."""
    path = _folder(spark)
    _array_files(spark, d, f"{path}/arrays")
    writers.write_jsonl(_documents(spark, d).select("doc_id", "lang"), f"{path}/lines")
    return readers.read_records(spark, [f"{path}/arrays/*", f"{path}/lines"], DOCUMENT)


@query("SELECT source AS folder, doc_id, lang, text FROM documents")
def tree(spark, d):
    """Array files below folders become lines in folders of the same names."""
    path = _folder(spark)
    _array_files(spark, d, f"{path}/in")
    faults = writers.convert_tree(spark, f"{path}/in", f"{path}/out", DOCUMENT, "*.txt")
    wrong = faults.select(F.col("error").alias("folder"))
    folder = F.regexp_extract("_metadata.file_path", r"source=([^/]+)/part[^/]*/[^/]+$", 1)
    rows = (
        spark.read.schema(DOCUMENT)
        .option("recursiveFileLookup", "true")
        .json(f"{path}/out")
        .select(folder.alias("folder"), "doc_id", "lang", "text")
    )
    return rows.unionByName(wrong, allowMissingColumns=True)


@query(
    with_views("turns")
    + """SELECT coalesce(language_code, '__HIVE_DEFAULT_PARTITION__') AS folder, conversation_id AS conv_id,
    'aac_' || row_number() OVER (PARTITION BY language_code ORDER BY conversation_id) AS number FROM (
    SELECT DISTINCT conversation_id, language_code FROM turns WHERE language_code IS NOT NULL)"""
)
def file_order_ids(spark, d):
    """Conversations in files by language, numbered by their place in them."""
    path = _folder(spark)
    ids = turns(spark, d, language=True).select("conversation_id", "language_code").distinct()
    ids = ids.filter("language_code is not null")
    scenes = ids.select("language_code", F.struct(F.col("conversation_id").cast("string").alias("scene")).alias("c"))
    # one file per language, in the order of the ids
    (
        scenes.repartition("language_code")
        .sortWithinPartitions("language_code", F.col("c.scene").cast("long"))
        .select("language_code", "c.scene")
        .write.partitionBy("language_code")
        .json(path)
    )
    corpus = readers.read_corpus(spark, f"{path}/*/*", CONVERSATION, lang_from="parent")
    numbered = assign_in_file_order(corpus)
    return numbered.select(
        F.regexp_extract("language_code", "=(.*)", 1).alias("folder"),
        F.col("scene").cast("long").alias("conv_id"),
        F.concat(F.lit("aac_"), F.regexp_extract("conversation_id", "_([0-9]+)$", 1)).alias("number"),
    )
