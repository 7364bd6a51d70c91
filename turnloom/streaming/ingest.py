"""Ingest response files as they arrive, each one once."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from turnloom.operators.joins import pending
from turnloom.plans.jobs import read_responses
from turnloom.sources.writers import write_rejects

# Files that one micro-batch takes at most, so that a backlog goes through in steps.
MAX_FILES = 1_000
LEDGER = "batch long, attempt string, stored long, rejected long"


def ingest_stream(
    spark: SparkSession,
    source: str,
    out: str,
    rejects: str,
    checkpoint: str,
    max_files: int = MAX_FILES,
) -> StreamingQuery:
    """Process all response files that are new since the last run, then stop.

    The checkpoint is the ledger of processed files; a micro-batch takes ``max_files`` of them at
    most. Each attempt at a batch writes folders of its own and enters itself in the ledger of
    finished batches (``finished_batches``) when both are whole, so what a broken attempt left
    and what a repeated one wrote again is not read by ``read_finished``. Good rows lie by
    language, the part of ``custom_id`` before the first ``_``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        attempt = f"a{uuid.uuid4().hex}"
        folder = f"batch={batch_id}/attempt={attempt}"
        stored, rejected = Observation(), Observation()
        rows = read_responses(batch).persist()
        try:
            good = rows.filter(F.col("status") != "error").drop("error", "content")
            language = F.split_part("custom_id", F.lit("_"), F.lit(1))
            (
                good.withColumn("language_code", language)
                .observe(stored, F.count(F.lit(1)).alias("rows"))
                .write.partitionBy("language_code")
                .json(f"{out}/{folder}")
            )
            bad = rows.filter(F.col("status") == "error")
            write_rejects(
                bad.observe(rejected, F.count(F.lit(1)).alias("rows")), f"{rejects}/{folder}", mode="error"
            )
        finally:
            rows.unpersist()
        entry = (batch_id, attempt, stored.get["rows"], rejected.get["rows"])
        batch.sparkSession.createDataFrame([entry], LEDGER).coalesce(1).write.mode("append").parquet(
            _ledger(out)
        )

    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(_ledger(out))
    lines = (
        spark.readStream.option("maxFilesPerTrigger", max_files).text(source).filter(F.trim("value") != "")
    )
    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _ledger(out: str) -> str:
    # file listings pass over names that begin so
    return f"{out}/_finished"


def finished_batches(spark: SparkSession, out: str) -> DataFrame:
    """One finished attempt per batch, with its numbers of stored and rejected rows."""
    entries = spark.read.schema(LEDGER).parquet(_ledger(out))
    return entries.groupBy("batch").agg(
        F.min_by(F.struct("attempt", "stored", "rejected"), "attempt").alias("first")
    ).select("batch", "first.*")


def read_finished(
    spark: SparkSession, out: str, schema: T.StructType | str, folder: str | None = None
) -> DataFrame:
    """The rows of finished batches, each batch once; ``folder`` is ``out`` or that of the rejects."""
    folder = folder or out
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    known = T.StructType([*schema.fields, *T.StructType.fromDDL("batch long, attempt string").fields])
    rows = spark.read.schema(known).option("basePath", folder).json(folder)
    # attempts are folders: only those in the ledger are read
    done = finished_batches(spark, out).select("batch", "attempt")
    return rows.join(done, ["batch", "attempt"], "left_semi").select(*schema.names)


def resume(work: DataFrame, done: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Continue where a run stopped: the rows without output, by key and not by count."""
    return pending(work, done, on)
