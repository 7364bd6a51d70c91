"""Counting and reporting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions.text import as_column, token_estimate, word_count
from turnloom.schemas import ERROR_RATES, LAYOUTS, noisy_columns

COUNTS = (
    "num_conversations",
    "total_turns",
    "aac_utterances",
    "non_aac_utterances",
    "aac_word_count",
    "non_aac_word_count",
)

# Headings of the report.
HEADINGS = {
    "language_code": "Language",
    "num_conversations": "Conversations",
    "total_turns": "Total Turns",
    "aac_utterances": "AAC Utterances",
    "non_aac_utterances": "Non-AAC Utterances",
    "aac_word_count": "AAC Words",
    "non_aac_word_count": "Non-AAC Words",
    "avg_conversation_length": "Avg Turns/Conv",
    "aac_mlu": "AAC MLU",
    "non_aac_mlu": "Non-AAC MLU",
}


def _ratio(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def _with_ratios(counts: DataFrame) -> DataFrame:
    return (
        counts.withColumn("avg_conversation_length", _ratio("total_turns", "num_conversations"))
        .withColumn("aac_mlu", _ratio("aac_word_count", "aac_utterances"))
        .withColumn("non_aac_mlu", _ratio("non_aac_word_count", "non_aac_utterances"))
    )


def corpus_stats(
    turns: DataFrame, by: str = "language_code", aac: Column | str = "is_aac_user"
) -> DataFrame:
    """Counts per language and the three ratios taken from them.

    ``aac`` says which turns are the AAC user's: the flag, or ``is_aac_speaker`` of the
    speaker's name. Rows are first summed per conversation, so that neither a large
    language nor a large conversation reaches one task as rows.
    """
    is_aac = F.coalesce(as_column(aac), F.lit(False))
    words = word_count("utterance")
    per_conversation = turns.groupBy(by, "conversation_id").agg(
        F.count(F.lit(1)).alias("total_turns"),
        F.count_if(is_aac).alias("aac_utterances"),
        F.count_if(~is_aac).alias("non_aac_utterances"),
        F.sum(F.when(is_aac, words).otherwise(0)).alias("aac_word_count"),
        F.sum(F.when(~is_aac, words).otherwise(0)).alias("non_aac_word_count"),
    )
    counts = per_conversation.groupBy(by).agg(
        F.count(F.lit(1)).alias("num_conversations"),
        *[F.sum(c).alias(c) for c in COUNTS if c != "num_conversations"],
    )
    return _with_ratios(counts)


def with_total(stats: DataFrame, by: str = "language_code") -> DataFrame:
    """Add a ``TOTAL`` row at the end; its ratios come from the summed counts."""
    summed = stats.rollup(by).agg(
        F.grouping(by).alias("_is_total"), *[F.sum(c).alias(c) for c in COUNTS]
    )
    named = summed.withColumn(
        by, F.when(F.col("_is_total") == 1, F.lit("TOTAL")).otherwise(F.col(by))
    )
    return _with_ratios(named).orderBy("_is_total", by).drop("_is_total")


def format_stats(stats: DataFrame) -> DataFrame:
    """Two decimals on the ratios and the report's headings."""
    for c in ("avg_conversation_length", "aac_mlu", "non_aac_mlu"):
        stats = stats.withColumn(c, F.round(c, 2))
    return stats.withColumnsRenamed(HEADINGS)


def conversation_lengths(turns: DataFrame) -> DataFrame:
    return turns.groupBy("conversation_id").agg(F.count(F.lit(1)).alias("turns"))


def length_distribution(turns: DataFrame) -> DataFrame:
    """How many conversations have how many turns."""
    return conversation_lengths(turns).groupBy("turns").agg(
        F.count(F.lit(1)).alias("conversations")
    )


def augmentation_counts(df: DataFrame, noisy: str | None = None) -> DataFrame:
    """Conversations written and turns augmented."""
    noisy = noisy or noisy_columns()[0]
    per_conversation = df.groupBy("conversation_id").agg(
        F.count_if(F.col(noisy).isNotNull()).alias("turns")
    )
    return per_conversation.agg(
        F.count(F.lit(1)).alias("conversations"),
        F.coalesce(F.sum("turns"), F.lit(0)).alias("augmented_turns"),
    )


def outcome_counts(df: DataFrame, status: str = "status") -> DataFrame:
    """Rows per processing outcome."""
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("rows"))


def coverage(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Per field, how many rows have ``{field}_found``, of how many, in percent."""
    totals = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(f"{f}_found")).alias(f) for f in fields],
    )
    rows = totals.unpivot(["total"], list(fields), "field", "matched")
    share = F.when(F.col("total") > 0, F.col("matched") / F.col("total") * 100).otherwise(0.0)
    return rows.select("field", "matched", "total", F.round(share, 1).alias("percent"))


def token_totals(
    chunks: DataFrame, column: str, limit: int, by: Sequence[str] = (), overhead: int = 0
) -> DataFrame:
    """Estimated tokens per group, and whether they pass 80 % and 90 % of a limit."""
    tokens = chunks.groupBy(*by).agg(
        F.sum(token_estimate(column, overhead)).alias("tokens"), F.count(F.lit(1)).alias("rows")
    )
    return tokens.withColumn("over_80", F.col("tokens") > limit * 0.8).withColumn(
        "over_90", F.col("tokens") > limit * 0.9
    )


def unpivot_noise(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per noisy variant: layout, severity, noisy text."""
    variants = [
        F.struct(F.lit(l).alias("layout"), F.lit(s).alias("severity"),
                 F.col(f"noisy_{l}_{s}").alias("noisy"))
        for s in ERROR_RATES
        for l in LAYOUTS
        if f"noisy_{l}_{s}" in df.columns
    ]
    return df.select(*keep, F.inline(F.array(*variants))).filter(F.col("noisy").isNotNull())


def noise_report(df: DataFrame, text: str = "utterance", distance: bool = True) -> DataFrame:
    """Per layout and severity: texts, share that differ, mean edit distance and % changed."""
    rows = unpivot_noise(df, [text])
    measures = [
        F.count(F.lit(1)).alias("texts"),
        F.avg((F.col("noisy") != F.col(text)).cast("int")).alias("differs_rate"),
    ]
    if distance:
        edits = F.levenshtein(F.col(text), F.col("noisy"))
        measures += [
            F.avg(edits).alias("mean_distance"),
            F.avg(F.when(F.length(text) > 0, edits / F.length(text) * 100)).alias("mean_changed"),
        ]
    return rows.groupBy("layout", "severity").agg(*measures)


def distance_by_length(df: DataFrame, text: str, noisy: str, rate: Column) -> DataFrame:
    """Mean edit distance and % changed per text length and rate."""
    edits = F.levenshtein(F.col(text), F.col(noisy))
    return df.groupBy(F.length(text).alias("length"), rate.alias("rate")).agg(
        F.avg(edits).alias("distance"), F.avg(edits / F.length(text) * 100).alias("changed")
    )


def run_summary(results: DataFrame, requests: int) -> DataFrame:
    """Languages that succeeded and failed, requests made and seconds spent."""
    return results.agg(
        F.count_if("success").alias("succeeded"),
        F.count_if(~F.col("success")).alias("failed"),
        F.sum(F.when(F.col("success"), F.lit(requests)).otherwise(0)).alias("total_requests"),
        F.round(F.sum("seconds"), 2).alias("seconds"),
    )


def source_summary(df: DataFrame) -> DataFrame:
    """Records and size in KB of every file a scan has read."""
    return df.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count(F.lit(1)).alias("records"),
        F.round(F.max("_metadata.file_size") / 1024, 1).alias("size_kb"),
    )


def char_frequency(df: DataFrame, column: str) -> DataFrame:
    """Characters by descending frequency: the order a layout can be built from."""
    chars = df.select(F.explode(F.split(F.col(column), "")).alias("char"))
    return (
        chars.filter(F.col("char") != "")
        .groupBy("char")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "char")
    )
