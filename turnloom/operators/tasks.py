"""Input and target pairs that users of the finished examples train on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.operators.stats import unpivot_noise

KEY = ("conversation_id", "turn_number")


def correction_pairs(df: DataFrame, target: str = "fully_corrected") -> DataFrame:
    """Every noisy variant with its correction."""
    return unpivot_noise(df, [*KEY, target]).select(
        *KEY, "layout", "severity", "noisy", F.col(target).alias("target")
    )


def expansion_pairs(df: DataFrame) -> DataFrame:
    """Telegraphic text with the intended text."""
    return df.select(
        *KEY, F.col("utterance").alias("telegraphic"), F.col("utterance_intended").alias("expanded")
    )


def response_pairs(df: DataFrame) -> DataFrame:
    """Context and utterance with the next turn, where there is one."""
    said = F.transform(
        F.arrays_zip("context_speakers", "context_utterances"),
        lambda t: F.concat_ws(": ", t["context_speakers"], t["context_utterances"]),
    )
    return df.filter(F.col("next_turn_utterance") != "").select(
        *KEY,
        F.array_join(said, "\n").alias("context"),
        "utterance",
        F.concat_ws(": ", "next_turn_speaker", "next_turn_utterance").alias("response"),
    )
