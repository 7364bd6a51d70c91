"""Schemas of the records the operators exchange."""

from __future__ import annotations

from pyspark.sql import types as T

TURN = T.StructType(
    [
        T.StructField("speaker", T.StringType()),
        T.StructField("utterance", T.StringType()),
        T.StructField("utterance_intended", T.StringType()),
        T.StructField("is_aac_user", T.BooleanType()),
    ]
)

GENERATION = T.StructType(
    [
        T.StructField("template_id", T.IntegerType()),
        T.StructField("lang_code", T.StringType()),
        T.StructField("generated_at", T.StringType()),
        T.StructField("provider", T.StringType()),
        T.StructField("model", T.StringType()),
    ]
)

# What a model is asked to answer with.
CONVERSATION = T.StructType(
    [
        T.StructField("template_id", T.IntegerType()),
        T.StructField("scene", T.StringType()),
        T.StructField("conversation", T.ArrayType(TURN)),
    ]
)

# What is kept on disk: the answer plus where it came from.
STORED_CONVERSATION = T.StructType(
    [*CONVERSATION.fields, T.StructField("metadata", GENERATION)]
)

TRIPLE = T.StructType(
    [
        T.StructField("head", T.StringType()),
        T.StructField("relation", T.StringType()),
        T.StructField("tail", T.StringType()),
    ]
)

MESSAGE = T.StructType(
    [T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]
)

REQUEST = T.StructType(
    [
        T.StructField("custom_id", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField(
            "body",
            T.StructType(
                [
                    T.StructField("model", T.StringType()),
                    T.StructField("messages", T.ArrayType(MESSAGE)),
                    T.StructField("temperature", T.DoubleType()),
                    T.StructField("max_tokens", T.IntegerType()),
                    T.StructField(
                        "response_format",
                        T.StructType([T.StructField("type", T.StringType())]),
                    ),
                ]
            ),
        ),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("file_id", T.StringType()),
        T.StructField("lang_code", T.StringType()),
        T.StructField("batch_file", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("completed_at", T.StringType()),
        T.StructField("result_file", T.StringType()),
        T.StructField("processed", T.BooleanType()),
    ]
)

LAYOUTS = ("qwerty", "abc", "frequency")

# Share of characters that get an edit, by severity.
ERROR_RATES = {"minimal": 0.05, "light": 0.15, "moderate": 0.25, "severe": 0.35}


def noisy_columns() -> list[str]:
    """The twelve noisy columns, severity by severity."""
    return [f"noisy_{layout}_{severity}" for severity in ERROR_RATES for layout in LAYOUTS]


# Column order of one flat example: 14 base columns, 12 noisy ones, 2 corrections.
FLAT_COLUMNS = [
    "conversation_id",
    "turn_number",
    "language_code",
    "template_id",
    "scene",
    "context_speakers",
    "context_utterances",
    "speaker",
    "utterance",
    "utterance_intended",
    "next_turn_speaker",
    "next_turn_utterance",
    "model",
    "provider",
    *noisy_columns(),
    "minimally_corrected",
    "fully_corrected",
]
