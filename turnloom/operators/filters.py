"""Row filters and row-wise rewrites."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions.prompts import prompt_of
from turnloom.operators.scale import first_rows

# Relations kept by default.
RELATIONS = (
    "xNeed",
    "xIntent",
    "xEffect",
    "xReact",
    "oEffect",
    "oReact",
    "isAfter",
    "isBefore",
    "HinderedBy",
)

# Words of which a head must contain at least one.
# fmt: off
KEYWORDS = (
    "eat", "drink", "pain", "sleep", "help", "talk", "communicate", "call", "move", "comfort",
    "care", "rest", "doctor", "nurse", "hospital", "medicine", "treatment", "support", "assist",
    "feel", "need", "want", "ask", "tell", "say", "speak", "listen", "hear", "see", "look",
    "watch", "read", "write", "type", "text", "message", "email", "phone", "call", "visit",
    "meet", "greet", "thank", "apologize", "complain", "request", "order", "buy", "pay",
    "spend", "save", "work", "play", "relax", "rest", "sleep", "wake", "dress", "undress",
    "wash", "clean", "cook", "bake", "prepare", "serve", "share", "give", "take", "receive",
    "accept", "reject", "refuse", "agree", "disagree", "argue", "fight", "make up", "forgive",
    "forget", "remember", "think", "believe", "know", "understand", "learn", "teach", "study",
    "practice", "improve", "succeed", "fail", "try", "attempt", "start", "stop", "continue",
    "finish", "complete", "begin", "end",
)
# fmt: on


def filter_relations(df: DataFrame, allowed: Sequence[str] = RELATIONS) -> DataFrame:
    return df.filter(F.col("relation").isin(*allowed))


def filter_keywords(
    df: DataFrame, column: str = "head", keywords: Sequence[str] = KEYWORDS
) -> DataFrame:
    """Rows whose lower-cased text contains a keyword anywhere, also inside a word.

    A keyword that contains another one adds nothing and is left out of the plan.
    """
    distinct = sorted(set(keywords))
    needed = [k for k in distinct if not any(o != k and o in k for o in distinct)]
    text = F.lower(F.col(column))
    hits = [F.contains(text, F.lit(k)) for k in needed]
    return df.filter(reduce(Column.__or__, hits, F.lit(False)))


def drop_none_tail(df: DataFrame, column: str = "tail") -> DataFrame:
    return df.filter(F.lower(F.col(column)) != "none")


def to_entries(
    df: DataFrame,
    user: str = "Alex",
    partner: str = "Taylor",
    role: str = "person with ALS",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Triples as topic entries with the people's names and role."""
    return df.select(
        *keep,
        F.col("head").alias("topic"),
        "relation",
        F.lit(user).alias("aac_user"),
        F.lit(partner).alias("partner"),
        F.lit(role).alias("aac_user_role"),
        F.col("tail").alias("which"),
    )


def limit_entries(df: DataFrame, n: int | None, order: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in input order; 0 or None keeps all.

    Rows that ``order`` leaves equal follow their other columns, so the choice among them is
    the same in every run; of rows that are equal in all columns as many stay as there is room
    for. The last row that stays is found by counting, and no row is sorted or moved.
    """
    return first_rows(df, n, order) if n else df


def aac_turns(turns: DataFrame) -> DataFrame:
    """Turns of the AAC user; a missing flag counts as false."""
    return turns.filter(F.coalesce(F.col("is_aac_user"), F.lit(False)))


def by_language(df: DataFrame, code: str | None = None, prefix: str | None = None) -> DataFrame:
    if code is not None:
        df = df.filter(F.col("language_code") == code)
    if prefix is not None:
        df = df.filter(F.col("language_code").startswith(prefix))
    return df


def by_generator(df: DataFrame, provider: str, model: str | None = None) -> DataFrame:
    df = df.filter(F.col("provider") == provider)
    return df if model is None else df.filter(F.col("model") == model)


def eligible_locales(
    df: DataFrame, skip_english: bool = True, unsupported: Sequence[str] = ("fo-FO",)
) -> DataFrame:
    """Locales that can be translated into: with a region, supported, not English."""
    code = F.col("lang_code")
    keep = F.contains(code, F.lit("-")) & ~code.isin(*unsupported)
    return df.filter(keep & ~code.startswith("en-") if skip_english else keep)


def fill_intended(df: DataFrame) -> DataFrame:
    """AAC turns without intended text get the typed text, in the nested turns."""
    return df.withColumn(
        "conversation",
        F.transform(
            "conversation",
            lambda t: t.withField(
                "utterance_intended",
                F.when(
                    F.coalesce(t["is_aac_user"], F.lit(False)),
                    F.coalesce(t["utterance_intended"], t["utterance"]),
                ).otherwise(t["utterance_intended"]),
            ),
        ),
    )


def strip_partner_intended(df: DataFrame) -> DataFrame:
    """Partner turns lose their intended text, in the nested turns."""
    return df.withColumn(
        "conversation",
        F.transform(
            "conversation",
            lambda t: t.withField(
                "utterance_intended",
                F.when(F.coalesce(t["is_aac_user"], F.lit(False)), t["utterance_intended"]),
            ),
        ),
    )


def extract_prompts(requests: DataFrame) -> DataFrame:
    """The user message of every request."""
    return requests.select("custom_id", prompt_of("body").alias("prompt"))


def attach_generation(
    df: DataFrame, lang: str, provider: str, model: str, template_id: Column, generated_at: Column
) -> DataFrame:
    """Add where a record came from; the template id only when the record has none."""
    known = F.col("template_id") if "template_id" in df.columns else F.lit(None)
    return df.withColumn("template_id", F.coalesce(known, template_id)).withColumn(
        "metadata",
        F.struct(
            F.lit(lang).alias("lang_code"),
            generated_at.alias("generated_at"),
            F.lit(provider).alias("provider"),
            F.lit(model).alias("model"),
        ),
    )
