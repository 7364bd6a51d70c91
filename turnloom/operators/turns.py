"""Conversations and their turns: exploding, context, next turn, flat examples.

Two shapes come in. A *nested* conversation is one row with an array of turns; its
operators are projections without a shuffle. A *turns* table has one row per turn, ordered by
``turn_number``; there, one conversation may hold a large share of all rows, so windows run
over blocks of a conversation instead of the whole of it, and a block takes what it lacks
from the few rows at the edges of the blocks around it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.operators.filters import aac_turns
from turnloom.operators.scale import cut_lineage, number_rows
from turnloom.schemas import FLAT_COLUMNS

# Turn numbers per window block; no result depends on it.
BLOCK_TURNS = 4096
# The block of turns without a number, before all others.
_NO_NUMBER = -(1 << 62)


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def explode_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn, numbered from 0; conversations without turns give none."""
    others = [c for c in conversations.columns if c != "conversation"]
    return conversations.select(
        *others, F.posexplode("conversation").alias("turn_number", "_turn")
    ).select(*others, "turn_number", "_turn.*")


def with_surroundings(
    turns: DataFrame, n: int = 3, context: bool = True, following: bool = True,
    block: int = BLOCK_TURNS,
) -> DataFrame:
    """Add the previous ``n`` and the next turn, both over all turns, in one shuffle of them.

    Turns are taken in the order of their numbers, which may have gaps; turns without a number
    come first. Each block also gives its first turn and its last ``n``, by rank; a block
    takes the rest of its context and its last next turn from these. Only conversations
    with turns in several blocks give such edges, and at most ``n + 1`` rows a block.
    """
    home = F.coalesce(F.floor(F.col("turn_number") / block), F.lit(_NO_NUMBER))
    parts = ["_id", "_no_id", "_block"]
    placed = (
        turns.withColumn("_id", _text(F.col("conversation_id").cast("string")))
        .withColumn("_no_id", F.col("conversation_id").isNull())
        .withColumn("_block", home)
    )
    w = Window.partitionBy(*parts).orderBy("turn_number")
    said = F.struct(
        _text(F.col("speaker")).alias("speaker"), _text(F.col("utterance")).alias("utterance")
    )
    several = placed.filter(F.col("_block") != 0).select("_id", "_no_id").distinct()
    ranked = placed.join(several, ["_id", "_no_id"], "left_semi").select(
        *parts,
        said.alias("_said"),
        F.row_number().over(w).alias("_rank"),
        F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_rows"),
    )
    edges = (
        ranked.filter((F.col("_rank") == 1) | (F.col("_rank") > F.col("_rows") - n))
        .groupBy(*parts)
        .agg(
            F.min_by("_said", "_rank").alias("_first"),
            F.sort_array(
                F.collect_list(
                    F.when(F.col("_rank") > F.col("_rows") - n, F.struct("_rank", "_said"))
                )
            ).alias("_last"),
        )
    )
    blocks = Window.partitionBy("_id", "_no_id").orderBy("_block")
    edges = edges.select(
        *parts,
        F.flatten(F.collect_list(F.col("_last._said")).over(blocks.rowsBetween(-n, -1))).alias("_before"),
        F.lead("_first", 1).over(blocks).alias("_after"),
    )
    around = [
        F.collect_list(said).over(w.rowsBetween(-n, -1)).alias("_own"),
        F.lead(said, 1).over(w).alias("_own_next"),
    ]
    # the join is on the window's own partitioning, so the turns do not move again
    out = placed.select("*", *around).join(edges, parts, "left")
    if context:
        both = F.when(
            F.col("_before").isNull() | (F.size("_own") >= n), F.col("_own")
        ).otherwise(F.concat("_before", "_own"))
        last = F.slice(both, F.greatest(F.size(both) - n, F.lit(0)) + 1, n) if n else F.slice(both, 1, 0)
        out = (
            out.withColumn("_context", last)
            .withColumn("context_speakers", F.col("_context.speaker"))
            .withColumn("context_utterances", F.col("_context.utterance"))
        )
    if following:
        out = (
            out.withColumn("_next", F.coalesce("_own_next", "_after"))
            .withColumn("next_turn_speaker", _text(F.col("_next.speaker")))
            .withColumn("next_turn_utterance", _text(F.col("_next.utterance")))
        )
    return out.drop(
        *parts, "_own", "_own_next", "_before", "_after", "_context", "_next"
    ).select(
        *turns.columns,
        *(["context_speakers", "context_utterances"] if context else []),
        *(["next_turn_speaker", "next_turn_utterance"] if following else []),
    )


def with_context(turns: DataFrame, n: int = 3, block: int = BLOCK_TURNS) -> DataFrame:
    """Speakers and utterances of the previous ``n`` turns, oldest first."""
    return with_surroundings(turns, n, following=False, block=block)


def with_next(turns: DataFrame, block: int = BLOCK_TURNS) -> DataFrame:
    """Speaker and utterance of the next turn; empty at the end."""
    return with_surroundings(turns, 0, context=False, block=block)


def assign_conversation_id(
    conversations: DataFrame, order: list[str], by: str = "language_code"
) -> DataFrame:
    """Add ``{language}_{n}``, where n counts from 1 in ``order`` within the language."""
    numbered = number_rows(conversations, order, "_number", by=[by], start=1)
    return numbered.withColumn(
        "conversation_id", F.concat_ws("_", F.col(by), F.col("_number").cast("string"))
    ).drop("_number")


def assign_in_file_order(corpus: DataFrame, by: str = "language_code") -> DataFrame:
    """Add ``{language}_{n}``, where n counts the language's rows from 1 in the order of files.

    ``corpus`` has ``_file, _block, _length, _line`` as ``read_corpus`` gives them. Rows are
    counted per block of a file; running sums over the blocks give each block its first number,
    and a row adds its place in the block. The rows themselves stay where they are; the table
    of blocks is broadcast or not by its size. A plan that cuts the files otherwise than the
    count did fails. Where rows were filtered out of a block before, rows are sorted instead.
    """
    block = ["_file", "_block", "_length"]
    blocks = cut_lineage(
        corpus.groupBy(by, *block).agg(
            F.count(F.lit(1)).alias("_rows"),
            F.min("_line").alias("_first"),
            F.max("_line").alias("_last"),
        )
    )
    if not blocks.filter("_last - _first + 1 <> _rows").isEmpty():
        return assign_conversation_id(corpus, ["_file", "_block", "_line"], by)
    before = Window.partitionBy(by).orderBy("_file", "_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = cut_lineage(
        blocks.select(by, *block, "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    number = F.col("_before") + F.col("_line") - F.col("_first") + 1
    known = F.when(
        F.col("_before").isNull(),
        F.raise_error(F.lit("the files were cut anew since their rows were counted")).cast("long"),
    ).otherwise(number)
    return (
        corpus.join(starts, [by, *block], "left")
        .withColumn("conversation_id", F.concat_ws("_", F.col(by), known.cast("string")))
        .select(*corpus.columns, "conversation_id")
    )


def flatten_turns(turns: DataFrame, n: int = 3) -> DataFrame:
    """Flat examples from a turns table: AAC turns with context and next turn."""
    return _as_examples(aac_turns(with_surroundings(turns, n)))


def flatten_examples(conversations: DataFrame, n: int = 3) -> DataFrame:
    """Flat examples from nested conversations, without a shuffle.

    Context and next turn are cut out of the array before it is exploded. Noisy and
    corrected fields of a turn are kept.
    """
    turns = F.col("conversation")
    fields = conversations.schema["conversation"].dataType.elementType.names

    def example(t: Column, i: Column) -> Column:
        first = F.greatest(i - n, F.lit(0))
        before = F.slice(turns, first + 1, i - first)
        after = F.get(turns, i + 1)
        return F.struct(
            i.alias("turn_number"),
            F.transform(before, lambda b: _text(b["speaker"])).alias("context_speakers"),
            F.transform(before, lambda b: _text(b["utterance"])).alias("context_utterances"),
            _text(after["speaker"]).alias("next_turn_speaker"),
            _text(after["utterance"]).alias("next_turn_utterance"),
            *[t[f].alias(f) for f in fields],
        )

    examples = F.filter(
        F.transform(turns, example), lambda e: F.coalesce(e["is_aac_user"], F.lit(False))
    )
    others = [c for c in conversations.columns if c != "conversation"]
    return _as_examples(conversations.select(*others, F.inline(examples)))


def _as_examples(df: DataFrame) -> DataFrame:
    """Fill in defaults and put the flat columns in their order."""
    if "metadata" in df.columns:
        for field in df.schema["metadata"].dataType.names:
            if field in ("template_id", "model", "provider"):
                df = df.withColumn(field, F.col("metadata")[field])
    defaults = {
        "template_id": F.lit(-1),
        "scene": F.lit(""),
        "speaker": F.lit(""),
        "utterance": F.lit(""),
        "model": F.lit("unknown"),
        "provider": F.lit("unknown"),
    }
    for column, default in defaults.items():
        value = F.coalesce(F.col(column), default) if column in df.columns else default
        df = df.withColumn(column, value)
    df = (
        df.withColumn("utterance_intended", F.coalesce("utterance_intended", "utterance"))
        .withColumn("template_id", F.col("template_id").cast("long"))
        .withColumn("turn_number", F.col("turn_number").cast("long"))
        .withColumn("conversation_id", F.col("conversation_id").cast("string"))
    )
    present = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
               for c in FLAT_COLUMNS]
    return df.select(*present)


def rebuild(df: DataFrame, conversation_id: str | None = None) -> DataFrame:
    """Turns in order, each as a line followed by the line of its next turn, if any."""
    if conversation_id is not None:
        df = df.filter(F.col("conversation_id") == conversation_id)

    def line(speaker: str, utterance: str) -> Column:
        return F.concat_ws(": ", F.col(speaker), F.col(utterance))

    has_next = (F.col("next_turn_speaker") != "") & (F.col("next_turn_utterance") != "")
    return df.select(
        "conversation_id",
        "turn_number",
        line("speaker", "utterance").alias("line"),
        F.when(has_next, line("next_turn_speaker", "next_turn_utterance")).alias("next_line"),
    ).orderBy("conversation_id", "turn_number")


def _rendered(t, variant: bool) -> Column:
    speaker, said = F.coalesce(t("speaker"), F.lit("Unknown")), _text(t("utterance"))
    intended = _text(t("utterance_intended"))
    both = F.concat(
        speaker, F.lit(" (AAC User):\n  Intended: "), intended, F.lit("\n  Actual: "), said
    )
    one = F.concat(speaker, F.lit(":\n  "), said)
    is_aac = F.coalesce(t("is_aac_user"), F.lit(False))
    return F.when(is_aac & (intended != said) if variant else is_aac, both).otherwise(one)


def render_turns(turns: DataFrame, only_if_different: bool = False) -> DataFrame:
    """Readable text of every turn, in order.

    AAC turns show intended and actual text, partner turns one line. With
    ``only_if_different`` the intended text shows only where it differs.
    """
    return turns.select(
        "conversation_id", "turn_number", _rendered(F.col, only_if_different).alias("rendered")
    ).orderBy("conversation_id", "turn_number")


def render_conversations(conversations: DataFrame, only_if_different: bool = False) -> DataFrame:
    """Readable text of nested conversations, scene first; no shuffle."""
    lines = F.transform(
        "conversation", lambda t: _rendered(lambda name: t[name], only_if_different)
    )
    scene = F.when(F.col("scene") != "", F.concat(F.lit("SCENE: "), F.col("scene")))
    others = [c for c in conversations.columns if c != "conversation"]
    return conversations.select(
        *others, F.concat_ws("\n\n", scene, F.array_join(lines, "\n\n")).alias("rendered")
    )
