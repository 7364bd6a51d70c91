"""Whole-table jobs a user runs, composed from the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnloom.functions.keyboard import Grid, key_grid
from turnloom.functions.noise_batch import noisy_turns, noisy_variants
from turnloom.functions.prompts import build_request, prompt_values
from turnloom.functions.response import (
    body_content,
    clean_content,
    parse_conversation,
    repair_json,
    response_body,
    strict_json,
    allow_repeated_keys,
)
from turnloom.functions.text import (
    fully_corrected,
    language_name,
    minimally_corrected,
    render,
)
from turnloom.operators.filters import fill_intended, strip_partner_intended
from turnloom.operators.joins import attach_any, coalesce_metadata
from turnloom.operators.sampling import (
    draw_values,
    sample_requests,
    sample_requests_by_language,
    split_exact,
)
from turnloom.operators.scale import lookup_join
from turnloom.operators.stats import corpus_stats, coverage, format_stats, with_total
from turnloom.operators.translation import (
    CHUNK_STRINGS,
    chunk_requests,
    index_lookup,
    read_batches,
    translate_columns,
    unique_strings,
)
from turnloom.operators.turns import assign_in_file_order, flatten_examples
from turnloom.schemas import CONVERSATION, ERROR_RATES, GENERATION, LAYOUTS, TURN, noisy_columns
from turnloom.sources.readers import read_corpus
from turnloom.sources.writers import write_dataset, write_stats

AUGMENTED_TURN = T.StructType(
    [
        *TURN.fields,
        *[
            T.StructField(c, T.StringType())
            for c in (*noisy_columns(), "minimally_corrected", "fully_corrected")
        ],
    ]
)
AUGMENTED_CONVERSATION = T.StructType(
    [
        T.StructField("template_id", T.IntegerType()),
        T.StructField("scene", T.StringType()),
        T.StructField("conversation", T.ArrayType(AUGMENTED_TURN)),
        T.StructField("metadata", GENERATION),
    ]
)


def augment_turns(
    turns: DataFrame,
    layouts: Mapping[str, Grid] | Sequence[str] = LAYOUTS,
    rates: Mapping[str, float] = ERROR_RATES,
    seed: int = 0,
    key: Sequence[str] = ("conversation_id", "turn_number"),
) -> DataFrame:
    """Noisy and corrected forms of every AAC turn; partner turns pass with nulls.

    A projection: no shuffle. ``key`` identifies a turn.
    """
    if not isinstance(layouts, Mapping):
        layouts = {name: key_grid(name) for name in layouts}
    variants = [
        (f"noisy_{name}_{severity}", grid, rate)
        for severity, rate in rates.items()
        for name, grid in layouts.items()
    ]
    is_aac = F.coalesce(F.col("is_aac_user"), F.lit(False))
    noisy = noisy_variants(F.when(is_aac, F.col("utterance")), key, variants, seed)
    intended = F.coalesce("utterance_intended", "utterance")
    return (
        turns.withColumn("_noisy", noisy)
        .select("*", "_noisy.*")
        .drop("_noisy")
        .withColumn("minimally_corrected", F.when(is_aac, minimally_corrected("utterance")))
        .withColumn("fully_corrected", F.when(is_aac, fully_corrected(intended)))
    )


def augment_conversations(
    conversations: DataFrame,
    key: Sequence[str] = ("conversation_id",),
    grids: Mapping[str, Mapping[str, Grid]] | None = None,
    rates: Mapping[str, float] = ERROR_RATES,
    seed: int = 0,
    language: str = "language_code",
    default: str = "en",
) -> DataFrame:
    """The noisy and corrected forms of every AAC turn, inside the array of turns.

    ``grids`` gives each language its layouts, by their names; a locale takes those of its base
    language, else those of ``default``. Partner turns have nulls there. Turn fields of these
    names are replaced, other fields and rows stay. A projection: nothing is exploded or moved.
    """
    grids = dict(grids or {})
    grids.setdefault(default, {name: key_grid(name) for name in LAYOUTS})
    variants = {
        lang: [
            (f"noisy_{name}_{severity}", grid, rate)
            for severity, rate in rates.items()
            for name, grid in layouts.items()
        ]
        for lang, layouts in grids.items()
    }
    tags = [tag for tag, _, _ in variants[default]]

    def is_aac(t: Column) -> Column:
        return F.coalesce(t["is_aac_user"], F.lit(False))

    typed = F.transform("conversation", lambda t: F.when(is_aac(t), t["utterance"]))
    noisy = noisy_turns(typed, key, language, variants, default, seed)

    def with_forms(t: Column, i: Column) -> Column:
        forms = {tag: F.get("_noisy", i)[tag] for tag in tags}
        intended = F.coalesce(t["utterance_intended"], t["utterance"])
        forms["minimally_corrected"] = F.when(is_aac(t), minimally_corrected(t["utterance"]))
        forms["fully_corrected"] = F.when(is_aac(t), fully_corrected(intended))
        for name, value in forms.items():
            t = t.withField(name, value)
        return t

    return (
        conversations.withColumn("_noisy", noisy)
        .withColumn("conversation", F.transform("conversation", with_forms))
        .select(*conversations.columns)
    )


def build_request_table(
    n: int,
    lang: str,
    templates: DataFrame,
    entries: DataFrame,
    entry_key: Sequence[str],
    substitutions: DataFrame,
    system_template: str,
    model: str = "gpt-4o-mini",
    batch_id: str = "batch",
    seed: int = 0,
    created_at: str | None = None,
) -> DataFrame:
    """``n`` requests: submitted part, metadata, and both prompts.

    User and system text draw their names and style values apart from each other.
    """
    drawn = sample_requests(n, templates, entries, entry_key, substitutions, seed)
    system = draw_values(n, substitutions, seed, "system.").withColumnRenamed("picks", "_system")
    drawn = lookup_join(drawn, system, "request")
    system_picks = F.coalesce("_system", F.create_map().cast("map<string,string>"))

    def values(picks: Column) -> Column:
        return prompt_values(
            "topic", "relation", "which", picks, F.lit(lang), F.col("aac_user_role")
        )

    language = F.create_map(F.lit("language"), language_name(F.lit(lang)))
    texts = drawn.select(
        F.concat_ws("_", F.lit(batch_id), F.col("request").cast("string")).alias("custom_id"),
        "template_id",
        render("template", values(F.col("picks"))).alias("user_prompt"),
        render(F.lit(system_template), F.map_concat(values(system_picks), language)).alias(
            "system_prompt"
        ),
    )
    return texts.withColumn(
        "request", build_request("custom_id", "system_prompt", "user_prompt", model)
    ).withColumn(
        "metadata",
        F.struct(
            F.col("template_id"),
            F.lit(lang).alias("lang_code"),
            F.lit(created_at).cast("string").alias("created_at"),
        ),
    )


def build_request_tables(
    n: int,
    langs: DataFrame,
    templates: DataFrame,
    entries: DataFrame,
    entry_key: Sequence[str],
    substitutions: DataFrame,
    system_template: str,
    model: str = "gpt-4o-mini",
    batch_id: str = "batch",
    seed: int = 0,
    created_at: str | None = None,
) -> DataFrame:
    """``build_request_table`` for every language of ``langs`` in one plan, ``n`` requests each.

    Templates and substitutions are by language, with the fallback and the draws of
    ``sample_requests_by_language``; ids are ``{batch}_{language}_{request}``.
    """
    drawn = sample_requests_by_language(
        n, langs, templates, entries, entry_key, substitutions, system_template, seed=seed
    )
    lang = F.col("lang_code")

    def values(picks: str) -> Column:
        return prompt_values("topic", "relation", "which", F.col(picks), lang, F.col("aac_user_role"))

    language = F.create_map(F.lit("language"), language_name(lang))
    texts = drawn.select(
        F.concat_ws("_", F.lit(batch_id), lang, F.col("request").cast("string")).alias("custom_id"),
        "lang_code",
        "template_id",
        render("template", values("picks")).alias("user_prompt"),
        render(F.lit(system_template), F.map_concat(values("system_picks"), language)).alias("system_prompt"),
    )
    metadata = F.struct(
        "template_id", "lang_code", F.lit(created_at).cast("string").alias("created_at")
    )
    return texts.withColumn(
        "request", build_request("custom_id", "system_prompt", "user_prompt", model)
    ).withColumn("metadata", metadata)


def request_twins(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lines to submit, and the same lines with the metadata to keep."""
    return requests.select("request.*"), requests.select("request.*", "metadata")


def read_responses(
    lines: DataFrame, line: str = "value", keep_content: bool = False
) -> DataFrame:
    """Parse response lines: ids, conversation, and a status of ok, recovered or error.

    A row that cannot be used keeps its whole content and says why; no row fails the job.
    With ``keep_content`` usable rows keep theirs too.
    """
    allow_repeated_keys(lines.sparkSession)
    others = [c for c in lines.columns if c not in (line, "id", "custom_id")]
    envelope = _computed(
        _computed(lines.select(*others, line), _v=strict_json(line)),
        id=F.try_variant_get("_v", "$.id", "string"),
        custom_id=F.try_variant_get("_v", "$.custom_id", "string"),
        _body=response_body("_v"),
    )
    content = _computed(
        envelope.drop("_v"),
        response_model=F.try_variant_get("_body", "$.model", "string"),
        _content=clean_content(body_content("_body")),
    )
    plain = _computed(content.drop("_body"), _plain=parse_conversation("_content"))
    repaired = F.when(F.col("_plain").isNull(), parse_conversation(repair_json("_content")))
    rows = _computed(plain, _repaired=repaired)

    named = F.length("custom_id") > 0
    parsed = F.coalesce("_plain", "_repaired")
    error = (
        F.when(~F.coalesce(named, F.lit(False)), "missing custom_id")
        .when(F.col("_content").isNull(), "no content")
        .when(parsed.isNull(), "invalid JSON")
        .when(parsed["conversation"].isNull(), "no conversation")
    )
    status = (
        F.when(F.col("error").isNotNull(), "error")
        .when(F.col("_plain").isNotNull(), "ok")
        .otherwise("recovered")
    )
    return (
        rows.withColumn("error", error)
        .withColumn("status", status)
        .withColumn("content", F.when(error.isNotNull() | F.lit(keep_content), F.coalesce("_content", line)))
        .withColumn("_parsed", F.when(error.isNull(), parsed))
        .select(
            *others, "id", "custom_id", "response_model", "status", "error", "content", "_parsed.*"
        )
    )


def _computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns so that each is computed once per row.

    As the output of a generator they are plain attributes to the optimizer, which would
    otherwise copy their expressions into every filter and join condition above.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def process_responses(
    lines: DataFrame, meta: DataFrame, order: str = "line_no", line: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Stored conversations with their metadata, and the rejected rows.

    Metadata comes from the same id, else from the first id of which one is a prefix of
    the other; a conversation without any is rejected. Every line is stored or rejected.
    """
    rows = read_responses(lines, line, keep_content=True)
    rejects = rows.filter(F.col("status") == "error").select("id", "custom_id", "error", "content")
    good = rows.filter(F.col("status") != "error").drop("error")
    known = [c for c in meta.columns if c not in ("custom_id", order)]
    own = meta.select("custom_id", order, *[F.col(c).alias(f"meta_{c}") for c in known])
    # the id that the rows themselves are read with: of repeated keys the last
    ids = lines.select(F.try_variant_get(strict_json(line), "$.custom_id", "string").alias("custom_id"))
    every = attach_any(good, own, order, ids.filter(F.length("custom_id") > 0), how="left")
    alone = F.col("matched_id").isNull()
    rejects = rejects.unionByName(
        every.filter(alone).select("id", "custom_id", F.lit("no metadata").alias("error"), "content")
    )
    joined = every.filter(~alone).drop("content")
    carried = joined.withColumn("metadata", F.struct(*[F.col(f"meta_{c}").alias(c) for c in known]))
    stored = coalesce_metadata(carried).drop(*[f"meta_{c}" for c in known])
    return strip_partner_intended(fill_intended(stored)), rejects


def translation_requests(
    entries: DataFrame, cols: Sequence[str], lang: str, size: int = CHUNK_STRINGS
) -> DataFrame:
    """Request side of a translation: one prompt per chunk of distinct strings."""
    return chunk_requests(unique_strings(entries, cols), lang, size)


def translation_round_trip(
    entries: DataFrame,
    cols: Sequence[str],
    responses: DataFrame,
    size: int = CHUNK_STRINGS,
) -> tuple[DataFrame, DataFrame]:
    """Return side: entries with translated columns, and the coverage per column."""
    strings = unique_strings(entries, cols)
    lookup = index_lookup(strings, read_batches(responses), size)
    translated = translate_columns(entries, lookup, cols)
    return translated, coverage(translated, cols)


def build_dataset(
    spark: SparkSession,
    glob: str,
    path: str,
    test: float = 0.2,
    seed: int = 0,
    lang_from: str = "name",
    schema: T.StructType = AUGMENTED_CONVERSATION,
) -> DataFrame:
    """Read conversation files, flatten, split and write the dataset; returns the examples."""
    corpus = assign_in_file_order(read_corpus(spark, glob, schema, lang_from))
    examples = flatten_examples(corpus)
    labelled = split_exact(examples, ["conversation_id", "turn_number"], test, seed)
    write_dataset(labelled, path)
    return labelled


def stats_report(
    turns: DataFrame, path: str | None = None, aac: Column | str = "is_aac_user"
) -> DataFrame:
    """Formatted statistics per language with a total; written when a path is given."""
    report = format_stats(with_total(corpus_stats(turns, aac=aac)))
    if path is not None:
        write_stats(report, path)
    return report
