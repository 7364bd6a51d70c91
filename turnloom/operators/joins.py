"""Joins between responses, metadata, resources and work lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions.text import locale_base
from turnloom.operators.prefixes import first_prefix_match
from turnloom.operators.scale import lookup_join, number_rows

# What a response counts as when its metadata does not say.
DEFAULT_PROVIDER = "openai"
DEFAULT_MODEL = "gpt-4-turbo"


def last_metadata(meta: DataFrame, order: str = "line_no", key: str = "custom_id") -> DataFrame:
    """One row per id: the content of its last row and the place of its first one.

    The aggregate combines rows before the shuffle, so a repeated id costs nothing.
    """
    content = [c for c in meta.columns if c not in (key, order)]
    return meta.groupBy(key).agg(
        F.max_by(F.struct(*content), F.col(order)).alias("_content"),
        F.min(order).alias("first_line"),
    ).select(key, "first_line", "_content.*")


def attach_metadata(
    responses: DataFrame, meta: DataFrame, order: str = "line_no", how: str = "inner"
) -> DataFrame:
    """Responses with the metadata of the same id; of several rows the last one counts."""
    latest = last_metadata(meta, order).drop("first_line")
    return lookup_join(responses, latest, "custom_id", how)


def prefix_matches(
    ids: DataFrame,
    meta: DataFrame,
    order: str = "line_no",
    partitions: int | None = None,
    equal: bool = True,
) -> DataFrame:
    """``custom_id`` → ``matched_id``: the first metadata id of which one is a prefix of the other.

    Both sides are sorted by id once and merged, range by range; see ``first_prefix_match``.
    """
    return first_prefix_match(ids, meta, order, "custom_id", partitions, equal)


def _by_prefix(ids: DataFrame, meta: DataFrame, order: str) -> DataFrame:
    """Metadata of the prefix match, one row per id that has no metadata of its own."""
    latest = last_metadata(meta, order).drop("first_line")
    matches = prefix_matches(ids, meta, order, equal=False)
    return lookup_join(
        matches, latest.withColumnRenamed("custom_id", "matched_id"), "matched_id", "inner"
    )


def attach_by_prefix(
    responses: DataFrame, meta: DataFrame, order: str = "line_no"
) -> DataFrame:
    """Responses without metadata of their own id, with that of the first prefix match."""
    return lookup_join(responses, _by_prefix(responses, meta, order), "custom_id", "inner")


def attach_any(
    responses: DataFrame,
    meta: DataFrame,
    order: str = "line_no",
    ids: DataFrame | None = None,
    how: str = "inner",
) -> DataFrame:
    """``attach_metadata``, and ``attach_by_prefix`` for the rest.

    Others are dropped, or stay without a ``matched_id`` when ``how`` is left.

    Which metadata an id gets is settled on ids alone (``ids``, where they can be had at
    less cost than the responses), so the responses themselves move once.
    """
    own = last_metadata(meta, order).drop("first_line")
    own = own.withColumn("matched_id", F.col("custom_id"))
    other = _by_prefix(responses if ids is None else ids, meta, order)
    return lookup_join(responses, own.unionByName(other), "custom_id", how)


def coalesce_metadata(df: DataFrame) -> DataFrame:
    """Metadata fields: the nested one, else the top-level one, else the default."""

    def pick(*paths: str, default: str | None = None) -> Column:
        known = [F.col(p) for p in paths if _has(df, p)]
        return F.coalesce(*known, F.lit(default).cast("string"))

    return df.withColumn(
        "metadata",
        F.struct(
            pick("metadata.lang_code", "lang_code").alias("lang_code"),
            pick("metadata.created_at", "created_at").alias("generated_at"),
            pick("metadata.provider", "provider", default=DEFAULT_PROVIDER).alias("provider"),
            pick("metadata.model", "model", "body.model", default=DEFAULT_MODEL).alias("model"),
        ),
    )


def _has(df: DataFrame, path: str) -> bool:
    schema = df.schema
    for name in path.split("."):
        if name not in getattr(schema, "names", []):
            return False
        schema = schema[name].dataType
    return True


def missing(all_: DataFrame, have: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``all_`` whose key is not in ``have``."""
    keys = [on] if isinstance(on, str) else list(on)
    return lookup_join(all_, have.select(*keys).distinct(), keys, "left_anti")


def available(a: DataFrame, b: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``a`` whose key is also in ``b``."""
    keys = [on] if isinstance(on, str) else list(on)
    return lookup_join(a, b.select(*keys).distinct(), keys, "left_semi")


def pending(work: DataFrame, done: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """The work that has no output yet."""
    return missing(work, done, on)


def ready_jobs(ledger: DataFrame, langs: Sequence[str] | None = None) -> DataFrame:
    """Jobs of the ledger with a result that has not been processed yet."""
    ready = F.col("result_file").isNotNull() & ~F.coalesce(F.col("processed"), F.lit(False))
    return ledger.filter(ready & F.col("lang_code").isin(*langs) if langs else ready)


def resolve_resource(
    langs: DataFrame, resources: DataFrame, value: str, default: str = "en"
) -> DataFrame:
    """The resource of the locale, else of its base language, else of ``default``.

    ``resources`` has one row per ``lang_code``.
    """
    def side(key: str, step: str, rows: DataFrame = resources) -> DataFrame:
        hit = F.struct(F.lit(True).alias("hit"), F.col(value).alias("value"))
        return rows.select(F.col("lang_code").alias(key), hit.alias(step))

    found = lookup_join(langs, side("lang_code", "_exact"), "lang_code", "left")
    found = found.withColumn("_base", locale_base("lang_code"))
    found = lookup_join(found, side("_base", "_of_base"), "_base", "left")
    # the last step has the same key for every row, and one resource at most
    last = F.broadcast(side("_last", "_default", resources.filter(F.col("lang_code") == default).limit(1)))
    found = found.withColumn("_last", F.lit(default)).join(last, "_last", "left")
    hits = F.coalesce("_exact", "_of_base", "_default")
    return found.select(*langs.columns, hits["value"].alias(value))


def new_combinations(
    candidates: DataFrame, done: DataFrame, template: str = "template_id", subs: str = "substitutions"
) -> DataFrame:
    """Candidates whose template and set of substitutions exist neither in ``done`` nor twice.

    The sorted pairs themselves are the key. Copies combine before the shuffle.
    """

    def key(df: DataFrame, *more: str) -> DataFrame:
        return df.select(template, F.sort_array(F.map_entries(subs)).alias("_pairs"), *more)

    others = [c for c in candidates.columns if c not in (template, subs)]
    fresh = key(candidates, *others)
    if others:
        # one copy as a whole, the same in every run
        least = F.min(F.struct(*others)).alias("_least")
        fresh = fresh.groupBy(template, "_pairs").agg(least).select(template, "_pairs", "_least.*")
    else:
        fresh = fresh.distinct()
    fresh = fresh.join(key(done).distinct(), [template, "_pairs"], "left_anti")
    return fresh.withColumn(subs, F.map_from_entries("_pairs")).select(*candidates.columns)


def pair_files(responses: DataFrame, metas: DataFrame) -> DataFrame:
    """The metadata file of each response file.

    ``responses`` has ``path`` and ``first_custom_id``, ``metas`` has ``path``. First by
    language and timestamp in the name, where the metadata's timestamp may go on; else by
    the batch id in the first row's id. Of several files the first by name counts.
    """
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    parts = F.split(name, "_")
    r = responses.select(
        "path",
        F.try_element_at(parts, F.lit(2)).alias("lang"),
        F.split_part(F.try_element_at(parts, F.lit(3)), F.lit("."), F.lit(1)).alias("stamp"),
        F.regexp_extract("first_custom_id", r"^([^_]*_[^_]*_[^_]*)_", 1).alias("batch"),
    )
    m = metas.select(
        F.col("path").alias("meta_path"),
        F.regexp_extract(name, r"^batch_([^_]+)_openai_", 1).alias("lang"),
        F.regexp_extract(name, r"^batch_[^_]+_openai_(.*)_metadata\.jsonl$", 1).alias("tail"),
        F.regexp_extract(name, r"^(.*)_metadata\.jsonl$", 1).alias("stem"),
    )
    stamps = F.transform(
        F.sequence(F.lit(1), F.length("tail")), lambda n: F.left(F.col("tail"), n)
    )
    by_name = (
        m.filter(F.length("tail") > 0)
        .select("meta_path", "lang", F.explode(stamps).alias("stamp"))
        .groupBy("lang", "stamp")
        .agg(F.min("meta_path").alias("by_name"))
    )
    words = F.split("stem", "_")
    batches = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(words) - 2, F.lit(1))),
        lambda i: F.concat_ws("_", F.slice(words, i, 3)),
    )
    by_batch = (
        m.select("meta_path", F.explode(batches).alias("batch"))
        .groupBy("batch")
        .agg(F.min("meta_path").alias("by_batch"))
    )
    both = r.join(by_name, ["lang", "stamp"], "left").join(by_batch, "batch", "left")
    return both.select("path", F.coalesce("by_name", "by_batch").alias("meta_path"))


def latest_file(files: DataFrame, by: Sequence[str], path: str = "path",
                modified: str = "modified") -> DataFrame:
    """The newest file of each group."""
    return files.groupBy(*by).agg(
        F.max_by(path, F.struct(modified, path)).alias(path), F.max(modified).alias(modified)
    )


def union_sources(*dfs: DataFrame) -> DataFrame:
    """All rows of all inputs; a column that one of them lacks is null there."""
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def zip_translations(
    entries: DataFrame, batches: DataFrame, column: str, order: Sequence[str]
) -> DataFrame:
    """The i-th entry takes the i-th translation; entries past the end keep their own.

    ``batches`` has ``batch_index`` and ``translations``, in any order; surplus
    translations are ignored.
    """
    lines = batches.select("batch_index", F.posexplode("translations").alias("pos", "_translated"))
    numbered = number_rows(lines, ["batch_index", "pos"], "_i").select("_i", "_translated")
    placed = number_rows(entries, list(order), "_i").join(numbered, "_i", "left")
    return placed.withColumn(column, F.coalesce("_translated", column)).select(*entries.columns)
