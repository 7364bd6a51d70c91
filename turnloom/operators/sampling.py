"""Samples, splits and random draws that come out the same in every run."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions.text import as_column
from turnloom.operators.joins import resolve_resource
from turnloom.operators.scale import (
    cut_lineage,
    hash_cutoff,
    hash_order,
    lookup_join,
    number_by_hash,
    number_rows,
)


def draw(
    key: Sequence[Column | str], name: str | Column, seed: int, count: int | Column
) -> Column:
    """A number below ``count`` from a row's key, the draw's name and the seed."""
    parts = [as_column(k).cast("string") for k in key]
    digest = F.md5(F.concat_ws("|", *parts, F.lit(name), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") % F.lit(count)


def sample_n(df: DataFrame, n: int, key: Sequence[str], seed: int = 0) -> DataFrame:
    """``n`` rows without replacement, or all when there are fewer.

    ``key`` identifies a row. The sample is a filter on the hash of the key.
    """
    if n <= 0:
        return df.limit(0)
    if df.count() <= n:
        return df
    return df.filter(hash_order(key, seed) <= F.lit(hash_cutoff(df, key, n, seed)))


def sample_fill(df: DataFrame, n: int, key: Sequence[str], seed: int = 0) -> DataFrame:
    """``n`` rows: all distinct ones first, then draws with replacement."""
    size = df.count()
    if size >= n or size == 0:
        return sample_n(df, n, key, seed)
    extra = df.sparkSession.range(n - size).select(
        draw(["id"], "fill", seed, size).alias("_i")
    )
    return df.unionByName(pick_rows(extra, df, "_i", key, size, seed))


def pick_rows(
    draws: DataFrame, df: DataFrame, index: str, key: Sequence[str], size: int, seed: int = 0
) -> DataFrame:
    """The row of ``df`` that each drawn index points at.

    Few rows drawn many times are hot keys, which ``lookup_join`` lets adaptive execution split;
    whether the table is broadcast is Spark's choice by its size.
    """
    numbered = number_by_hash(df, key, index, seed=seed)
    others = [c for c in draws.columns if c != index]
    return lookup_join(draws, numbered, index, "inner").select(*others, *df.columns)


def split_exact(df: DataFrame, key: Sequence[str], test: float = 0.2, seed: int = 0) -> DataFrame:
    """Label rows ``train`` or ``test``; ``ceil(test·n)`` of them are test rows.

    ``key`` identifies a row. Labelling is a comparison with one hash value, so the
    rows themselves are not moved.
    """
    if not 0 <= test <= 1:
        raise ValueError("test is a share between 0 and 1")
    wanted = math.ceil(test * df.count())
    if wanted == 0:
        return df.withColumn("split", F.lit("train"))
    in_test = hash_order(key, seed) <= F.lit(hash_cutoff(df, key, wanted, seed))
    return df.withColumn("split", F.when(in_test, F.lit("test")).otherwise(F.lit("train")))


def sample_requests(
    n: int,
    templates: DataFrame,
    entries: DataFrame,
    entry_key: Sequence[str],
    substitutions: DataFrame,
    seed: int = 0,
) -> DataFrame:
    """``n`` requests, each with one random template, entry and value per key.

    ``templates`` has ``template_id`` (dense from 0) and ``template``; ``substitutions``
    has ``key`` and ``values``. Draws are independent and with replacement. Templates and entries
    are joined on dense indexes, values as in ``draw_values``; none is collected.
    """
    count = templates.count()
    if not count:
        raise ValueError("no templates")
    texts = number_rows(
        templates.select("template_id", "template"), ["template_id", "template"], "_template"
    )
    ids = entries.sparkSession.range(n).withColumnRenamed("id", "request")
    size = entries.count()
    drawn = ids.select(
        "request",
        draw(["request"], "template", seed, count).alias("_template"),
        draw(["request"], "entry", seed, size).alias("_entry"),
    )
    drawn = lookup_join(drawn, texts, "_template", "inner")
    drawn = lookup_join(drawn, draw_values(n, substitutions, seed), "request")
    empty = F.create_map().cast("map<string,string>")
    drawn = drawn.select(
        "request", "template_id", "template", F.coalesce("picks", empty).alias("picks"), "_entry"
    )
    return pick_rows(drawn, entries, "_entry", entry_key, size, seed)


def draw_values(n: int, substitutions: DataFrame, seed: int = 0, prefix: str = "") -> DataFrame:
    """``(request, picks)``: a random value per key of ``substitutions`` for each of ``n`` requests.

    Keys without values are left out; without any key there is no row.
    """
    lists = number_rows(
        substitutions.filter(F.size("values") > 0).select("key", "values"), ["key", "values"], "_key"
    )
    keys = lists.count()
    sizes = lists.select("_key", "key", F.size("values").alias("_size"))
    values = lists.select("_key", F.posexplode("values").alias("_at", "value"))
    draws = substitutions.sparkSession.range(n * keys).select(
        F.expr(f"id div {max(keys, 1)}").alias("request"), (F.col("id") % max(keys, 1)).alias("_key")
    )
    name = F.concat(F.lit(prefix), F.col("key"))
    drawn = lookup_join(draws, sizes, "_key", "inner").select(
        "request", "_key", "key", draw(["request"], name, seed, F.col("_size")).cast("int").alias("_at")
    )
    picks = F.sort_array(F.collect_list(F.struct("_key", "key", "value")))
    pairs = F.transform(picks, lambda p: p.dropFields("_key"))
    return (
        lookup_join(drawn, values, ["_key", "_at"], "inner")
        .groupBy("request")
        .agg(F.map_from_entries(pairs).alias("picks"))
    )


# A hole of a template, ``{{ name }}``.
HOLE = r"\{\{\s*([A-Za-z_]\w*)\s*\}\}"


def holes(template: Column | str) -> Column:
    """The distinct names a template has holes for."""
    return F.array_distinct(F.regexp_extract_all(as_column(template), F.lit(HOLE), F.lit(1)))


def sample_requests_by_language(
    n: int,
    langs: DataFrame,
    templates: DataFrame,
    entries: DataFrame,
    entry_key: Sequence[str],
    substitutions: DataFrame,
    system_template: str = "",
    needed: Sequence[str] = ("aac_user", "partner"),
    seed: int = 0,
    default: str = "en",
) -> DataFrame:
    """``n`` requests for each language: a random template, an entry, and values for its holes.

    ``langs`` has ``lang_code``; ``templates`` has ``lang_code, template_id, template`` and
    ``substitutions`` has ``lang_code, key, values``. A language without its own templates or
    substitutions takes those of its base language, else those of ``default``; one for which
    there is no template at all gets no request. Values are drawn only for names that the
    template or ``system_template`` has holes for, and for ``needed``; ``picks`` and
    ``system_picks`` draw apart from each other. Draws are with replacement, each by language,
    request and name.
    """
    spark = langs.sparkSession
    langs = langs.select("lang_code").distinct()

    def of(resources: DataFrame, name: str) -> DataFrame:
        codes = resources.select("lang_code").distinct().withColumn(name, F.col("lang_code"))
        return resolve_resource(langs, codes, name, default)

    texts = number_rows(
        templates.select("lang_code", "template_id", "template"),
        ["template_id", "template"], "_template", by=["lang_code"],
    ).withColumnRenamed("lang_code", "_templates")
    sizes = texts.groupBy("_templates").agg(F.count(F.lit(1)).alias("_count"))
    lists = cut_lineage(
        substitutions.filter(F.size("values") > 0).select(
            F.col("lang_code").alias("_subs"), "key", "values"
        )
    )
    system = F.array_union(holes(F.lit(system_template)), F.array(*[F.lit(k) for k in needed]))
    # languages and their templates: what every request of them shares
    plan = lookup_join(of(templates, "_templates"), sizes, "_templates", "inner")
    plan = plan.join(of(substitutions, "_subs"), "lang_code")
    own = plan.join(texts, "_templates").withColumn(
        "_hole",
        F.explode(
            F.concat(
                F.transform(
                    F.array_union(holes("template"), F.array(*[F.lit(k) for k in needed])),
                    lambda k: F.struct(F.lit("").alias("draw"), k.alias("key")),
                ),
                F.transform(system, lambda k: F.struct(F.lit("system.").alias("draw"), k.alias("key"))),
            )
        ),
    )
    sized = lists.select("_subs", F.col("key").alias("_key"), F.size("values").alias("_size"))
    own = own.join(
        sized, (own["_subs"] == sized["_subs"]) & (own["_hole.key"] == sized["_key"]), "left"
    ).drop(sized["_subs"])
    shared = cut_lineage(
        own.groupBy("lang_code", "_count", "_subs", "_template", "template_id", "template").agg(
            F.collect_list(
                F.when(F.col("_size").isNotNull(), F.struct("_hole.draw", "_hole.key", "_size"))
            ).alias("_holes")
        )
    )
    numbered = number_rows(shared.select("lang_code", "_count").distinct(), ["lang_code"], "_lang")
    numbered = cut_lineage(numbered)
    size = entries.count()
    total = numbered.count()
    requests = spark.range(n * total).select(
        F.expr(f"id div {max(n, 1)}").alias("_lang"), (F.col("id") % max(n, 1)).alias("request")
    )
    requests = lookup_join(requests, numbered, "_lang", "inner").select(
        "lang_code",
        "request",
        draw(["lang_code", "request"], "template", seed, F.col("_count")).alias("_template"),
        draw(["lang_code", "request"], "entry", seed, size).alias("_entry"),
    )
    drawn = lookup_join(requests, shared, ["lang_code", "_template"], "inner")
    hole = drawn.select("lang_code", "request", "_subs", F.inline("_holes")).select(
        "lang_code", "request", "_subs", "draw", "key",
        draw(["lang_code", "request"], F.concat("draw", "key"), seed, F.col("_size")).cast("int").alias("_at"),
    )
    values = lists.select("_subs", "key", F.posexplode("values").alias("_at", "value"))
    pair = F.struct("key", "value")

    def picked(of_draw: str) -> Column:
        pairs = F.sort_array(F.collect_list(F.when(F.col("draw") == of_draw, pair)))
        return F.map_from_entries(pairs)

    picks = (
        lookup_join(hole, values, ["_subs", "key", "_at"], "inner")
        .groupBy("lang_code", "request")
        .agg(picked("").alias("picks"), picked("system.").alias("system_picks"))
    )
    none = F.create_map().cast("map<string,string>")
    out = lookup_join(drawn, picks, ["lang_code", "request"]).select(
        "lang_code", "request", "template_id", "template",
        F.coalesce("picks", none).alias("picks"),
        F.coalesce("system_picks", none).alias("system_picks"),
        "_entry",
    )
    return pick_rows(out, entries, "_entry", entry_key, size, seed)
