"""Translation by distinct string: extract, chunk, read back, put in place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions.response import body_content
from turnloom.functions.text import numbered_lines, parse_custom_id
from turnloom.operators.scale import lookup_join, number_by_hash

# The request text around the numbered strings.
SYSTEM_TEXT = "You are a professional translator."
PROMPT_TEXT = (
    "Translate the following texts from {source} to {target}. "
    "Keep the meaning intact but make it sound natural in the target language. "
    "Return only the translations, one per line, with the same index numbers:\n\n"
)
CHUNK_STRINGS = 100


def unique_strings(entries: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct ``(field, original)`` with a dense ``idx`` per field.

    Repeated strings are combined before the shuffle. The index follows a hash of the
    string, so that it can be given out in even buckets.
    """
    strings = entries.select(*cols).unpivot([], list(cols), "field", "original")
    distinct = strings.filter(F.col("original").isNotNull()).distinct()
    return number_by_hash(distinct, ["original"], "idx", by=["field"])


def translatable_strings(
    df: DataFrame, key: str, cols: Sequence[str], skip: Sequence[str] = ()
) -> DataFrame:
    """``(key, path, text)`` of every non-blank string in the given columns.

    A column may be a string, an array of strings, or a struct or array of structs with
    string fields; only fields named in ``cols`` are taken from structs.
    """
    allowed = [c for c in cols if c not in skip]
    found: list[Column] = []

    def single(path: Column, text: Column) -> Column:
        return F.array(F.struct(path.alias("path"), text.alias("text")))

    def walk(path: Column, value: Column, dtype, name: str) -> Column | None:
        kind = dtype.typeName()
        if kind == "string":
            return single(path, value) if name in allowed else None
        if kind == "struct":
            parts = [
                walk(F.concat_ws(".", path, F.lit(f.name)), value[f.name], f.dataType, f.name)
                for f in dtype.fields
            ]
            parts = [p for p in parts if p is not None]
            return F.concat(*parts) if parts else None
        if kind == "array":
            inner = walk(path, F.element_at(value, 1), dtype.elementType, name)
            if inner is None:
                return None
            return F.coalesce(
                F.flatten(
                    F.transform(
                        value,
                        lambda x, i: walk(
                            F.concat_ws(".", path, i.cast("string")), x, dtype.elementType, name
                        ),
                    )
                ),
                F.array().cast("array<struct<path:string,text:string>>"),
            )
        return None

    for field in df.schema.fields:
        if field.name != key and field.name not in skip:
            part = walk(F.lit(field.name), F.col(field.name), field.dataType, field.name)
            if part is not None:
                found.append(part)
    rows = df.select(key, F.inline(F.concat(*found)))
    return rows.filter(F.trim(F.regexp_replace("text", r"\s+", " ")) != "")


def put_back(
    df: DataFrame, key: str, translations: DataFrame, cols: Sequence[str], skip: Sequence[str] = ()
) -> DataFrame:
    """Put texts back at the paths ``translatable_strings`` found them at.

    ``translations`` has ``(key, path, text)``; a place without one keeps its text, and of
    several for one place the smallest is taken. The texts of one row, no more than the row held, come to it as a map.
    """
    allowed = [c for c in cols if c not in skip]
    one = translations.groupBy(key, "path").agg(F.min("text").alias("text"))
    texts = one.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("path", "text"))).alias("_texts")
    )

    def rebuilt(path: Column, value: Column, dtype, name: str) -> Column:
        kind = dtype.typeName()
        if kind == "string" and name in allowed:
            return F.coalesce(F.try_element_at("_texts", path), value)
        if kind == "struct":
            fields = [
                rebuilt(F.concat_ws(".", path, F.lit(f.name)), value[f.name], f.dataType, f.name)
                .alias(f.name)
                for f in dtype.fields
            ]
            return F.when(value.isNotNull(), F.struct(*fields))
        if kind == "array":
            return F.transform(
                value,
                lambda x, i: rebuilt(
                    F.concat_ws(".", path, i.cast("string")), x, dtype.elementType, name
                ),
            )
        return value

    columns = [
        F.col(f.name)
        if f.name == key or f.name in skip
        else rebuilt(F.lit(f.name), F.col(f.name), f.dataType, f.name).alias(f.name)
        for f in df.schema.fields
    ]
    return lookup_join(df, texts, key, "left").select(*columns)


def chunk_requests(
    strings: DataFrame,
    lang: str,
    size: int = CHUNK_STRINGS,
    stamp: str = "0",
    source: str = "en",
) -> DataFrame:
    """One request per ``size`` consecutive strings of a field, as a numbered list.

    ``strings`` has ``field``, ``idx`` and ``original``; a group is ``size`` strings at most.
    """
    pos = F.col("idx") % size
    listed = F.transform(
        F.sort_array(F.collect_list(F.struct(pos.alias("pos"), "original"))),
        lambda s: F.concat((s["pos"] + 1).cast("string"), F.lit(". "), s["original"], F.lit("\n")),
    )
    chunks = strings.groupBy("field", F.floor(F.col("idx") / size).alias("chunk")).agg(
        F.count(F.lit(1)).alias("strings"), F.array_join(listed, "").alias("body")
    )
    prompt = PROMPT_TEXT.format(source=source, target=lang)
    return chunks.select(
        F.concat_ws(
            "_", F.lit("translate"), F.lit(lang), "field", F.col("chunk").cast("string"),
            F.lit(stamp),
        ).alias("custom_id"),
        "field",
        "chunk",
        "strings",
        F.concat(F.lit(prompt), "body").alias("prompt"),
    )


def read_batches(responses: DataFrame, order: str = "line_no") -> DataFrame:
    """``(lang, field, batch_index, translations)`` from translation responses.

    ``responses`` has ``custom_id``, ``response`` (JSON text of the completion) and a
    place. Rows without a usable id or content are dropped; of two answers for one batch
    the later one counts.
    """
    parsed = responses.select(
        order,
        parse_custom_id("custom_id").alias("id"),
        numbered_lines(body_content(F.try_parse_json("response"))).alias("translations"),
    ).filter(F.col("id").isNotNull() & F.col("translations").isNotNull())
    return parsed.groupBy("id.lang", "id.field", "id.batch_index").agg(
        F.max_by("translations", order).alias("translations")
    )


def index_lookup(
    strings: DataFrame, batches: DataFrame, size: int = CHUNK_STRINGS
) -> DataFrame:
    """``(field, original, translation)``: place ``i`` of batch ``b`` is string ``b·size + i``."""
    lines = batches.select(
        "field", "batch_index", F.posexplode("translations").alias("pos", "translation")
    )
    indexed = lines.groupBy(
        "field", (F.col("batch_index") * F.lit(size) + F.col("pos")).cast("long").alias("idx")
    ).agg(F.max_by("translation", "batch_index").alias("translation"))
    return strings.join(indexed, ["field", "idx"]).select("field", "original", "translation")


def translate_columns(entries: DataFrame, lookup: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace each column by its translation where there is one; add ``{col}_found``.

    ``lookup`` has one ``translation`` per ``(field, original)``.
    """
    out = entries
    for c in cols:
        side = lookup.filter(F.col("field") == c).select(
            F.col("original").alias(c), F.col("translation").alias("_translation")
        )
        out = (
            lookup_join(out, side, c, "left")
            .withColumn(f"{c}_found", F.col("_translation").isNotNull())
            .withColumn(c, F.coalesce("_translation", c))
            .drop("_translation")
        )
    return out.select(*entries.columns, *[f"{c}_found" for c in cols])
