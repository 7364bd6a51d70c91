"""Plain text columns: counting, correcting, filling holes, cutting out parts."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens that stand for the two people, by language.
PERSON_TOKENS = {"en": ("PersonX", "PersonY"), "sl-SI": ("OsebaX", "oseboY")}

# Display names of the supported locales.
LANGUAGE_NAMES = {
    "af-ZA": "Afrikaans (South Africa)",
    "ar-SA": "Arabic (Saudi Arabia)",
    "eu-ES": "Basque (Spain)",
    "ca-ES": "Catalan (Spain)",
    "hr-HR": "Croatian (Croatia)",
    "cs-CZ": "Czech (Czechia)",
    "da-DK": "Danish (Denmark)",
    "nl-BE": "Dutch (Belgium)",
    "nl-NL": "Dutch (Netherlands)",
    "en-AU": "English (Australia)",
    "en-CA": "English (Canada)",
    "en-NZ": "English (New Zealand)",
    "en-ZA": "English (South Africa)",
    "en-GB": "English (United Kingdom)",
    "en-US": "English (United States)",
    "fo-FO": "Faroese (Faroe Islands)",
    "fi-FI": "Finnish (Finland)",
    "fr-CA": "French (Canada)",
    "fr-FR": "French (France)",
    "de-AT": "German (Austria)",
    "de-DE": "German (Germany)",
    "el-GR": "Greek (Greece)",
    "he-IL": "Hebrew (Israel)",
    "it-IT": "Italian (Italy)",
    "nb-NO": "Norwegian Bokmål (Norway)",
    "pl-PL": "Polish (Poland)",
    "pt-BR": "Portuguese (Brazil)",
    "pt-PT": "Portuguese (Portugal)",
    "ru-RU": "Russian (Russia)",
    "sk-SK": "Slovak (Slovakia)",
    "sl-SI": "Slovenian (Slovenia)",
    "es-ES": "Spanish (Spain)",
    "es-US": "Spanish (United States)",
    "sv-SE": "Swedish (Sweden)",
    "uk-UA": "Ukrainian (Ukraine)",
    "cy-GB": "Welsh (United Kingdom)",
    "zh-CN": "Chinese (China)",
    "ja-JP": "Japanese (Japan)",
    "ko-KR": "Korean (Korea)",
}


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it by name in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def literal_map(values: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def word_count(c: Column | str) -> Column:
    """Number of whitespace-separated words; null and blank text count 0."""
    trimmed = F.regexp_replace(F.coalesce(as_column(c), F.lit("")), r"(?U)^\s+|\s+$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(
        F.size(F.split(trimmed, r"(?U)\s+"))
    )


def is_aac_speaker(c: Column | str) -> Column:
    """True when the speaker's name carries the (case-sensitive) AAC mark."""
    return F.coalesce(F.contains(as_column(c), F.lit("AAC")), F.lit(False))


def minimally_corrected(c: Column | str) -> Column:
    """Capital first letter and a closing mark; nothing else changes."""
    c = as_column(c)
    capital = F.when(
        c.rlike(r"^\p{L}"), F.concat(F.upper(F.left(c, F.lit(1))), F.substr(c, F.lit(2)))
    ).otherwise(c)
    closed = c.rlike(r"[.!?]\z")
    return F.when((c == "") | closed, capital).otherwise(F.concat(capital, F.lit(".")))


def fully_corrected(intended: Column | str) -> Column:
    """The correction rules applied to the intended text; what was typed plays no part."""
    return minimally_corrected(intended)


def locale_base(c: Column | str) -> Column:
    """``en`` of ``en-GB``."""
    return F.split_part(as_column(c), F.lit("-"), F.lit(1))


def language_name(c: Column | str, names: Mapping[str, str] | None = None) -> Column:
    """Display name without the country; an unknown code names itself."""
    c = as_column(c)
    full = F.try_element_at(literal_map(names or LANGUAGE_NAMES), c)
    return F.split_part(F.coalesce(full, c), F.lit(" ("), F.lit(1))


def fill_people(
    c: Column | str, user: Column | str, partner: Column | str, lang: Column | str | None = None
) -> Column:
    """Put names in place of the person tokens of the row's language."""
    c, user, partner = as_column(c), as_column(user), as_column(partner)

    def named(tokens: tuple[str, str]) -> Column:
        x, y = tokens
        return F.replace(F.replace(c, F.lit(x), user), F.lit(y), partner)

    filled = named(PERSON_TOKENS["en"])
    if lang is None:
        return filled
    for code, tokens in PERSON_TOKENS.items():
        if code != "en":
            filled = F.when(as_column(lang).eqNullSafe(F.lit(code)), named(tokens)).otherwise(filled)
    return filled


def fill_blank(c: Column | str, name: Column | str) -> Column:
    """Put ``name`` in place of every ``___``."""
    return F.replace(as_column(c), F.lit("___"), as_column(name))


def render(template: Column | str, values: Column, single_brace: bool = False) -> Column:
    """Fill ``{{ name }}`` holes from a map column in one pass.

    Unknown names become empty. A value is never scanned again, so holes inside
    values stay as they are. ``single_brace`` also fills ``{ name }``.
    """
    hole = r"\{\{\s*([A-Za-z_]\w*)\s*\}\}"
    if single_brace:
        hole = r"\{?\{\s*([A-Za-z_]\w*)\s*\}\}?"

    def filled(row: Column) -> Column:
        def value(name: Column) -> Column:
            known = F.try_element_at(row["values"], F.coalesce(name, F.lit("")))
            return F.coalesce(known, F.lit(""))

        between = F.split(row["template"], hole)
        names = F.regexp_extract_all(row["template"], F.lit(hole), F.lit(1))
        parts = F.zip_with(between, names, lambda text, name: F.concat(text, value(name)))
        return F.array_join(parts, "")

    trimmed = F.regexp_replace(as_column(template), r"\n\z", "")
    return let(F.struct(trimmed.alias("template"), values.alias("values")), filled)


def unfence_json(c: Column | str) -> Column:
    """Inside of a ``json`` fence, else of any fence, else the whole text."""
    c = as_column(c)
    tagged = F.regexp_extract(c, r"(?s)```json(.*?)(?:```|\z)", 1)
    plain = F.regexp_extract(c, r"(?s)```(.*?)(?:```|\z)", 1)
    return (
        F.when(F.contains(c, F.lit("```json")), F.trim(_flat_ends(tagged)))
        .when(F.contains(c, F.lit("```")), F.trim(_flat_ends(plain)))
        .otherwise(c)
    )


def _flat_ends(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def bracket_json(c: Column | str) -> Column:
    """From the first ``[`` to the last ``]``; empty when there is no such span."""
    return F.regexp_extract(as_column(c), r"(?s)\[.*\]", 0)


def numbered_lines(c: Column | str) -> Column:
    """Texts of the ``1. text`` lines, in line order; the printed number is ignored."""
    lines = F.split(_flat_ends(as_column(c)), "\n")
    kept = F.filter(lines, lambda l: l.rlike(r"^\d") & F.contains(l, F.lit(". ")))
    return F.transform(kept, lambda l: F.substr(l, F.instr(l, ". ") + 2))


def parse_custom_id(c: Column | str) -> Column:
    """``translate_{lang}_{field}_{batch}_…`` as a struct; null when it is not one."""
    parts = F.split(as_column(c), "_")
    batch = F.try_element_at(parts, F.lit(4)).try_cast("int")
    valid = (F.element_at(parts, 1) == "translate") & (F.size(parts) >= 4) & batch.isNotNull()
    return F.when(
        valid,
        F.struct(
            F.try_element_at(parts, F.lit(2)).alias("lang"),
            F.try_element_at(parts, F.lit(3)).alias("field"),
            batch.alias("batch_index"),
        ),
    )


def token_estimate(c: Column | str, overhead: int = 0, chars_per_token: int = 4) -> Column:
    """Rough token count: characters (plus a fixed overhead) divided by four, floored."""
    chars = F.length(F.coalesce(as_column(c), F.lit(""))) + F.lit(overhead)
    return F.floor(chars / F.lit(chars_per_token)).cast("long")


def over_token_limit(tokens: Column | str, limit: int, share: float = 0.8) -> Column:
    """True when an estimate uses more than ``share`` of the limit."""
    return as_column(tokens) > F.lit(limit * share)
