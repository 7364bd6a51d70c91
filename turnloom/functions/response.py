"""Reading model responses: where the content is, what it parses to, how to repair it."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from turnloom.functions.text import as_column, let, unfence_json
from turnloom.schemas import CONVERSATION

# No JSON text holds this character unescaped.
_OPENING = "\x01"


def allow_repeated_keys(spark: SparkSession) -> None:
    """Let the session's parser take the last of repeated keys, as JSON readers commonly do."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def _has(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant").isNotNull()


def _text(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def _variant(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def strict_json(text: Column | str) -> Column:
    """The text as a variant; null unless the whole of it is one JSON value.

    Spark's parser stops after the first value. Inside brackets a trailing remainder is an
    error unless it starts with ``]``, inside braces unless it starts with ``}``, so both
    together leave no remainder.
    """
    text = as_column(text)
    in_braces = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    in_brackets = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    return F.when(in_braces.isNotNull(), F.try_variant_get(in_brackets, "$[0]", "variant"))


def response_format(v: Column | str) -> Column:
    """Which of the known envelope shapes a parsed response line has."""
    v = as_column(v)
    raw = _has(v, "$.method") & _has(v, "$.url") & _has(v, "$.body") & _has(v, "$.metadata")
    inner = _has(v, "$.response.body")
    direct = inner & (_has(v, "$.response.status_code") | (_has(v, "$.id") & _has(v, "$.custom_id")))
    return (
        F.when(v.isNull(), F.lit(None).cast("string"))
        .when(raw, F.lit("raw_openai"))
        .when(direct, F.lit("openai_batch_direct"))
        .otherwise(F.lit("standard"))
    )


def response_body(v: Column | str) -> Column:
    """The completion inside the envelope; a body given as a JSON string is parsed."""
    v = as_column(v)
    inner = F.coalesce(_variant(v, "$.response.body"), _variant(v, "$.metadata.response"))
    as_text = F.when(F.schema_of_variant(inner) == "STRING", inner.cast("string"))
    request_body = _variant(v, "$.body")
    body_text = F.when(F.schema_of_variant(request_body) == "STRING", request_body.cast("string"))
    return F.coalesce(
        strict_json(as_text),
        F.when(as_text.isNull(), inner),
        F.when(_has(v, "$.choices"), v),
        strict_json(body_text),
    )


def body_content(body: Column | str) -> Column:
    """Content of the first choice, wherever the choice keeps it; null when there is none."""
    body = as_column(body)
    fields = F.try_variant_get(body, "$.choices[0]", "map<string, variant>")
    nested = F.filter(
        F.transform(F.map_values(fields), lambda f: _text(f, "$.content")),
        lambda content: content.isNotNull(),
    )
    whole_completion = (
        ~_has(body, "$.choices[0]")
        & _has(body, "$.id")
        & (_text(body, "$.object") == "chat.completion")
    )
    return F.coalesce(
        _text(body, "$.choices[0].message.content"),
        _text(body, "$.choices[0].text"),
        F.get(nested, F.lit(0)),
        F.when(whole_completion, _text(body, "$.content")),
    )


def response_content(v: Column | str) -> Column:
    """Content text of a parsed response line."""
    return body_content(response_body(v))


def parse_conversation(content: Column | str) -> Column:
    """The content as a conversation struct; null when it is not a JSON object."""
    return F.try_variant_get(strict_json(content), "$", CONVERSATION.simpleString())


def repair_json(content: Column | str) -> Column:
    """Five text rewrites for common faults; null unless the result parses.

    Bare keys get quotes, escapes are mended, missing commas inserted, trailing commas
    dropped, and an odd quote count gets a closing quote. Only use it after a plain
    parse has failed: a bare-key rewrite also hits ``word:`` inside strings. A comma is
    put after a quote only when that quote closes a value, so ``""`` stays empty.
    """
    text = F.regexp_replace(
        as_column(content), r"(?<![a-zA-Z0-9_])([a-zA-Z0-9_]++)(\s*+:)", r'"$1"$2'
    )
    text = F.replace(text, F.lit('\\"'), F.lit('"'))
    text = F.regexp_replace(text, r'([^\\])\\([^"\\/bfnrtu])', r"$1\\\\$2")
    text = F.regexp_replace(text, r'([}\]])(\s*+)(?=["{\[])', "$1,$2")
    # a quote behind a colon, comma or bracket opens a value; it stands aside meanwhile
    text = F.regexp_replace(text, r'([:,\[{]\s*+)"', f"$1{_OPENING}")
    text = F.regexp_replace(text, rf'"(\s++)(?=["{_OPENING}{{\[])', '",$1')
    text = F.replace(text, F.lit(_OPENING), F.lit('"'))
    text = F.regexp_replace(text, r",(\s*[\]}])", "$1")

    def closed(text: Column) -> Column:
        quotes = F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))
        return F.when(quotes % 2 == 1, F.concat(text, F.lit('"'))).otherwise(text)

    return let(
        let(text, closed), lambda fixed: F.when(strict_json(fixed).isNotNull(), fixed)
    )


def clean_content(content: Column | str) -> Column:
    """Content without a code fence around it."""
    return unfence_json(content)
