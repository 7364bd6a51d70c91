"""Columns that turn a triple, a template and picked values into a model request."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnloom.functions.text import as_column, fill_blank, fill_people, let

# What each relation says about the two people.
RELATION_PHRASES = {
    "xIntent": "what {user} intends by this",
    "xNeed": "what {user} needs for this",
    "xEffect": "the effect this has on {user}",
    "xReact": "how {user} reacts to this",
    "oEffect": "the effect this has on {partner}",
    "oReact": "how {partner} reacts to this",
    "xWant": "what {user} wants in this situation",
    "oWant": "what {partner} wants in this situation",
    "xAttr": "attributes of {user} in this context",
    "oAttr": "attributes of {partner} in this context",
}

# What a triple or a language leaves out.
DEFAULT_USER = "Alex"
DEFAULT_PARTNER = "Taylor"
DEFAULT_TOPIC = "daily care"
DEFAULT_RELATIONSHIP = "caregiver"
DEFAULT_SETTING = "home"
DEFAULT_ROLE = "person with ALS"
STYLE_KEYS = ("time_of_day", "tone", "aac_system", "aac_mlu_length", "writing_style")


def relation_phrase(
    relation: Column | str,
    user: Column | str,
    partner: Column | str,
    phrases: Mapping[str, str] | None = None,
) -> Column:
    """What the relation says, with names; null for a relation without a phrase."""
    pattern = F.try_element_at(
        F.create_map(*[F.lit(x) for kv in (phrases or RELATION_PHRASES).items() for x in kv]),
        as_column(relation),
    )
    with_user = F.replace(pattern, F.lit("{user}"), as_column(user))
    return F.replace(with_user, F.lit("{partner}"), as_column(partner))


def relation_context(phrase: Column | str, which: Column | str) -> Column:
    """``phrase: which``, or ``which`` alone."""
    which = as_column(which)
    return F.coalesce(F.concat(as_column(phrase), F.lit(": "), which), which)


def situation_text(topic: Column | str, which: Column | str, phrase: Column | str) -> Column:
    """One sentence per known part of the situation."""
    topic, which, phrase = as_column(topic), as_column(which), as_column(phrase)
    return F.concat_ws(
        ". ",
        F.when(topic != "", F.concat(F.lit("The conversation is about '"), topic, F.lit("'"))),
        F.when(which != "", F.concat(F.lit("where "), which)),
        phrase,
    )


def _or(c: Column, default: str) -> Column:
    return F.coalesce(c, F.lit(default))


def prompt_values(
    topic: Column | str,
    relation: Column | str,
    which: Column | str,
    picks: Column,
    lang: Column | str,
    role: Column | str | None = None,
) -> Column:
    """The map a template is rendered with.

    ``picks`` is a map of randomly picked substitution values (``aac_user``,
    ``partner`` and the style keys). A style key is only present when it was picked.
    ``setting`` and ``relationship`` are never picked.
    """
    topic, relation, which = as_column(topic), _or(as_column(relation), ""), as_column(which)
    role = F.lit(None).cast("string") if role is None else as_column(role)

    def pick(picks: Column, key: str) -> Column:
        return F.try_element_at(picks, F.lit(key))

    def with_people(row: Column) -> Column:
        def told(text: Column) -> Column:
            return fill_blank(fill_people(text, row["user"], row["partner"], lang), row["partner"])

        texts = F.struct(
            told(_or(topic, DEFAULT_TOPIC)).alias("topic"),
            told(_or(which, "")).alias("which"),
            relation_phrase(relation, row["user"], row["partner"]).alias("phrase"),
        )
        return let(texts, lambda texts: with_texts(row, texts))

    def with_texts(row: Column, texts: Column) -> Column:
        values = {
            "topic": texts["topic"],
            "relationship": F.lit(DEFAULT_RELATIONSHIP),
            "setting": F.lit(DEFAULT_SETTING),
            "aac_user": row["user"],
            "partner": row["partner"],
            "which": texts["which"],
            "relation": relation,
            "relation_context": relation_context(texts["phrase"], texts["which"]),
            "aac_user_role": _or(role, DEFAULT_ROLE),
            "atomic_context": situation_text(texts["topic"], texts["which"], texts["phrase"]),
            **{key: pick(row["picks"], key) for key in STYLE_KEYS},
        }
        pairs = [c for key, value in values.items() for c in (F.lit(key), value)]
        return F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())

    return let(
        picks,
        lambda picks: let(
            F.struct(
                picks.alias("picks"),
                _or(pick(picks, "aac_user"), DEFAULT_USER).alias("user"),
                _or(pick(picks, "partner"), DEFAULT_PARTNER).alias("partner"),
            ),
            with_people,
        ),
    )


def build_request(
    custom_id: Column | str,
    system: Column | str,
    user: Column | str,
    model: str = "gpt-4o-mini",
    temperature: float = 0.7,
    max_tokens: int = 1500,
) -> Column:
    """A chat-completion request as a struct; ``to_json`` of it is one line of a batch file."""

    def message(role: str, content: Column | str) -> Column:
        return F.struct(F.lit(role).alias("role"), as_column(content).alias("content"))

    body = F.struct(
        F.lit(model).alias("model"),
        F.array(message("system", system), message("user", user)).alias("messages"),
        F.lit(temperature).alias("temperature"),
        F.lit(max_tokens).alias("max_tokens"),
        F.struct(F.lit("json_object").alias("type")).alias("response_format"),
    )
    return F.struct(
        as_column(custom_id).alias("custom_id"),
        F.lit("POST").alias("method"),
        F.lit("/v1/chat/completions").alias("url"),
        body.alias("body"),
    )


def prompt_of(body: Column | str) -> Column:
    """The user message of a request body."""
    return F.get(as_column(body).getField("messages"), F.lit(1)).getField("content")
