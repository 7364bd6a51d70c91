from pyspark.sql import functions as F

from turnloom.functions import text
from turnloom.functions.keyboard import ABC_ORDER, adjacency, key_grid, neighbours
from turnloom.functions.prompts import (
    build_request,
    prompt_of,
    prompt_values,
    relation_context,
    relation_phrase,
    situation_text,
)


def test_word_count(column):
    values = [None, "", " a  b ", "a b", "日本語 です", "   "]
    assert column(text.word_count, values) == [0, 0, 2, 2, 2, 0]


def test_aac_speaker_is_case_sensitive(column):
    names = ["Sam (AAC)", "sam (aac)", "Speaker-AAC", None]
    assert column(text.is_aac_speaker, names) == [True, False, True, False]


def test_minimal_correction(column):
    values = ["need water", "ok!", "", "9 pills", "élan", "Why?", None]
    assert column(text.minimally_corrected, values) == [
        "Need water.", "Ok!", "", "9 pills.", "Élan.", "Why?", None,
    ]


def test_language_names(column):
    assert column(text.language_name, ["en-GB", "nb-NO", "xx"]) == [
        "English", "Norwegian Bokmål", "xx",
    ]
    assert column(text.locale_base, ["en-GB", "en"]) == ["en", "en"]


def test_people_and_blanks(spark):
    df = spark.createDataFrame(
        [("en-GB", "PersonX gives PersonY ___"), ("sl-SI", "OsebaX da oseboY ___ PersonX")],
        "lang string, c string",
    )
    filled = text.fill_blank(
        text.fill_people("c", F.lit("Ann"), F.lit("Bo"), "lang"), F.lit("Bo")
    )
    assert [r[0] for r in df.select(filled).collect()] == [
        "Ann gives Bo Bo", "Ann da Bo Bo PersonX",
    ]


def test_render_is_single_pass(column):
    values = F.create_map(F.lit("x"), F.lit("1"), F.lit("y"), F.lit("{{ x }}"))
    templates = ["A {{ x }} b {{y}} {{ z }}!", "{{x}}{{x}}", "", "a }} b", "none", "end {{ x }}"]
    assert column(lambda c: text.render(c, values), templates) == [
        "A 1 b {{ x }} !", "11", "", "a }} b", "none", "end 1",
    ]
    single = column(lambda c: text.render(c, values, single_brace=True), ["{ x } {{ x }}"])
    assert single == ["1 1"]


def test_unfence(column):
    values = ["x ```json\n[1]\n``` y", "```\n[2]\n```", "[3]", "```json [4]"]
    assert column(text.unfence_json, values) == ["[1]", "[2]", "[3]", "[4]"]


def test_bracket(column):
    assert column(text.bracket_json, ["x [1,2] y [3] z", "none"]) == ["[1,2] y [3]", ""]


def test_numbered_lines(column):
    value = "\n1. foo\n2. b. c\nnote\n3.x\n10. z\n"
    assert column(text.numbered_lines, [value]) == [["foo", "b. c", "z"]]


def test_custom_id(column):
    parsed = column(
        text.parse_custom_id,
        ["translate_fr-FR_topic_3_99.1", "other_1", "translate_fr", "translate_a_b_x_1"],
    )
    assert tuple(parsed[0]) == ("fr-FR", "topic", 3)
    assert parsed[1:] == [None, None, None]


def test_tokens(column):
    assert column(text.token_estimate, ["", "abc", "abcd", None]) == [0, 0, 1, 0]
    assert column(lambda c: text.token_estimate(c, overhead=500), ["abcd"]) == [126]


def test_grids():
    assert key_grid("qwerty")[1] == list("ASDFGHJKLZ")
    assert key_grid("abc")[2] == list("UVWXYZ_") + ["", "", ""]
    assert "".join(sum(key_grid("frequency"), [])) == "_ETAOINSRHDLUCMFYWGPBVKXQJZ"
    assert key_grid({"a": 2, "b": 5, " ": 3}, 1, 4) == [["B", "_", "A", ""]]
    assert sorted(adjacency(key_grid("abc"))) == sorted(ABC_ORDER)


def test_neighbours(column):
    grid = key_grid("qwerty")
    got = column(lambda c: neighbours(c, grid), ["Q", "q", " ", "7", "é"])
    assert got == [["W", "A", "S"], ["W", "A", "S"], ["H", "J", "K", "M"], [], []]


def test_relation_phrase_and_context(column):
    def context(c):
        return relation_context(relation_phrase(c, F.lit("Ann"), F.lit("Bo")), F.lit("w"))

    assert column(context, ["xNeed", "oReact", "isAfter"]) == [
        "what Ann needs for this: w", "how Bo reacts to this: w", "w",
    ]


def test_situation(column):
    assert column(lambda c: situation_text(c, F.lit("w"), F.lit(None)), ["t", ""]) == [
        "The conversation is about 't'. where w", "where w",
    ]


def test_prompt_values(spark):
    picks = F.create_map(F.lit("tone"), F.lit("calm"), F.lit("setting"), F.lit("ignored"))
    values = prompt_values(
        F.lit("PersonX asks ___"), F.lit("xNeed"), F.lit("PersonY"), picks, F.lit("en-GB")
    )
    got = spark.range(1).select(values.alias("v")).first().v
    assert got["topic"] == "Alex asks Taylor" and got["which"] == "Taylor"
    assert got["setting"] == "home" and got["relationship"] == "caregiver"
    assert got["tone"] == "calm" and "writing_style" not in got
    assert got["aac_user_role"] == "person with ALS"
    empty = prompt_values(F.lit(None), F.lit(None), F.lit(None), picks, F.lit("en"))
    assert spark.range(1).select(empty["topic"]).first()[0] == "daily care"


def test_request(spark):
    request = build_request(F.lit("id_1"), F.lit("sys"), F.lit("usr"))
    df = spark.range(1).select(request.alias("r"))
    assert df.select(prompt_of("r.body")).first()[0] == "usr"
    assert df.select(F.to_json("r")).first()[0].startswith(
        '{"custom_id":"id_1","method":"POST","url":"/v1/chat/completions"'
    )
