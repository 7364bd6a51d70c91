import json

from pyspark.sql import functions as F

from turnloom.functions import response
from turnloom.plans.jobs import process_responses, read_responses

TALK = {"template_id": 1, "scene": "s", "conversation": [
    {"speaker": "A", "utterance": "hi: there", "is_aac_user": True},
    {"speaker": "B", "utterance": "yes", "utterance_intended": "x", "is_aac_user": False}]}


def envelope(body, id_="en_1", **extra):
    return json.dumps({"id": "r", "custom_id": id_, "response": {"status_code": 200, "body": body}, **extra})


def parsed(make):
    return lambda c: make(F.try_parse_json(c))


def test_content_places(column):
    lines = [
        envelope({"choices": [{"message": {"content": "m"}}]}),
        envelope({"choices": [{"text": "t"}]}),
        envelope(json.dumps({"choices": [{"message": {"content": "s"}}]})),
        envelope({"id": "x", "object": "chat.completion", "content": "c", "choices": []}),
        envelope({"choices": [{"index": 0, "delta": {"content": "n"}}]}),
        envelope(None),
        envelope("broken {"),
        json.dumps({"custom_id": "a", "choices": [{"message": {"content": "top"}}]}),
        json.dumps({"custom_id": "a", "metadata": {"response": {"choices": [{"text": "raw"}]}}}),
        json.dumps({"custom_id": "a", "body": json.dumps({"choices": [{"text": "req"}]})}),
        "not json",
    ]
    assert column(parsed(response.response_content), lines) == [
        "m", "t", "s", "c", "n", None, None, "top", "raw", "req", None,
    ]


def test_formats(column):
    lines = [
        json.dumps({"method": "POST", "url": "u", "body": {}, "metadata": {}}),
        envelope({}),
        json.dumps({"id": "i", "custom_id": "c", "response": {"body": {}}}),
        json.dumps({"response": {"body": {}}}),
        "x",
    ]
    assert column(parsed(response.response_format), lines) == [
        "raw_openai", "openai_batch_direct", "openai_batch_direct", "standard", None,
    ]


def test_parse(column):
    whole = json.dumps(TALK)
    texts = [whole, "[1]", '"text"', "{", whole + " more", "{}", whole + "]", whole + "} x", ""]
    got = column(response.parse_conversation, texts)
    assert got[0].template_id == 1 and got[0].conversation[0].utterance == "hi: there"
    assert got[0].conversation[0].utterance_intended is None
    assert [g is None for g in got] == [False, True, True, True, True, False, True, True, True]


def test_repair(column):
    texts = [
        "{a: 1, b: [1,],}", '{"a":', '{"a": "x" "b": 2}', '[{"a":1} {"b":2}]', '{"a": "", "b": " "}',
        '{"a": ["x" "y"]}', '{"a": "x y',
    ]
    fixed = column(response.repair_json, texts)
    values = [None if f is None else json.loads(f) for f in fixed]
    assert values == [
        {"a": 1, "b": [1]}, None, {"a": "x", "b": 2}, [{"a": 1}, {"b": 2}], {"a": "", "b": " "},
        {"a": ["x", "y"]}, None,
    ]


def test_process(spark):
    bare = json.dumps(TALK).replace('"scene":', "scene:").replace("hi: there", "hi there")
    lines = [
        (1, envelope({"choices": [{"message": {"content": json.dumps(TALK)}}]}, "en_1")),
        (2, envelope({"choices": [{"message": {"content": "```json\n" + bare + "\n```"}}]}, "en_2_x")),
        (3, envelope({"choices": [{"message": {"content": '{"scene": "cut'}}]}, "en_3")),
        (4, envelope(None, "en_4")),
        (5, json.dumps({"id": "r", "response": {"body": {"choices": [{"text": "{}"}]}}})),
        (6, "broken line"),
        (7, envelope({"choices": [{"text": json.dumps(TALK)}]}, "zz")),
    ]
    df = spark.createDataFrame(lines, "line_no int, value string")
    meta = spark.createDataFrame(
        [("en_1", 1, "old"), ("en_1", 2, "new"), ("en_2", 3, None)],
        "custom_id string, line_no int, model string",
    )
    stored, rejects = process_responses(df, meta)
    rows = {r.custom_id: r for r in stored.collect()}
    assert sorted(rows) == ["en_1", "en_2_x"]
    assert rows["en_1"].metadata.model == "new" and rows["en_1"].status == "ok"
    assert rows["en_2_x"].matched_id == "en_2" and rows["en_2_x"].status == "recovered"
    assert rows["en_2_x"].metadata.model == "gpt-4-turbo"
    turns = rows["en_1"].conversation
    assert [t.utterance_intended for t in turns] == ["hi: there", None]
    bad = {r.custom_id: (r.error, r.content) for r in rejects.filter("custom_id is not null").collect()}
    assert bad["en_3"] == ("invalid JSON", '{"scene": "cut') and bad["en_4"][0] == "no content"
    unnamed = {r.content for r in rejects.filter("custom_id is null").collect()}
    assert unnamed == {"{}", "broken line"}
    statuses = {r.line_no: r.status for r in read_responses(df).collect()}
    assert statuses == {1: "ok", 2: "recovered", 3: "error", 4: "error", 5: "error", 6: "error", 7: "ok"}


def test_request_twins(spark):
    from turnloom.plans.jobs import build_request_table, request_twins

    templates = spark.createDataFrame([(0, "On {{ topic }}")], "template_id int, template string")
    entries = spark.createDataFrame(
        [(1, "PersonX eats", "xNeed", "food", None)],
        "pos int, topic string, relation string, which string, aac_user_role string",
    )
    subs = spark.createDataFrame([("aac_user", ["Ann"])], "key string, values array<string>")
    table = build_request_table(
        3, "fr-FR", templates, entries, ["pos"], subs, "Write {{ language }}.", created_at="now"
    )
    submitted, kept = request_twins(table)
    assert submitted.columns == ["custom_id", "method", "url", "body"]
    row = kept.orderBy("custom_id").first()
    assert row.custom_id == "batch_0" and row.metadata.created_at == "now"
    assert [m.content for m in row.body.messages] == ["Write French.", "On Ann eats"]
