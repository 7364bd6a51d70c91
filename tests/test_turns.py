import pytest
from pyspark.sql import functions as F

from turnloom.operators import filters
from turnloom.operators import turns as t
from turnloom.operators.tasks import response_pairs
from turnloom.schemas import FLAT_COLUMNS, STORED_CONVERSATION


@pytest.fixture(scope="module")
def long_turns(spark):
    rows = [
        (c, i, f"s{i % 3}", i % 2 == 0, f"{c}-{i}", f"{c}-{i}")
        for c, n in (("a", 1), ("b", 5), ("c", 23), ("d", 40))
        for i in range(n)
    ]
    names = "conversation_id string, turn_number int, speaker string, is_aac_user boolean, "
    return spark.createDataFrame(rows, names + "utterance string, utterance_intended string")


@pytest.fixture(scope="module")
def nested(spark):
    turns = [
        ("Sam", "hi", None, True), ("Ann", "hello", None, False), ("Ann", None, None, None),
        ("Bob", "yes", "x", False), ("Sam", "bye", "Good bye", True),
    ]
    rows = [
        ("en_1", "en-GB", 7, "home", turns, (3, "en-GB", "now", "p", "m")),
        ("en_2", "en-GB", None, None, [("Sam", "one", "One", True)], None),
        ("en_3", "en-GB", None, None, [("Ann", "none", None, False)], None),
        ("en_4", "en-GB", None, None, [], None),
    ]
    schema = "conversation_id string, language_code string, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in STORED_CONVERSATION.fields
    )
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("block", [3, 4, 10, 4096])
def test_windows_do_not_depend_on_blocks(long_turns, block):
    rows = t.with_surroundings(long_turns, 3, block=block).collect()
    assert len(rows) == 69
    by_place = {(r.conversation_id, r.turn_number): r for r in rows}
    for (c, i), r in by_place.items():
        before = [by_place[c, j] for j in range(max(0, i - 3), i)]
        after = by_place.get((c, i + 1))
        assert r.context_utterances == [b.utterance for b in before]
        assert r.context_speakers == [b.speaker for b in before]
        assert r.next_turn_utterance == (after.utterance if after else "")
        assert r.next_turn_speaker == (after.speaker if after else "")


def test_context_and_next_alone(long_turns):
    context = t.with_context(long_turns, block=5).filter("conversation_id = 'b'")
    assert [len(r.context_speakers) for r in context.orderBy("turn_number").collect()] == [
        0, 1, 2, 3, 3,
    ]
    following = t.with_next(long_turns, block=5).filter("conversation_id = 'b'")
    assert [r.next_turn_utterance for r in following.orderBy("turn_number").collect()] == [
        "b-1", "b-2", "b-3", "b-4", "",
    ]


def test_nested_flatten(nested):
    flat = t.flatten_examples(nested)
    assert flat.columns == FLAT_COLUMNS and len(FLAT_COLUMNS) == 28
    assert dict(flat.dtypes)["context_speakers"] == "array<string>"
    assert "Exchange" not in flat._jdf.queryExecution().executedPlan().toString()
    rows = {(r.conversation_id, r.turn_number): r for r in flat.collect()}
    assert sorted(rows) == [("en_1", 0), ("en_1", 4), ("en_2", 0)]
    first, last, alone = rows["en_1", 0], rows["en_1", 4], rows["en_2", 0]
    assert first.context_speakers == [] and first.next_turn_utterance == "hello"
    assert first.utterance_intended == "hi" and last.utterance_intended == "Good bye"
    assert last.context_speakers == ["Ann", "Ann", "Bob"]
    assert last.context_utterances == ["hello", "", "yes"] and last.next_turn_speaker == ""
    assert (first.template_id, first.model, first.provider) == (3, "m", "p")
    assert (alone.template_id, alone.model, alone.provider) == (-1, "unknown", "unknown")


def test_nested_and_turns_flatten_alike(long_turns, spark):
    nested = long_turns.groupBy("conversation_id").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("turn_number", "speaker", "is_aac_user",
                                                 "utterance", "utterance_intended"))),
            lambda x: x.dropFields("turn_number"),
        ).alias("conversation")
    ).withColumn("language_code", F.lit("en"))
    a = t.flatten_examples(nested)
    b = t.flatten_turns(long_turns.withColumn("language_code", F.lit("en")))
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_conversation_ids(spark):
    rows = [(lang, i) for lang, n in (("en", 50), ("fr", 3), ("de", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "language_code string, pos int").repartition(5)
    out = t.assign_conversation_id(df, ["pos"]).collect()
    assert all(r.conversation_id == f"{r.language_code}_{r.pos + 1}" for r in out)
    assert len(out) == 54


def test_explode_turns(nested):
    rows = t.explode_turns(nested.select("conversation_id", "conversation"))
    assert [r.turn_number for r in rows.filter("conversation_id = 'en_1'").collect()] == list(
        range(5)
    )


def test_fill_and_strip(nested):
    filled = filters.strip_partner_intended(filters.fill_intended(nested)).filter(
        "conversation_id = 'en_1'"
    )
    turns = filled.first().conversation
    assert [x.utterance_intended for x in turns] == ["hi", None, None, None, "Good bye"]


def test_rebuild_and_render(long_turns, nested):
    rows = t.rebuild(t.with_next(long_turns), "b").collect()
    assert [r.turn_number for r in rows] == list(range(5))
    assert rows[0].line == "s0: b-0" and rows[0].next_line == "s1: b-1"
    assert rows[-1].next_line is None
    text = t.render_conversations(nested).filter("conversation_id = 'en_2'").first().rendered
    assert text == "Sam (AAC User):\n  Intended: One\n  Actual: one"
    shown = t.render_conversations(nested).filter("conversation_id = 'en_1'").first().rendered
    assert shown.startswith("SCENE: home\n\nSam (AAC User):")


def test_response_pairs(nested):
    pairs = response_pairs(t.flatten_examples(nested)).collect()
    assert [(p.conversation_id, p.turn_number, p.response) for p in pairs] == [
        ("en_1", 0, "Ann: hello")
    ]


def test_kg_filters(spark):
    df = spark.createDataFrame(
        [(1, "plants seed", "xNeed", "a"), (2, "sees", "xNeed", "None"), (3, "sees", "xNeed", "NONE"),
         (4, "rows", "xNeed", "a"), (5, "We EAT", "isAfter", "b"), (6, "eats", "xWant", "b")],
        "pos int, head string, relation string, tail string",
    )
    kept = filters.drop_none_tail(filters.filter_keywords(filters.filter_relations(df)))
    assert [r.pos for r in kept.orderBy("pos").collect()] == [1, 5]
    entry = filters.to_entries(kept).orderBy("topic").first()
    assert entry.asDict() == {
        "topic": "We EAT", "relation": "isAfter", "aac_user": "Alex", "partner": "Taylor",
        "aac_user_role": "person with ALS", "which": "b",
    }
    assert len(filters.KEYWORDS) == 100 and len(set(filters.KEYWORDS)) == 97


def test_limit_takes_the_first_rows(spark):
    df = spark.range(100).withColumn("pos", 99 - F.col("id")).repartition(4)
    assert filters.limit_entries(df, 0, ["pos"]).count() == 100
    assert {r.pos for r in filters.limit_entries(df, 30, ["pos"]).collect()} == set(range(30))
    tied = df.withColumn("pos", F.lit(1))
    for parts in (1, 7):
        kept = filters.limit_entries(tied.repartition(parts), 10, ["pos"]).collect()
        assert {r.id for r in kept} == set(range(10))


@pytest.mark.parametrize("block", [1, 2, 4, 4096])
def test_gaps_and_missing_numbers(spark, block):
    numbers = {
        "gaps": [3, 5, 4096, 4097, 9000, 20_000],
        "none": [None, 0, 1, 7, 8],
        "one": [70_000],
        None: [2, 4100],
    }
    rows = [(c, n, "s", f"{c}-{n}") for c, ns in numbers.items() for n in ns]
    df = spark.createDataFrame(
        rows, "conversation_id string, turn_number int, speaker string, utterance string"
    ).repartition(3)
    for n in (0, 1, 3):
        got = {
            (r.conversation_id, r.turn_number): (r.context_utterances, r.next_turn_utterance)
            for r in t.with_surroundings(df, n, block=block).collect()
        }
        assert got == {
            (c, x): (
                [f"{c}-{y}" for y in ns[max(0, i - n) : i]],
                f"{c}-{ns[i + 1]}" if i + 1 < len(ns) else "",
            )
            for c, ns in numbers.items()
            for i, x in enumerate(ns)
        }


def test_generator_language_and_locale_filters(spark):
    df = spark.createDataFrame(
        [("ollama", "mistral", "en-GB"), ("ollama", "x", "fr-FR"), ("gemini", "g", "en")],
        "provider string, model string, language_code string",
    )
    assert filters.by_generator(df, "ollama").count() == 2
    assert filters.by_generator(df, "ollama", "mistral").count() == 1
    assert filters.by_language(df, prefix="en").count() == 2
    assert filters.by_language(df, "fr-FR").count() == 1
    codes = spark.createDataFrame([(c,) for c in ["en", "en-GB", "fo-FO", "fr-FR"]], "lang_code string")
    assert [r[0] for r in filters.eligible_locales(codes).collect()] == ["fr-FR"]


def test_attach_generation(spark):
    df = spark.createDataFrame([(1,), (None,)], "template_id int")
    out = filters.attach_generation(df, "en", "openai", "m", F.lit(9), F.lit("now"))
    rows = out.collect()
    assert [r.template_id for r in rows] == [1, 9]
    assert rows[0].metadata.asDict() == {
        "lang_code": "en", "generated_at": "now", "provider": "openai", "model": "m",
    }
