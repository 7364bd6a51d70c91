"""Noise inside nested conversations, by language."""

from pyspark.sql import functions as F

from turnloom.functions.keyboard import key_grid
from turnloom.operators.turns import explode_turns
from turnloom.plans.jobs import augment_conversations, augment_turns
from turnloom.schemas import LAYOUTS, noisy_columns

TURN = "struct<speaker string, utterance string, utterance_intended string, is_aac_user boolean, x int>"
ROWS = [
    ("c1", "en-GB", [("A", "can you help me", "Can you help me?", True, 1), ("B", "yes", None, False, 2),
                     ("A", "thanks", None, True, None), ("A", None, None, True, 3), ("A", "", None, None, 4)]),
    ("c2", "de", [("A", "guten tag", "Guten Tag!", True, 5)] * 3),
    ("c3", None, [("A", "no language here", None, True, 6)]),
    ("c4", "fr", []), ("c5", "fr", None),
    (None, "de-AT", [("A", "grüße", None, True, 7)]),
]


def conversations(spark):
    rows = spark.createDataFrame(ROWS, f"conversation_id string, language_code string, conversation array<{TURN}>")
    return rows.withColumn("uid", F.lit("kept"))


def test_same_noise_as_of_the_turns(spark):
    nested = conversations(spark).filter("conversation_id is not null")
    forms = [*noisy_columns(), "minimally_corrected", "fully_corrected"]
    found = explode_turns(augment_conversations(nested)).select("conversation_id", "turn_number", "x", *forms)
    wanted = augment_turns(explode_turns(nested)).select("conversation_id", "turn_number", "x", *forms)
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
    assert found.count() == 9


def test_each_language_has_its_grids(spark):
    german = {name: key_grid([*"ÜÖÄSTRAE_NID"]) for name in LAYOUTS}
    plain = {r.conversation_id: r for r in augment_conversations(conversations(spark)).collect()}
    own = {r.conversation_id: r for r in augment_conversations(conversations(spark), grids={"de": german}).collect()}
    assert len(own) == len(ROWS) and all(r.uid == "kept" for r in own.values())
    for key in ("c1", "c3", "c4", "c5"):
        assert own[key] == plain[key]
    assert own["c5"].conversation is None and own["c4"].conversation == []
    alone = {c: r for c in ("c2", None) for r in [own[c]]}
    for key, row in alone.items():
        changed = [t.noisy_qwerty_severe for t in row.conversation]
        assert changed != [t.noisy_qwerty_severe for t in plain[key].conversation]
        letters = set("".join(changed)) - set("".join(t.utterance for t in row.conversation))
        assert letters <= set("üöästrae nidÜÖÄSTRAE_NID")
    assert plain["c1"].conversation[1].noisy_qwerty_severe is None
    assert plain["c1"].conversation[0].fully_corrected == "Can you help me?"


def test_nothing_is_exploded_or_moved(spark):
    plan = augment_conversations(conversations(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan and plan.count("ArrowEvalPython [") == 1
