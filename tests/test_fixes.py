"""Inputs that earlier rules mishandled."""

from pyspark.sql import functions as F

from turnloom.functions.response import repair_json
from turnloom.operators import joins, translation
from turnloom.plans.jobs import process_responses, read_responses
from turnloom.sources import readers

ENVELOPE = (
    '{"custom_id":"%s","response":{"status_code":200,"body":'
    '{"choices":[{"message":{"content":%s}}]}}}'
)


def test_triples_are_judged_whole(spark, write):
    path = write("t.tsv", "a\tr\tb\nc\td\ne\tr\tf\tg\n")
    rows = readers.read_triples(spark, path)
    assert [r.head for r in rows.select("head").collect()] == ["a"]
    assert rows.count() == 1


def test_last_of_repeated_keys(spark, write):
    path = write("l.jsonl", '{"a":1,"a":2}\n{"a":3} x\n')
    good, bad = readers.read_jsonl_tolerant(spark, path, spark.createDataFrame([], "a long").schema)
    assert [r.a for r in good.collect()] == [2]
    assert bad.count() == 1


def test_repair_does_not_count_blanks(column):
    blanks = " " * 30
    text = '{scene:%s" [x] y"}' % blanks
    assert column(lambda c: repair_json(c), [text]) == ['{"scene":%s" [x] y"}' % blanks]


def test_two_texts_for_one_place(spark):
    df = spark.createDataFrame([(1, "a")], "id long, head string")
    texts = spark.createDataFrame([(1, "head", "z"), (1, "head", "y")], "id long, path string, text string")
    assert [r.head for r in translation.put_back(df, "id", texts, ["head"]).collect()] == ["y"]


def test_copies_of_a_combination_are_one_row(spark):
    rows = [(1, {"k": "v"}, 2, "b"), (1, {"k": "v"}, 1, "c")]
    cand = spark.createDataFrame(rows, "template_id long, substitutions map<string,string>, n long, s string")
    got = joins.new_combinations(cand, cand.limit(0))
    assert [(r.n, r.s) for r in got.collect()] == [(1, "c")]


def test_every_response_is_stored_or_rejected(spark):
    good = '"{\\"scene\\":\\"s\\",\\"conversation\\":[]}"'
    lines = [
        (ENVELOPE % ("a_1", good),),
        (ENVELOPE % ("zz_9", good),),
        (ENVELOPE % ("b_2", '"{\\"other\\":1}"'),),
        ("no json",),
    ]
    df = spark.createDataFrame(lines, "value string")
    meta = spark.createDataFrame([("a_1", 1, "m"), ("b_2", 2, "m")], "custom_id string, line_no int, model string")
    stored, rejects = process_responses(df, meta)
    assert [r.custom_id for r in stored.collect()] == ["a_1"]
    errors = {r.custom_id: r.error for r in rejects.collect()}
    assert errors == {"zz_9": "no metadata", "b_2": "no conversation", None: "missing custom_id"}
    assert read_responses(df).filter(F.col("status") == "ok").count() == 2


def test_language_is_the_name_before_the_dot(spark, column):
    got = column(lambda c: readers.language_of(F.col(c)), ["x/conversations.jsonl", "x/a_en-GB.jsonl"])
    assert got == ["conversations", "en-GB"]


def test_repeated_ids_are_read_alike_everywhere(spark):
    body = '{"choices": [{"message": {"content": "{\\"conversation\\": []}"}}]}'
    line = f'{{"custom_id": "x_1", "custom_id": "en_7_long", "response": {{"body": {body}}}}}'
    lines = spark.createDataFrame([(1, line)], "line_no long, value string")
    meta = spark.createDataFrame([("en_7", 1, "m1")], "custom_id string, line_no long, model string")
    stored, rejects = process_responses(lines, meta)
    assert [(r.custom_id, r.matched_id) for r in stored.collect()] == [("en_7_long", "en_7")]
    assert rejects.collect() == []


def test_other_queries_stand_without_the_corpus_operators(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    for name in ("turnloom", "checks", "__spark_entry__.py", "corpus_pipeline.py"):
        source = root / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        elif source.exists():
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; print(len(e.queries()), [n for n in e.queries() if n.startswith('op')])"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert done.stdout.strip().endswith("[]") and "pipeline" not in done.stdout
