import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnloom.operators.stats import source_summary
from turnloom.plans.jobs import AUGMENTED_CONVERSATION, build_dataset, stats_report
from turnloom.schemas import FLAT_COLUMNS, STORED_CONVERSATION
from turnloom.sources import readers, writers
from turnloom.streaming.ingest import ingest_stream, resume

AB = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.ArrayType(T.IntegerType()))])


def lines_of(folder, pattern="part-*"):
    return [
        line
        for p in sorted(Path(folder).rglob(pattern))
        if p.suffix != ".crc"
        for line in p.read_text(encoding="utf-8").splitlines()
    ]


def test_strict_jsonl(spark, write):
    good = write("g.jsonl", '{"a":1}\n\n{"a":2,"b":[1]}\n')
    assert [r.a for r in readers.read_jsonl(spark, good, AB).collect()] == [1, 2]
    bad = write("b.jsonl", '{"a":1}\n{bad\n')
    with pytest.raises(Exception):
        readers.read_jsonl(spark, bad, AB).collect()


def test_tolerant_jsonl(spark, write):
    path = write("t.jsonl", '{"a":1}\n{bad\n\n{"a":2}\n{"a":3} x\n')
    good, bad = readers.read_jsonl_tolerant(spark, path, AB)
    assert [r.a for r in good.collect()] == [1, 2]
    assert [r.content for r in bad.collect()] == ["{bad", '{"a":3} x']
    assert bad.first().path.endswith("t.jsonl")


def test_json_array(spark, write):
    path = write("a.json", '[\n {"a": 1},\n {"a": 2, "b": [3]}\n]')
    assert sorted(r.a for r in readers.read_json_array(spark, path, AB).collect()) == [1, 2]
    for name, text in (("o.json", '{"a": 1}'), ("x.json", "nope")):
        with pytest.raises(Exception):
            readers.read_json_array(spark, write(name, text), AB).collect()


def test_records_of_any_shape(spark, write):
    shapes = {
        "l.json": '{"a": 1}\n\n{"a": 2}\n',
        "r.json": '[{"a": 1}, {"a": 2}]',
        "d.json": '{\n"data": [{"a": 1}, {"a": 2}]\n}',
    }
    for name, text in shapes.items():
        got = readers.read_records(spark, write(name, text), AB).collect()
        assert sorted(r.a for r in got) == [1, 2], name
    with pytest.raises(Exception):
        readers.read_records(spark, write("n.json", '{\n"other": 1\n}'), AB).collect()


def test_triples(spark, write):
    path = write("t.tsv", 'h1\tr1\tt1 \nh2\tr2\nh3\tr3\tt3\tx\n"a\tb"\tr4\t none \n')
    got = readers.read_triples(spark, [path, path + ".missing"]).collect()
    assert sorted(map(tuple, got)) == [("a\tb", "r4", "none"), ("h1", "r1", "t1")]


def talk(*turns, **more):
    return json.dumps({"conversation": [
        {"speaker": s, "utterance": u, "is_aac_user": aac} for s, u, aac in turns], **more},
        ensure_ascii=False)


def test_corpus_language(spark, write, tmp_path):
    write("n/aac_conversations_en-GB.jsonl", talk(("A", "hi", True)) + "\n")
    write("n/aac_conversations_x.y_fr.v2.jsonl", talk(("A", "hi", True)) + "\n")
    rows = readers.read_corpus(spark, f"{tmp_path}/n/aac_conversations_*", STORED_CONVERSATION)
    assert sorted(r.language_code for r in rows.collect()) == ["en-GB", "fr"]
    for folder in ("fr-FR", "language_generation", ".hidden"):
        write(f"p/{folder}/augmented_batch_conversations_a.jsonl", talk(("A", "x", True)) + "\n")
    rows = readers.read_corpus(
        spark, f"{tmp_path}/p/*/augmented_batch_conversations*.jsonl", STORED_CONVERSATION, "parent"
    )
    assert [r.language_code for r in rows.collect()] == ["fr-FR"]
    summary = source_summary(spark.read.schema(AB).json(f"{tmp_path}/n/*"))
    assert [r.records for r in summary.collect()] == [1, 1]


def test_templates_and_substitutions(spark, write, tmp_path):
    write("t/en.json", '["a", "b"]')
    write("t/fr.json", '{"templates": ["c"]}')
    write("t/de.json", '{"json": ["d"]}')
    write("t/xx.json", '{"other": 1}')
    got = readers.load_templates(spark, f"{tmp_path}/t").collect()
    assert sorted((r.lang_code, r.template_id, r.template) for r in got) == [
        ("de", 0, "d"), ("en", 0, "a"), ("en", 1, "b"), ("fr", 0, "c"),
    ]
    write("s/en-GB.json", '{"tone": ["calm", "glad"], "empty": []}')
    subs = readers.load_substitutions(spark, f"{tmp_path}/s").collect()
    assert [tuple(r) for r in subs] == [("en-GB", "tone", 0, "calm"), ("en-GB", "tone", 1, "glad")]


def test_list_files(spark, write, tmp_path):
    write("f/a_output.jsonl", "x")
    write("f/sub/b_output.jsonl", "xyz")
    write("f/c.txt", "x")
    files = readers.list_files(spark, f"{tmp_path}/f", "*_output.jsonl").collect()
    assert sorted((r.path.rsplit("/", 1)[1], r.size) for r in files) == [
        ("a_output.jsonl", 1), ("b_output.jsonl", 3),
    ]


def test_jsonl_sink_keeps_text(spark, tmp_path):
    df = spark.createDataFrame([("élan 日本", None)], "a string, b string")
    writers.write_jsonl(df, f"{tmp_path}/o")
    assert lines_of(f"{tmp_path}/o") == ['{"a":"élan 日本"}']
    writers.write_jsonl(df, f"{tmp_path}/n", keep_nulls=True)
    assert lines_of(f"{tmp_path}/n") == ['{"a":"élan 日本","b":null}']


def test_append_by_language_and_rejects(spark, tmp_path):
    df = spark.createDataFrame([("en-GB_1", 1), ("fr_2", 2)], "custom_id string, v int")
    for _ in range(2):
        writers.append_by_language(df, f"{tmp_path}/o")
    back = spark.read.json(f"{tmp_path}/o")
    assert back.filter("language_code = 'en-GB'").count() == 2
    bad = spark.createDataFrame([("1", "c", "broken")], "id string, custom_id string, content string")
    writers.write_rejects(bad, f"{tmp_path}/r")
    assert json.loads(lines_of(f"{tmp_path}/r")[0]) == {
        "id": "1", "custom_id": "c", "error": None, "content": "broken",
    }


def test_csv(spark, write, tmp_path):
    src = write("c.jsonl", '{"a":1,"b":[1]}\n{"a":2,"c":3}\nbad\n[1]\n{"a":"x,\\"y","b":null}\n')
    writers.jsonl_to_csv(spark, src, f"{tmp_path}/csv")
    assert lines_of(f"{tmp_path}/csv") == ["a,b", "1,[1]", "2,", '"x,""y",']
    df = spark.createDataFrame([(1, [1, 2], None)], "a int, b array<int>, c string").coalesce(1)
    writers.write_csv_flat(df, f"{tmp_path}/flat", ["b", "c", "a"])
    assert lines_of(f"{tmp_path}/flat") == ["b,c,a", '"[1,2]",,1']


def test_convert_tree(spark, write, tmp_path):
    write("src/en/x.json", '[{"a": 1}, {"a": 2}]')
    write("src/y.json", '[{"a": 3}]')
    write("src/en/bad.json", '{"a": 1}')
    write("src/en/broken.json", "{")
    write("src/en/skip.txt", "[]")
    bad = writers.convert_tree(spark, f"{tmp_path}/src", f"{tmp_path}/dst", AB)
    assert sorted((r.path.rsplit("/", 1)[1], r.error) for r in bad.collect()) == [
        ("bad.json", "not an array"), ("broken.json", "invalid JSON"),
    ]
    for name, values in (("en/x", [1, 2]), ("y", [3])):
        rows = spark.read.json(f"{tmp_path}/dst/{name}")
        assert sorted(r.a for r in rows.collect()) == values


def test_dataset_round_trip(spark, write, tmp_path):
    for lang, n in (("en-GB", 30), ("fr-FR", 11)):
        text = "\n".join(talk(("A", f"{lang} {i}", True), ("B", "ok", False), ("A", "bye", True))
                         for i in range(n))
        write(f"in/aac_conversations_{lang}.jsonl", text + "\n")
    out = build_dataset(spark, f"{tmp_path}/in/*", f"{tmp_path}/ds", seed=3)
    assert out.columns == [*FLAT_COLUMNS, "split"]
    back = readers.load_splits(spark, f"{tmp_path}/ds")
    counts = {r.split: r["count"] for r in back.groupBy("split").count().collect()}
    assert counts == {"test": 17, "train": 65}
    first = back.filter("conversation_id = 'en-GB_1' and turn_number = 0").first()
    assert first.utterance == "en-GB 0" and first.next_turn_utterance == "ok"
    assert back.filter("conversation_id = 'en-GB_30'").first().context_utterances is not None
    assert len(lines_of(f"{tmp_path}/ds_csv")) >= 82
    one = readers.load_splits(spark, f"{tmp_path}/ds/split=test")
    assert one.count() == 17


def test_corpus_order_over_split_files(spark, write, tmp_path):
    text = "\n".join(talk(("A", f"u{i}", True)) for i in range(400)) + "\n"
    write("in/aac_conversations_en.jsonl", text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        from turnloom.operators.turns import assign_conversation_id, flatten_examples

        corpus = readers.read_corpus(spark, f"{tmp_path}/in/*", AUGMENTED_CONVERSATION)
        assert corpus.rdd.getNumPartitions() > 3
        flat = flatten_examples(assign_conversation_id(corpus, ["_file", "_block", "_line"]))
        rows = flat.select("conversation_id", "utterance").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert {r.conversation_id: r.utterance for r in rows} == {
        f"en_{i + 1}": f"u{i}" for i in range(400)
    }


def test_stats_files(spark, tmp_path):
    df = spark.createDataFrame([("en", "1", True, "a b"), ("fr", "2", False, "c")],
                               "language_code string, conversation_id string, is_aac_user boolean, utterance string")
    stats_report(df, f"{tmp_path}/st")
    lines = lines_of(f"{tmp_path}/st/markdown")
    assert lines[0] == "# Corpus statistics" and lines[2].startswith("| Language | Conversations |")
    assert [x.split(" | ")[0] for x in lines[4:7]] == ["| en", "| fr", "| TOTAL"]
    assert lines[7:9] == ["", "## Notes"]
    csv = lines_of(f"{tmp_path}/st/csv")
    assert csv[0].startswith("Language,Conversations") and csv[-1].startswith("TOTAL,2,2,1,1,2,1,1.0")


def test_stream_reads_each_file_once(spark, write, tmp_path):
    def line(id_, text):
        body = {"choices": [{"message": {"content": text}}]}
        return json.dumps({"id": "r", "custom_id": id_, "response": {"body": body}}) + "\n"

    ok = talk(("A", "hi", True))
    write("in/a.jsonl", line("en_1", ok) + "bad line\n")
    write("in/b.jsonl", line("fr_1", ok))

    def run():
        ingest_stream(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/rej",
                      f"{tmp_path}/ck").awaitTermination()
        done = spark.read.option("basePath", f"{tmp_path}/out").json(f"{tmp_path}/out")
        return sorted((r.language_code, r.custom_id) for r in done.collect())

    assert run() == [("en", "en_1"), ("fr", "fr_1")]
    assert run() == [("en", "en_1"), ("fr", "fr_1")]
    write("in/c.jsonl", line("en_2", ok))
    assert run() == [("en", "en_1"), ("en", "en_2"), ("fr", "fr_1")]
    rejects = [json.loads(x) for x in lines_of(f"{tmp_path}/rej")]
    assert [r["content"] for r in rejects] == ["bad line"]


def test_resume_goes_by_key(spark):
    work = spark.range(10)
    done = spark.createDataFrame([(i,) for i in (0, 3, 9)], "id long")
    assert sorted(r.id for r in resume(work, done, "id").collect()) == [1, 2, 4, 5, 6, 7, 8]


def test_csv_takes_whole_objects(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text(
        '{"a": 1, "b": "x"}\n{"a": 2} junk\n[1]\n{"a": {"k": 1, "k": 2}}\n'
    )
    writers.jsonl_to_csv(spark, f"{tmp_path}/in.jsonl", f"{tmp_path}/out")
    got = spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/out").collect()
    assert [(r.a, r.b) for r in got] == [("1", "x"), ('{"k":2}', None)]
