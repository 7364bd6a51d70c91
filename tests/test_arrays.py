"""Array files of any size, cut at separators and put together again."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnloom.operators.scale import cut_lineage
from turnloom.sources import arrays, readers, writers
from turnloom.sources.arrays import array_elements

TRICKY = [
    {"a": 1, "t": 'quote " and \\ and }, {"b": [1]} inside'},
    {"a": 2, "t": "tail\\\\", "deep": {"x": [{"y": {"z": "}"}}, [], {}]}},
    {},
    {"t": "line\nend,\t]", "u": "日本 } é"},
    5,
    "text } with \\\" quote",
    [1, {"k": "}"}, []],
    None,
    True,
    {"last": "{[\"}"},
]


def items(spark, path, separator="}"):
    rows, faults = array_elements(spark, path, separator)
    texts = rows.selectExpr("to_json(_item) as t").collect()
    got = sorted(json.dumps(json.loads(r.t) if r.t is not None else None, sort_keys=True) for r in texts)
    return got, {r._path.rsplit("/", 1)[1]: r.error for r in faults.collect()}


def expected(values):
    return sorted(json.dumps(v, sort_keys=True) for v in values)


@pytest.mark.parametrize("separator", ["}", ","])
@pytest.mark.parametrize("indent", [None, 1])
def test_elements_of_every_kind(spark, write, separator, indent):
    path = write("a.json", json.dumps(TRICKY, indent=indent, ensure_ascii=False))
    assert items(spark, path, separator) == (expected(TRICKY), {})


@pytest.mark.parametrize("separator", ["}", ","])
def test_blocks_may_end_anywhere(spark, write, separator):
    rng = random.Random(4)
    values = [rng.choice(TRICKY) for _ in range(300)]
    path = write("blocks.json", " \n" + json.dumps(values, indent=rng.choice([None, 2])) + "\n")
    kept = {n: spark.conf.get(n, None) for n in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("37", "501", "4096"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            if size == "501":
                assert spark.read.option("lineSep", separator).text(path).rdd.getNumPartitions() > 8
            if size != "37" or separator == "}":
                assert items(spark, path, separator) == (expected(values), {})
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value) if value else spark.conf.unset(name)


@pytest.mark.parametrize("separator", ["}", ","])
def test_faulty_files_are_named_and_give_nothing(spark, write, tmp_path, separator):
    good = {"one.json": "[]", "two.json": ' [ {"a": 1} ]\n', "three.json": '[1, 2,\n3]', "four.json": '[{}, {"a": {}}]'}
    bad = {
        "cut.json": '[{"a": 1}, {"a": 2}', "open.json": '[{"a": 1', "comma.json": '[{"a": 1} {"a": 2}]',
        "more.json": '[{"a": 1}] {"b": 2}', "trail.json": '[{"a": 1},]', "junk.json": '[{"a": 1}]x',
        "bare.json": "[{a: 1}]", "empty.json": "", "quote.json": '[{"a": "x}]', "closed.json": '[{"a": 1}]]',
        "twice.json": '[{"a": 1},, {"a": 2}]', "lead.json": ', {"a": 1}]',
    }
    other = {"object.json": '{"a": [{"b": 1}]}', "text.json": '"text"', "lines.json": '{"a": 1}\n{"a": 2}'}
    for name, text in {**good, **bad, **other}.items():
        write(f"files/{name}", text)
    got, faults = items(spark, str(tmp_path / "files"), separator)
    assert got == expected([{"a": 1}, 1, 2, 3, {}, {"a": {}}])
    # Spark passes over a file without a byte
    assert set(faults) | {"empty.json"} == set(bad) | set(other)
    assert faults["lines.json"] == faults["bare.json"] == "invalid JSON"
    assert faults["object.json"] == faults["text.json"] == "not an array"


def test_a_large_array_is_read_in_parts(spark, tmp_path):
    # larger than a variant can be, on one line
    path = tmp_path / "large.json"
    text = "x" * 1000 + " } \\\" [ "
    with path.open("w") as out:
        out.write("[" + ",".join(f'{{"n": {i}, "t": "{text}"}}' for i in range(150_000)) + "]")
    assert path.stat().st_size > 140 << 20
    rows = readers.read_json_array(spark, str(path), T.StructType.fromDDL("n long, t string"))
    got = rows.agg(F.count("n"), F.countDistinct("n"), F.sum("n"), F.min(F.length("t"))).first()
    assert tuple(got) == (150_000, 150_000, 150_000 * 149_999 // 2, 1007)
    assert spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() > 1


def test_only_text_at_edges_of_blocks_is_moved(spark, write, tmp_path, monkeypatch):
    values = {"a": TRICKY * 3, "b": [], "c": [{"n": i} for i in range(40)], "d": [{"only": "}"}]}
    for name, value in values.items():
        write(f"some/{name}.json", json.dumps(value))
    frames = []

    def kept(df):
        frames.append(df)
        return cut_lineage(df)

    monkeypatch.setattr(arrays, "cut_lineage", kept)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "301")
    try:
        got = items(spark, str(tmp_path / "some"))
        rows, _ = array_elements(spark, str(tmp_path / "some"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == (expected([v for value in values.values() for v in value]), {})
    with_text = [df for df in [*frames, rows] if {"_text", "_items", "_item"} & set(df.columns)]
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in with_text]
    assert plans
    assert all("_edge" in p for p in plans if "hashpartitioning" in p)


def test_files_cut_anew_between_the_passes_fail(spark, write):
    path = write("anew.json", json.dumps([{"n": i} for i in range(40)]))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "90")
        state = arrays._with_state(arrays._chunks(spark, path, "}"), 1)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "130")
        with pytest.raises(Exception, match="cut anew"):
            state.select("_quoted", "_level").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_tree_keeps_its_folders(spark, write, tmp_path):
    write("in/a.json", '[{"n": 1}, {"n": 2}]')
    write("in/sub/deep er/b.json", '[{"n": 3}]')
    write("in/sub/c.json", '{"n": 4}')
    schema = T.StructType.fromDDL("n long")
    bad = writers.convert_tree(spark, str(tmp_path / "in"), str(tmp_path / "out"), schema).collect()
    assert [(r.path.rsplit("/", 1)[1], r.error) for r in bad] == [("c.json", "not an array")]
    for name, numbers in (("a", [1, 2]), ("sub/deep er/b", [3])):
        assert sorted(r.n for r in spark.read.schema(schema).json(str(tmp_path / "out" / name)).collect()) == numbers
    assert not [p for p in (tmp_path / "out").rglob("_beside*")]


def test_records_of_three_shapes(spark, write, tmp_path):
    write("r/lines.json", '{"n": 1}\n{"n": 2}\n')
    write("r/array.json", '[\n{"n": 3},\n{"n": 4}]')
    write("r/object.json", '{"meta": [{"n": 9}], "data": [{"n": 5}]}'.replace(", ", ",\n"))
    schema = T.StructType.fromDDL("n long")
    assert sorted(r.n for r in readers.read_records(spark, str(tmp_path / "r"), schema).collect()) == [1, 2, 3, 4, 5]
    write("r/bad.json", '[{"n": 6}')
    with pytest.raises(Exception, match="bad.json"):
        readers.read_records(spark, str(tmp_path / "r"), schema).collect()
