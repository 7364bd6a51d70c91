import hashlib
import math

import pytest
from pyspark.sql import functions as F

from turnloom.functions.text import is_aac_speaker
from turnloom.operators import sampling, scale, stats

# The published counts per language and their totals.
PUBLISHED = [
    ("ar-SA", 97, 1230, 113, 1117, 285, 8593), ("conversations", 48, 635, 173, 462, 280, 706),
    ("cy-GB", 96, 1296, 20, 1276, 49, 11482), ("de-DE", 96, 1338, 112, 1226, 263, 11950),
    ("el-GR", 95, 1284, 468, 797, 1122, 7758), ("en-GB", 210, 2522, 1074, 1448, 3818, 26128),
    ("en", 144, 1907, 696, 1211, 1999, 17170), ("es-ES", 96, 1345, 43, 1302, 122, 11913),
    ("fr-FR", 96, 1315, 34, 1281, 98, 14050), ("he-IL", 96, 1258, 79, 1179, 180, 8538),
    ("it-IT", 96, 1302, 514, 788, 1388, 11565), ("ja-JP", 95, 1228, 296, 932, 486, 1186),
    ("nl-NL", 96, 1340, 52, 1288, 132, 13525), ("pt-BR", 96, 1359, 12, 1347, 41, 13520),
    ("ru-RU", 96, 1355, 387, 968, 919, 8126), ("zh-CN", 96, 1243, 336, 907, 628, 1352),
]


def test_published_total(spark):
    columns = "language_code string, " + ", ".join(f"{c} long" for c in stats.COUNTS)
    report = stats.format_stats(stats.with_total(spark.createDataFrame(PUBLISHED, columns)))
    rows = report.collect()
    assert tuple(rows[-1]) == ("TOTAL", 1649, 21957, 4409, 17529, 11810, 167562, 13.32, 2.68, 9.56)
    by_lang = {r["Language"]: tuple(r)[-3:] for r in rows}
    assert by_lang["en-GB"] == (12.01, 3.55, 18.04) and by_lang["cy-GB"] == (13.5, 2.45, 9.0)


def test_stats_by_flag_or_name(spark):
    df = spark.createDataFrame(
        [("en", "1", "Sam (AAC)", True, "a b"), ("en", "1", "Ann", None, "one two three"),
         ("en", "2", "Sam", True, None), ("fr", "3", "Bob", False, "")],
        "language_code string, conversation_id string, speaker string, is_aac_user boolean, "
        "utterance string",
    )
    flag = {r.language_code: r for r in stats.corpus_stats(df).collect()}
    assert (flag["en"].aac_utterances, flag["en"].aac_word_count, flag["en"].aac_mlu) == (2, 2, 1.0)
    assert (flag["en"].num_conversations, flag["en"].avg_conversation_length) == (2, 1.5)
    assert (flag["fr"].aac_mlu, flag["fr"].non_aac_mlu) == (0.0, 0.0)
    name = {r.language_code: r for r in stats.corpus_stats(df, aac=is_aac_speaker("speaker")).collect()}
    assert (name["en"].aac_utterances, name["en"].non_aac_utterances) == (1, 2)


def test_run_summary(spark):
    df = spark.createDataFrame([("en", True, 1.25), ("fr", False, 2.0), ("de", True, 0.5)],
                               "lang string, success boolean, seconds double")
    assert tuple(stats.run_summary(df, 20).first()) == (2, 1, 40, 3.75)


def test_char_frequency(spark):
    df = spark.createDataFrame([("abca",), ("a",), (None,), ("",)], "c string")
    assert [tuple(r) for r in stats.char_frequency(df, "c").collect()] == [("a", 3), ("b", 1), ("c", 1)]


def test_split_sizes_and_stability(spark):
    df = spark.range(24_550).withColumnRenamed("id", "k")
    split = sampling.split_exact(df, ["k"], 0.2, seed=1)
    assert split.filter("split = 'test'").count() == 4910
    labels = {r.k: r.split for r in split.collect()}
    again = sampling.split_exact(df.repartition(7), ["k"], 0.2, seed=1)
    assert labels == {r.k: r.split for r in again.collect()}
    assert "Exchange" not in split._jdf.queryExecution().executedPlan().toString()
    assert sampling.split_exact(df.limit(3), ["k"], 0.2).filter("split = 'test'").count() == 1


def test_split_narrows_down_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(scale, "_SMALL_BUCKET", 0)
    monkeypatch.setattr(scale, "_BUCKET_DIGITS", 1)
    hashes = sorted(hashlib.md5(f"{i}|9".encode()).hexdigest() for i in range(300))
    df = spark.range(300)
    for n in (1, 60, 299, 300):
        assert scale.hash_cutoff(df, ["id"], n, 9) == hashes[n - 1]


def test_samples(spark):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    rows = sampling.sample_n(df, 30, ["id"], 4).collect()
    expected = sorted(range(100), key=lambda i: hashlib.md5(f"{i}|4".encode()).hexdigest())[:30]
    assert sorted(r.id for r in rows) == sorted(expected)
    assert sampling.sample_n(df, 500, ["id"]).count() == 100
    assert sampling.sample_n(df, 0, ["id"]).count() == 0
    filled = sampling.sample_fill(df, 250, ["id"], 4)
    counts = [r["count"] for r in filled.groupBy("id").count().collect()]
    assert len(counts) == 100 and sum(counts) == 250 and all(r.v == 2 * r.id for r in filled.collect())


def test_cross_sample(spark):
    templates = spark.createDataFrame([(0, "t0"), (1, "t1")], "template_id int, template string")
    entries = spark.createDataFrame([(i, f"e{i}") for i in range(10)], "pos int, topic string")
    subs = spark.createDataFrame([("tone", ["a", "b"]), ("none", [])], "key string, values array<string>")
    out = sampling.sample_requests(2000, templates, entries, ["pos"], subs, seed=2)
    rows = out.collect()
    assert len(rows) == 2000 == len({r.request for r in rows})
    assert {r.template for r in rows} == {"t0", "t1"} and {r.picks["tone"] for r in rows} == {"a", "b"}
    assert all(set(r.picks) == {"tone"} for r in rows)
    counts = out.groupBy("topic").count().collect()
    assert len(counts) == 10 and all(140 < r["count"] < 260 for r in counts)
    cross = out.groupBy("template_id").agg(F.count_if(F.col("picks")["tone"] == "a").alias("n"))
    assert all(400 < r.n < 600 for r in cross.collect())
    assert "CartesianProduct" not in out._jdf.queryExecution().executedPlan().toString()


def test_ceil_of_share():
    assert math.ceil(0.2 * 24_550) == 4910

def test_intermediate_tables_lie_in_the_named_folder(spark, shared_folder):
    df = scale.cut_lineage(spark.range(3))
    assert df.count() == 3 and shared_folder in df.inputFiles()[0]


def test_requests_of_every_language(spark):
    langs = spark.createDataFrame([("en",), ("en",), ("pt-BR",), ("xx",)], "lang_code string")
    templates = spark.createDataFrame(
        [("en", 0, "{{ tone }}"), ("en", 1, "none"), ("pt", 7, "{{ a }} {{ a }} {{b}}")],
        "lang_code string, template_id int, template string",
    )
    subs = spark.createDataFrame(
        [("en", "tone", ["x", "y"]), ("en", "unused", ["z"]), ("pt", "a", ["1"]), ("pt", "b", None), ("en", "aac_user", ["U"])],
        "lang_code string, key string, values array<string>",
    )
    entries = spark.createDataFrame([(i,) for i in range(5)], "pos int")
    rows = sampling.sample_requests_by_language(
        40, langs, templates, entries, ["pos"], subs, "{{ tone }}"
    ).collect()
    by = {}
    for r in rows:
        by.setdefault(r.lang_code, []).append(r)
    assert {k: sorted(r.request for r in v) for k, v in by.items()} == {
        k: list(range(40)) for k in ("en", "pt-BR", "xx")}
    assert {r.template_id for r in by["xx"]} == {0, 1} and {r.template_id for r in by["pt-BR"]} == {7}
    assert all(r.picks == {"a": "1"} and r.system_picks == {} for r in by["pt-BR"])
    for r in by["en"] + by["xx"]:
        assert set(r.picks) == ({"aac_user", "tone"} if r.template_id == 0 else {"aac_user"})
        assert set(r.system_picks) == {"aac_user", "tone"}
    assert len({r.pos for r in rows}) == 5
    none = templates.filter("lang_code = 'pt'")
    left = sampling.sample_requests_by_language(3, langs, none, entries, ["pos"], subs)
    assert {r.lang_code for r in left.collect()} == {"pt-BR"}
