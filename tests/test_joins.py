import pytest
from pyspark.sql import functions as F

from turnloom.operators import joins, translation
from turnloom.operators.scale import lookup_join, number_by_hash, number_rows


def ids(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


@pytest.fixture
def skewed(spark):
    """A third of the left rows share one key, and another part has none."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 7 == 0, None).otherwise(
        F.col("id")
    )
    left = spark.range(0, 30_000, 1, 8).select(
        key.alias("k"), F.col("id"), F.sha2(F.col("id").cast("string"), 512).alias("pad")
    )
    meta = spark.range(0, 60_000).select(
        (F.col("id") % 20_000).alias("k"), F.col("id").alias("line"), F.lit("m").alias("v")
    )
    yield left, meta.groupBy("k").agg(F.max_by("v", "line").alias("v"))
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_key_is_split(skewed, how):
    left, right = skewed
    joined = lookup_join(left, right, "k", how)
    rows = joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    plain = left.join(right, "k", how)
    assert len(rows) == plain.count()
    assert {r.id for r in rows} == {r.id for r in plain.collect()}


def test_number_rows(spark):
    df = spark.range(0, 1000, 1, 7).select(
        F.col("id").alias("pos"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"),
    )
    rows = number_rows(df.orderBy(F.rand(1)), ["pos"], "n", start=1).collect()
    assert all(r.n == r.pos + 1 for r in rows) and len(rows) == 1000
    grouped = {}
    for r in sorted(number_rows(df, ["pos"], "n", by=["g"]).collect(), key=lambda r: r.pos):
        assert r.n == grouped.get(r.g, 0)
        grouped[r.g] = r.n + 1
    assert sum(grouped.values()) == 1000


def test_number_by_hash(spark):
    df = spark.range(500).select("id", (F.col("id") % 3).alias("g"))
    rows = number_by_hash(df, ["id"], "n", by=["g"]).collect()
    for g in range(3):
        numbers = sorted(r.n for r in rows if r.g == g)
        assert numbers == list(range(len(numbers)))
    again = number_by_hash(df.repartition(11), ["id"], "n", by=["g"]).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def meta_table(spark, rows):
    return spark.createDataFrame(rows, "custom_id string, line_no long, model string")


def test_last_metadata_wins(spark):
    meta = meta_table(spark, [("a", 1, "old"), ("a", 2, "new"), ("b", 3, "x")])
    responses = spark.createDataFrame([("a",), ("c",)], "custom_id string")
    assert ids(joins.attach_metadata(responses, meta), "custom_id", "model") == [("a", "new")]


def test_prefix_match_takes_first(spark):
    meta = meta_table(
        spark, [("ab_1", 1, "m1"), ("ab", 2, "m2"), ("zz_long", 3, "m3"), ("zz_l", 4, "m4")]
    )
    responses = spark.createDataFrame([("ab_1_x",), ("zz",), ("q",), ("ab",)], "custom_id string")
    out = joins.attach_by_prefix(responses, meta)
    assert ids(out, "custom_id", "matched_id", "model") == [
        ("ab_1_x", "ab_1", "m1"), ("zz", "zz_long", "m3"),
    ]
    every = joins.attach_any(responses, meta)
    assert ids(every, "custom_id", "model") == [("ab", "m2"), ("ab_1_x", "m1"), ("zz", "m3")]


def test_prefix_match_against_brute_force(spark):
    import itertools
    import random

    rng = random.Random(3)
    names = ["".join(x) for n in (1, 2, 3, 4) for x in itertools.product("ab", repeat=n)]
    meta_rows = [(rng.choice(names), i, f"m{i}") for i in range(12)]
    responses = [(n,) for n in names]
    first = {}
    for key, line, _ in meta_rows:
        first.setdefault(key, line)
    last = {key: model for key, _, model in meta_rows}
    expected = []
    for (n,) in responses:
        if n not in last:
            hits = [k for k in first if n.startswith(k) or k.startswith(n)]
            if hits:
                best = min(hits, key=first.get)
                expected.append((n, best, last[best]))
    out = joins.attach_by_prefix(
        spark.createDataFrame(responses, "custom_id string"), meta_table(spark, meta_rows)
    )
    assert ids(out, "custom_id", "matched_id", "model") == sorted(expected)


def test_coalesce_metadata(spark):
    df = spark.createDataFrame(
        [((None, "m"), "en", None, None), (("fr", None), "en", None, ("b",)),
         ((None, None), None, "later", None)],
        "metadata struct<lang_code string, model string>, lang_code string, created_at string, "
        "body struct<model string>",
    )
    got = [tuple(r.metadata) for r in joins.coalesce_metadata(df).collect()]
    assert got == [
        ("en", None, "openai", "m"), ("fr", None, "openai", "b"),
        (None, "later", "openai", "gpt-4-turbo"),
    ]


def test_missing_available_pending(spark):
    a = spark.createDataFrame([("en",), ("fr",), ("de",)], "lang string")
    b = spark.createDataFrame([("fr",), ("fr",), ("es",)], "lang string")
    assert ids(joins.missing(a, b, "lang"), "lang") == [("de",), ("en",)]
    assert ids(joins.available(a, b, "lang"), "lang") == [("fr",)]
    assert ids(joins.pending(a, b, "lang"), "lang") == [("de",), ("en",)]


def test_fallback_chain(spark):
    langs = spark.createDataFrame([("en-GB",), ("fr-FR",), ("sl-SI",)], "lang_code string")
    res = spark.createDataFrame(
        [("fr-FR", "exact"), ("en", "base"), ("xx", "last")], "lang_code string, value string"
    )
    out = joins.resolve_resource(langs, res, "value", default="xx")
    assert ids(out, "lang_code", "value") == [
        ("en-GB", "base"), ("fr-FR", "exact"), ("sl-SI", "last"),
    ]


def test_new_combinations(spark):
    schema = "template_id int, substitutions map<string,string>"
    cand = spark.createDataFrame(
        [(1, {"a": "x", "b": "y"}), (1, {"b": "y", "a": "x"}), (2, {"a": "x", "b": "y"}), (3, {})],
        schema,
    )
    done = spark.createDataFrame([(2, {"b": "y", "a": "x"})], schema)
    assert ids(joins.new_combinations(cand, done), "template_id") == [(1,), (3,)]


def test_pair_files(spark):
    responses = spark.createDataFrame(
        [("d/responses_en-GB_20250512.jsonl", "x"),
         ("d/other.jsonl", "20250101_101010_abcd_7"), ("d/lost.jsonl", "q")],
        "path string, first_custom_id string",
    )
    metas = spark.createDataFrame(
        [("m/batch_en-GB_openai_20250512_132116_e0_metadata.jsonl",),
         ("m/batch_fr-FR_openai_20250101_101010_abcd_metadata.jsonl",)], "path string",
    )
    assert {r.path: r.meta_path for r in joins.pair_files(responses, metas).collect()} == {
        "d/responses_en-GB_20250512.jsonl": "m/batch_en-GB_openai_20250512_132116_e0_metadata.jsonl",
        "d/other.jsonl": "m/batch_fr-FR_openai_20250101_101010_abcd_metadata.jsonl",
        "d/lost.jsonl": None,
    }


def test_positional_zip(spark):
    entries = spark.createDataFrame([(i, f"e{i}") for i in range(5)], "pos int, topic string")
    batches = spark.createDataFrame(
        [(2, ["c"]), (0, ["a", "b"]), (1, [])], "batch_index int, translations array<string>"
    )
    out = joins.zip_translations(entries, batches, "topic", ["pos"]).orderBy("pos").collect()
    assert [r.topic for r in out] == ["a", "b", "c", "e3", "e4"]


def test_batches_last_answer_wins_whole(spark):
    def answer(*lines):
        text = "\\n".join(f"{i + 1}. {line}" for i, line in enumerate(lines))
        return '{"choices":[{"message":{"content":"' + text + '"}}]}'

    responses = spark.createDataFrame(
        [(1, "translate_fr_topic_0_9", answer("a", "b")), (2, "translate_fr_topic_0_9", answer("z")),
         (3, "other", answer("q")), (4, "translate_fr_topic_1_9", "broken")],
        "line_no int, custom_id string, response string",
    )
    rows = translation.read_batches(responses).collect()
    assert [(r.lang, r.field, r.batch_index, r.translations) for r in rows] == [
        ("fr", "topic", 0, ["z"])
    ]


def test_translate_and_coverage(spark):
    from turnloom.operators.stats import coverage

    entries = spark.createDataFrame([("a", "x"), ("b", "y"), ("a", "z")], "topic string, which string")
    lookup = spark.createDataFrame(
        [("topic", "a", "A"), ("which", "y", "Y"), ("which", "a", "no")],
        "field string, original string, translation string",
    )
    out = translation.translate_columns(entries, lookup, ["topic", "which"])
    assert ids(out, "topic", "which") == [("A", "x"), ("A", "z"), ("b", "Y")]
    got = {r.field: (r.matched, r.total, r.percent) for r in coverage(out, ["topic", "which"]).collect()}
    assert got == {"topic": (2, 3, 66.7), "which": (1, 3, 33.3)}


def test_chunks_hold_consecutive_strings(spark):
    entries = spark.createDataFrame([(f"t{i % 7}", f"w{i}") for i in range(30)], "topic string, which string")
    strings = translation.unique_strings(entries, ["topic", "which"])
    assert ids(strings.groupBy("field").count(), "field", "count") == [("topic", 7), ("which", 30)]
    chunks = translation.chunk_requests(strings, "fr-FR", 10, stamp="5").collect()
    assert sorted(c.custom_id for c in chunks) == [
        "translate_fr-FR_topic_0_5", "translate_fr-FR_which_0_5", "translate_fr-FR_which_1_5",
        "translate_fr-FR_which_2_5",
    ]
    assert all(c.prompt.endswith("\n") and "\n\n1. " in c.prompt for c in chunks)


def test_latest_file(spark):
    files = spark.createDataFrame([("a", "p1", 1), ("a", "p2", 3), ("b", "p3", 2)],
                                  "lang string, path string, modified int")
    assert ids(joins.latest_file(files, ["lang"]), "lang", "path") == [("a", "p2"), ("b", "p3")]


def test_put_back_in_nested_places(spark):
    df = spark.createDataFrame(
        [(1, "a", [("x", "k"), (None, "k")], ["p", " "], "keep"), (2, None, None, None, "keep")],
        "id int, topic string, parts array<struct<which:string,code:string>>, "
        "notes array<string>, other string",
    )
    cols = ["topic", "which", "notes"]
    found = translation.translatable_strings(df, "id", cols)
    assert ids(found, "id", "path", "text") == [
        (1, "notes.0", "p"), (1, "parts.0.which", "x"), (1, "topic", "a"),
    ]
    upper = found.withColumn("text", F.upper("text")).filter("path <> 'topic'")
    first, second = translation.put_back(df, "id", upper, cols).orderBy("id").collect()
    assert first.topic == "a" and first.notes == ["P", " "] and first.other == "keep"
    assert [tuple(p) for p in first.parts] == [("X", "k"), (None, "k")]
    assert second.topic is None and second.parts is None


def test_ready_jobs(spark):
    from turnloom.schemas import LEDGER

    def job(id_, lang, result, processed):
        return (id_, "f", lang, "b", "completed", "t", None, result, processed)

    ledger = spark.createDataFrame(
        [job("1", "en", "r", None), job("2", "en", "r", True), job("3", "fr", None, False),
         job("4", "fr", "r", False)], LEDGER,
    )
    assert ids(joins.ready_jobs(ledger), "batch_id") == [("1",), ("4",)]
    assert ids(joins.ready_jobs(ledger, ["fr"]), "batch_id") == [("4",)]
