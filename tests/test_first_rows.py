"""The first rows of an order by counting, and numbers in file order, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from turnloom.operators import scale
from turnloom.operators.filters import limit_entries
from turnloom.operators.turns import assign_in_file_order
from turnloom.sources.readers import read_corpus
from turnloom.plans.jobs import AUGMENTED_CONVERSATION


@pytest.mark.parametrize("small", [10_000, 7])
def test_first_rows(spark, monkeypatch, small):
    monkeypatch.setattr(scale, "_SMALL_BUCKET", small)
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(5)]), rng.choice(["a", "b", None]), rng.randrange(20)) for _ in range(400)]
    rows += [(2, "b", 3)] * 90
    df = spark.createDataFrame(rows, "a int, b string, c int").repartition(5).withColumn("m", F.create_map("c", "b"))
    order = sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))
    for n in (1, 8, 100, 333, 489, 490, 900):
        got = limit_entries(df, n, ["a", F.col("b")]).drop("m").collect()
        assert sorted(map(tuple, got), key=str) == sorted(order[:n], key=str), n
    alike = spark.createDataFrame([(1,)] * 50, "a int").repartition(3)
    for n in (3, 20, 50, 60):
        assert limit_entries(alike, n, ["a"]).count() == min(n, 50)
    assert limit_entries(df.limit(0), 30, ["a"]).count() == 0


def test_the_first_rows_are_a_filter(spark):
    rows = limit_entries(spark.range(1000).repartition(4), 10, ["id"])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan and "Limit" not in plan and sorted(r.id for r in rows.collect()) == list(range(10))


def test_numbers_in_file_order_move_no_row(spark, write, tmp_path):
    rng = random.Random(2)
    wanted = {}
    for lang, files in (("en", 3), ("fr", 1)):
        number = 0
        for f in range(files):
            scenes = [f"{lang} {f} {i} " + "x" * rng.randrange(300) for i in range(rng.randrange(20, 90))]
            write(f"in/part{f}_{lang}.jsonl", "".join(f'{{"scene": "{s}"}}\n' for s in scenes))
            for s in scenes:
                number += 1
                wanted[s] = f"{lang}_{number}"
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        corpus = read_corpus(spark, f"{tmp_path}/in/*", AUGMENTED_CONVERSATION)
        assert corpus.rdd.getNumPartitions() > 5
        out = assign_in_file_order(corpus).cache()
        assert {r.scene: r.conversation_id for r in out.collect()} == wanted
        plan = assign_in_file_order(corpus)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
        some = corpus.filter(~F.col("scene").contains(" 1 7"))
        left = [s for s in wanted if " 1 7" not in s]
        got = {r.scene: r.conversation_id for r in assign_in_file_order(some).collect()}
        assert sorted(got) == sorted(left) and len(set(got.values())) == len(left)
        counted = assign_in_file_order(corpus)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1700")
        with pytest.raises(Exception, match="cut anew"):
            counted.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
