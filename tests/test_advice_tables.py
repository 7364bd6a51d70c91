"""What the second review found, each as a case that failed before."""

from pyspark.sql import functions as F

from turnloom.operators import filters, sampling


def test_long_lists_of_templates_and_values_are_joined(spark):
    templates = spark.range(10_050).select(F.col("id").cast("int").alias("template_id"), F.concat(F.lit("t"), "id").alias("template"))
    entries = spark.createDataFrame([(0, "e")], "pos int, topic string")
    subs = spark.range(10_050).select(F.concat(F.lit("k"), "id").alias("key"), F.array(F.lit("a"), F.lit("b")).alias("values"))
    rows = sampling.sample_requests(3, templates, entries, ["pos"], subs).collect()
    assert len(rows) == 3 and all(r.template == f"t{r.template_id}" for r in rows)
    assert all(len(r.picks) == 10_050 and set(r.picks.values()) == {"a", "b"} for r in rows)


def test_no_limit_passes_through_one_task(spark):
    df = spark.range(5000).select((F.col("id") * 7 % 5000).alias("pos"), F.lit("x").alias("t"))
    kept = filters.limit_entries(df, 3000, ["pos"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Limit" not in plan and "SinglePartition" not in plan
    assert {r.pos for r in kept.collect()} == set(range(3000))
