"""Prefix matches over ranges of sorted ids, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from turnloom.operators.joins import prefix_matches


def expected(asked, known):
    """Smallest (line, id) of the known ids, null lines first, per distinct asked id."""
    first = {}
    for id_, line in known:
        if id_:
            old = first.get(id_)
            lines = [x for x in (old, line) if x is not None]
            first[id_] = min(lines) if lines else None
    out = {}
    for a in {a for a in asked if a}:
        hits = [(line is not None, line or 0, k) for k, line in first.items() if a.startswith(k) or k.startswith(a)]
        if hits:
            out[a] = min(hits)[2]
    return out


def matches(spark, asked, known, partitions):
    ids = spark.createDataFrame([(a,) for a in asked], "custom_id string")
    meta = spark.createDataFrame(known, "custom_id string, line_no long")
    rows = prefix_matches(ids, meta, partitions=partitions).collect()
    assert len({r.custom_id for r in rows}) == len(rows)
    return {r.custom_id: r.matched_id for r in rows}


@pytest.mark.parametrize("partitions", [None, 1, 3, 40])
def test_against_brute_force(spark, partitions):
    rng = random.Random(partitions or 0)

    def name():
        return "".join(rng.choice("abé") for _ in range(rng.randint(0, 7)))

    known = [(name(), rng.choice([None, *range(30)])) for _ in range(60)]
    asked = [name() for _ in range(400)]
    assert matches(spark, asked, known, partitions) == expected(asked, known)


@pytest.mark.parametrize("partitions", [None, 6])
def test_prefixes_open_over_many_ranges(spark, partitions):
    """Short ids at the start match ids in every later range, in both directions."""
    tails = [f"batch_{i:04d}" for i in range(300)]
    known = [("b", 500), ("batch", 400), *[(t, i) for i, t in enumerate(tails) if i % 3 == 0]]
    asked = ["ba", "batch_", "batch_02", *tails, *[t + "_x" for t in tails]]
    got = matches(spark, asked, known, partitions)
    assert got == expected(asked, known)
    assert got["ba"] == "batch_0000" and got["batch_0001"] == "batch" and got["batch_0003_x"] == "batch_0003"


def test_long_nested_empty_and_null_ids(spark):
    """A chain of ids that all begin with the one before, one of them very long."""
    chain = ["x" * n for n in range(1, 40)] + ["x" * 200_000, "x" * 200_000 + "y"]
    known = [(c, 100 - i) for i, c in enumerate(chain) if i % 2] + [("", 0), (None, 1), ("z", None)]
    asked = [*chain, *chain, "", None, "zz", "q"]
    assert matches(spark, asked, known, 5) == expected(asked, known)


def test_empty_sides(spark):
    assert matches(spark, [], [("a", 1)], 3) == {}
    assert matches(spark, ["a"], [], 3) == {}
    assert matches(spark, [], [], None) == {}


def test_order_by_text_and_rows_linear_in_ids(spark):
    """The order may be a text; ids are not exploded into their prefixes."""
    ids = spark.range(500).select(F.concat(F.repeat(F.lit("k"), 300), F.col("id").cast("string")).alias("custom_id"))
    meta = ids.withColumn("stamp", F.md5("custom_id"))
    rows = prefix_matches(ids, meta, "stamp", 4)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan
    lines = {r.custom_id: r.stamp for r in meta.collect()}
    for r in rows.collect():
        hits = [k for k in lines if k.startswith(r.custom_id) or r.custom_id.startswith(k)]
        assert r.matched_id == min(hits, key=lambda k: (lines[k], k))
