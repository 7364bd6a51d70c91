import random

import pytest
from pyspark.sql import functions as F

from turnloom.functions.keyboard import key_grid
from turnloom.functions.noise import edit_count, noisy
from turnloom.functions.noise_batch import noisy_variants
from turnloom.operators.stats import distance_by_length
from turnloom.plans.jobs import augment_turns
from turnloom.schemas import ERROR_RATES, LAYOUTS, noisy_columns

# Short and long texts every rate must change, or change in proportion.
SHORT = ["Hello", "A", "Hi", "Test", "This is a longer sentence to test.", "Short", "OK", "Yes",
         "No", "Maybe"]
LONG = ["Hello", "This is a test", "The quick brown fox jumps over the lazy dog",
        "A longer sentence to test the proportionality of errors introduced based on the error "
        "rate and text length."]
ODD = ["É", "...", "é.", "日本", "😀😀 ok", "ſtraße", "  ", "aaaa", "İı"]
VARIANTS = [(f"noisy_{l}_{s}", key_grid(l), r) for s, r in ERROR_RATES.items() for l in LAYOUTS]


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abc dEfé .Ż_7", k=rng.randint(1, 300))) for _ in range(60)]
    rows = list(enumerate(SHORT + LONG + ODD + words))
    return spark.createDataFrame(rows, "id int, c string").repartition(3).cache()


def test_counts(spark):
    cases = [(10, 0.15, 2), (50, 0.05, 2), (10, 0.35, 4), (3, 0.05, 1), (2, 0.35, 1), (1, 0.05, 1)]
    for n, rate, k in cases:
        assert spark.range(1).select(edit_count(F.lit(n), rate)).first()[0] == k


def test_both_forms_agree(texts):
    both = texts.select(
        "*",
        noisy_variants("c", ["id"], VARIANTS, seed=3).alias("v"),
        *[noisy("c", g, r, ["id"], tag, seed=3).alias(tag) for tag, g, r in VARIANTS],
    )
    for row in both.collect():
        for tag, _, _ in VARIANTS:
            assert row.v[tag] == row[tag] != row.c


def test_slices_cover_all_rows_and_change_nothing(texts, monkeypatch):
    import pandas as pd

    from turnloom.functions import noise_batch

    monkeypatch.setattr(noise_batch, "SLICE_CHARS", 40)
    sample = pd.Series(["a" * 10, None, "b" * 100, "", "c" * 39, "d", "e"])
    slices = list(noise_batch._slices(sample))
    assert [(x.start, x.stop) for x in slices] == [(0, 2), (2, 3), (3, 6), (6, 7)]
    small = texts.select("id", noisy_variants("c", ["id"], VARIANTS[:2]).alias("v")).collect()
    monkeypatch.undo()
    whole = texts.select("id", noisy_variants("c", ["id"], VARIANTS[:2]).alias("v")).collect()
    assert sorted(map(str, small)) == sorted(map(str, whole))


def test_null_and_empty_stay(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "id int, c string")
    for form in (
        noisy("c", key_grid("abc"), 0.3, ["id"], "t"),
        noisy_variants("c", ["id"], [("t", key_grid("abc"), 0.3)])["t"],
    ):
        assert [r[0] for r in df.orderBy("id").select(form).collect()] == [None, ""]


@pytest.mark.parametrize(
    "kinds",
    [
        ("deletion",),
        ("adjacent",),
        ("insertion",),
        ("transposition",),
        ("adjacent", "deletion", "insertion", "transposition"),
    ],
)
def test_every_kind_changes_the_text(texts, kinds):
    rows = texts.select(
        "c", noisy("c", key_grid("qwerty"), 0.25, ["id"], "t", kinds=kinds).alias("n")
    ).collect()
    assert all(r.n != r.c and r.n is not None for r in rows)


def _swapped(text, picks):
    """Right-to-left swaps, one by one."""
    out = list(text)
    for p in sorted(picks, reverse=True):
        if p > 0:
            out[p], out[p - 1] = out[p - 1], out[p]
    return "".join(out)


def test_transpositions_are_sequential_swaps(texts):
    from turnloom.functions.noise import draw_numbers, edit_positions, let

    n = F.length("c")
    picks = let(
        draw_numbers(["id"], "t", 0),
        lambda d: edit_positions(n, edit_count(n, 0.35), d["a"], d["b"], d["c"]),
    )
    swaps = noisy("c", key_grid("qwerty"), 0.35, ["id"], "t", kinds=["transposition"])
    for row in texts.select("c", picks.alias("p"), swaps.alias("n")).collect():
        expected = _swapped(row.c, row.p)
        if expected != row.c:
            assert row.n == expected


def test_preserved_case(spark):
    df = spark.createDataFrame([(i, "HELLOTHERE") for i in range(40)], "id int, c string")
    form = noisy("c", key_grid("qwerty"), 0.2, ["id"], "t", kinds=["adjacent"], preserve_case=True)
    for row in df.select(form.alias("n")).collect():
        assert row.n == row.n.upper()


def test_same_under_any_partitioning(texts):
    form = noisy_variants("c", ["id"], VARIANTS).alias("v")

    def bag(df):
        return sorted(str(r) for r in df.select("id", form).collect())

    assert bag(texts.repartition(1)) == bag(texts.repartition(13))


def test_distance_grows_with_rate(spark):
    rows = [(f"{i}", t, r) for t in LONG for r in (0.05, 0.15, 0.25, 0.35, 0.5) for i in range(30)]
    df = spark.createDataFrame(rows, "id string, c string, rate double")
    forms = F.lit(None).cast("string")
    for rate in (0.05, 0.15, 0.25, 0.35, 0.5):
        form = noisy("c", key_grid("qwerty"), rate, ["id", "rate"], "t")
        forms = F.when(F.col("rate") == rate, form).otherwise(forms)
    noisy_df = df.withColumn("n", forms).cache()
    k = F.greatest(F.lit(1), F.rint(F.col("rate") * F.length("c")))
    assert noisy_df.filter(F.levenshtein("c", "n") > 2 * k).count() == 0
    report = {
        (r.length, r.rate): r.distance
        for r in distance_by_length(noisy_df, "c", "n", F.col("rate")).collect()
    }
    longest = len(LONG[-1])
    means = [report[longest, r] for r in (0.05, 0.15, 0.25, 0.35, 0.5)]
    assert means == sorted(means) and means[-1] > 3 * means[0]


def test_positions_are_uniform(spark):
    from turnloom.functions.noise import draw_numbers, edit_positions, let

    n = F.lit(20)
    picks = let(
        draw_numbers(["id"], "t", 0),
        lambda d: edit_positions(n, F.lit(5), d["a"], d["b"], d["c"]),
    )
    rows = spark.range(8000).select(picks.alias("p"))
    assert rows.filter(F.size(F.array_distinct("p")) != 5).count() == 0
    counts = rows.select(F.explode("p").alias("p")).groupBy("p").count().collect()
    assert len(counts) == 20 and all(1850 < r["count"] < 2150 for r in counts)
    pairs = rows.select((F.array_contains("p", 3) & F.array_contains("p", 4)).alias("b"))
    together = pairs.filter("b").count()
    assert 300 < together < 550  # 8000 * (5/20) * (4/19) = 421


def test_augment_keeps_partner_turns(spark):
    df = spark.createDataFrame(
        [(1, 0, True, "need water", "I need water"), (1, 1, False, "sure", None),
         (1, 2, None, "ok", None), (1, 3, True, "yes", None)],
        "conversation_id int, turn_number int, is_aac_user boolean, utterance string, "
        "utterance_intended string",
    )
    out = augment_turns(df)
    assert out.columns[5:] == [*noisy_columns(), "minimally_corrected", "fully_corrected"]
    rows = out.orderBy("turn_number").collect()
    assert rows[0].minimally_corrected == "Need water."
    assert rows[0].fully_corrected == "I need water." and rows[3].fully_corrected == "Yes."
    for c in out.columns[5:]:
        assert rows[1][c] is None and rows[2][c] is None and rows[0][c] is not None
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
