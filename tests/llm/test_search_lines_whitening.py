"""Ranked search, line dedup and whitening against brute force, on hard inputs and small tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from turnloom.llm import ball_tree, common_lines, queries, whitening

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
NAMES = ("uid", "id", "text_", "terms", "tf", "n", "rank", "score", "h1", "r1", "place", "weight", "x", "z")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def stored(spark, folder, name, rows, schema, parts=2):
    df = spark.createDataFrame(rows, schema)
    for extra in NAMES:  # names that operators might use themselves
        if extra not in df.columns:
            df = df.withColumn(extra, F.lit("extra"))
    df.repartition(parts).write.mode("overwrite").parquet(f"{folder}/{name}")
    return spark.read.parquet(f"{folder}/{name}")


# ---- ranked search

DOCS = [
    (1, "The cat, the hat; THE bat."),
    (2, "the cat sat"),
    (3, "the cat sat"),
    (3, "the cat sat"),
    (4, None),
    (5, ""),
    (6, " .,;\x00 "),
    (None, "the cat sat"),
    (7, "Ünder große日本 cat_hat 42 — cat"),
    (8, " ".join(f"x{i % 997}" for i in range(20_000)) + " cat"),
    (9, "nothing in common"),
    (-1, "bat " * 300),
    *[(100 + i, f"cat w{i % 7} w{i % 11} w{i % 3}") for i in range(80)],
    *[(300 + i, "copy of the hat") for i in range(70)],
]
ITEMS = [
    (1, "CAT hat"), (1, "CAT hat"), (2, None), (3, ""), (4, "?!"), (None, "bat"), (5, "absent words"),
    (6, "groSSe große w1 w2 w3 w4 cat"), (7, " ".join(f"x{i}" for i in range(0, 2000, 3))),
    (8, "— 42"), (9, "the copy"), (10, "cat"),
]


def ranked(docs, items, k):
    split = [(i, TERM.findall(lower(t))) for i, t in docs]
    split = [(i, t) for i, t in split if t]
    n, total = len(split), sum(len(t) for _, t in split)
    df = Counter(t for _, terms in split for t in set(terms))
    out = Counter()
    for item, text in items:
        scores = []
        for id_, terms in split:
            tf = Counter(terms)
            m = 50 + 50 * len(terms) * n // total
            score = 0
            for t in set(TERM.findall(lower(text))) & set(tf):
                weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                score += weight * (1_000_000_000 * tf[t] // (1000 * tf[t] + 20 * m))
            if score > 0:
                scores.append((-score, id_ is None, id_ or 0, id_))
        scores.sort(key=lambda s: s[:3])
        out.update((item, r, s[3], -s[0]) for r, s in enumerate(scores[:k], 1))
    return out


@pytest.mark.parametrize("change", [{}, {"BLOCK_TERMS": 300}, {"BLOCK_QUERIES": 3}, {"TREE_VECTORS": 5},
                                    {"TREE_ENTRIES": 40, "LEAF": 1}, {"FIRST_LOOK": 20}])
def test_top_documents(spark, shared_folder, monkeypatch, change):
    for name, value in change.items():
        monkeypatch.setattr(ball_tree, name, value)
    docs = stored(spark, shared_folder, "search-docs", DOCS, "doc_id long, text string", 3)
    items = stored(spark, shared_folder, "search-items", ITEMS, "item_id long, text string")
    for k in (50, 3):
        rows = ball_tree.top_documents(docs, items, k=k).collect()
        assert Counter(tuple(r) for r in rows) == ranked(DOCS, ITEMS, k)


def test_top_documents_of_nothing(spark, shared_folder):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.filter("text is null"), items)):
        found = ball_tree.top_documents(d, i)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.collect() == []


def test_lengths_beyond_a_long_count_exactly():
    got = ball_tree.impacts(np.array([3, 1]), np.array([10**9, 5]), 10**10, 10**13)
    want = [1_000_000_000 * tf // (1000 * tf + 20 * (50 + 50 * n * 10**10 // 10**13)) for tf, n in ((3, 10**9), (1, 5))]
    assert got.tolist() == want


def _random_tree(rng, n, terms, shapes):
    # vectors around a few shapes, as documents of a language or a topic
    shape = [rng.choice(terms, 30, replace=False) for _ in range(shapes)]
    rows = [np.sort(rng.choice(shape[rng.integers(shapes)], rng.integers(1, 12), replace=False)) for _ in range(n)]
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    return ends, np.concatenate(rows), rng.integers(0, 10**9, ends[-1])


def test_no_vector_goes_beyond_its_nodes_bounds():
    rng = np.random.default_rng(1)
    for _ in range(15):
        ends, terms, values = _random_tree(rng, int(rng.integers(1, 200)), 120, 4)
        tree = ball_tree.BallTree(ends, terms, values, 120)
        dense = np.zeros((len(ends) - 1, 120), np.int64)
        dense[np.repeat(np.arange(len(ends) - 1), np.diff(ends)), terms] = values
        query = np.sort(rng.choice(120, 15, replace=False))
        bounds = tree.bounds(query)
        for (a, b), bound in zip(tree.spans, bounds):
            assert dense[tree.order[a:b]][:, query].sum(axis=1).max() <= bound
        # each ball holds its vectors
        for (a, b), radius in zip(tree.spans, tree.radius):
            part = dense[tree.order[a:b]].astype(float)
            assert np.linalg.norm(part - part.mean(axis=0), axis=1).max() <= radius


def test_subtrees_are_pruned():
    rng = np.random.default_rng(2)
    ends, terms, values = _random_tree(rng, 4000, 3000, 60)
    tree = ball_tree.BallTree(ends, terms, values, 3000)
    asked = [np.sort(terms[ends[i] : ends[i + 1]]) for i in range(0, 4000, 400)]
    best = ball_tree.Best(asked, 3000, np.ones(len(asked), np.int64), 10)
    best.look_through(tree, [np.array([i]) for i in range(4000)])
    assert best.scored < 0.1 * len(asked) * 4000


# ---- lines

LONG = "this line is long enough to be judged, as it has forty characters"
LINES = [
    *[(i, f"own line {i}\n  {LONG.upper()} \t\nand the end {i}") for i in range(1, 6)],
    (6, LONG), (6, LONG), (7, f"{LONG}\n{LONG}\n{LONG}"), (8, None), (9, ""), (10, "\n\n"),
    (None, f"{LONG}\nx"), (None, LONG),
    *[(20 + i, "short\nshort\n" + "é" * 39) for i in range(9)],
    *[(40 + i, "É" * 40 + "\r\n" + "é" * 40) for i in range(4)],
    *[(60 + i, "É" * 40 + "\n" + "Ab" * 20 + "\n" + "aB" * 20) for i in range(3)],
    (80, "\n".join(f"line {i} of many, some of which are {LONG}" if i % 3 else LONG for i in range(5000))),
    (81, f"{LONG}\n" * 3),
]


def without_lines(rows):
    key = lambda line: lower(line.strip(" \t\n\x0b\f\r"))
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(i)
    keeper = {
        k: max((i for i in ids if i is not None), default=None)
        for k, ids in holders.items() if len(k) >= 40 and len(ids) >= 5
    }
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == i]
        out[i, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


def test_drop_common_lines(spark, shared_folder):
    docs = stored(spark, shared_folder, "line-docs", LINES, "doc_id long, text string")
    rows = common_lines.drop_common_lines(docs).collect()
    want = without_lines(LINES)
    assert any(n[2] for n in want) and Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in rows) == want
    assert common_lines.drop_common_lines(docs.limit(0)).collect() == []


def test_line_query_on_a_small_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op12_line_dedup"](spark, sf).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = Counter((i, n, d, sha(t)) for i, n, d, t in without_lines([tuple(r) for r in rows]).elements())
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got) == want


def test_no_python_runs_in_the_line_plan(spark, shared_folder):
    docs = stored(spark, shared_folder, "line-docs", LINES, "doc_id long, text string")
    plan = common_lines.drop_common_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- whitening


def whitened(vectors, count=8):
    """By the definition, row by row, from exact sums."""
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(axis=0)
    gap = n * x - sums
    centred = gap.astype(float) / n
    covariance = centred.T @ centred / n
    values, units = np.linalg.eigh(covariance)
    values, units = values[::-1][:count], units[:, ::-1][:, :count]
    return (gap**2).sum(axis=1), centred @ units / np.sqrt(values), values / np.trace(covariance)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    mix = rng.normal(size=(12, 12))
    some = (rng.normal(size=(300, 12)) @ mix).astype(np.float32)
    return [*some[:250], *[some[0]] * 150, *some[3:7]]  # one vector in a third of all rows


def check(rows, ids, vectors):
    deviation, z, explained = whitened(vectors)
    by_id = defaultdict(dict)
    for r in rows:
        by_id[r.vec_id][r.component] = r
    assert len(rows) == len(ids) * z.shape[1]
    sign = {}
    for place, i in enumerate(ids):
        for c in range(z.shape[1]):
            r = by_id[i][c + 1]
            assert (r.n, r.deviation) == (len(vectors), deviation[place])
            assert r.explained == pytest.approx(explained[c], rel=1e-9)
            assert 0 <= r.identity_error < 1e-9
            if abs(z[place, c]) > 1e-6:
                sign.setdefault(c, math.copysign(1, r.whitened * z[place, c]))
            assert r.whitened == pytest.approx(sign.get(c, 1) * z[place, c], abs=1e-8)


def test_whiten(spark, shared_folder, vectors):
    bad = [
        (None,), ([],), ([None] * 12,), ([float("nan")] * 12,), ([1.0] * 11 + [float("inf")],), ([1.0, 2.0],),
    ]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    table = rows + [(9000 + i, v) for i, (v,) in enumerate(bad)]
    df = stored(spark, shared_folder, "whiten", table, "vec_id long, embedding array<float>", 4)
    got = whitening.whiten(df).collect()
    check(got, range(len(vectors)), vectors)
    assert len({r.identity_error for r in got}) == 1


def test_whiten_query_on_a_small_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    check(queries.QUERIES["op13_embedding_whitening"](spark, sf).collect(),
          [r.vec_id for r in rows], [r.embedding for r in rows])


def test_whiten_without_variance(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema)).collect() == []
    alone = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25]), (None, [0.5, 0.25])], schema)).collect()
    assert sorted((r.vec_id or 0, r.component, r.n, r.deviation) for r in alone) == [
        (0, 1, 2, 0), (0, 2, 2, 0), (1, 1, 2, 0), (1, 2, 2, 0)]
    assert all(r.whitened is r.explained is r.identity_error is None for r in alone)
    # two dimensions that move together have one component
    line = whitening.whiten(spark.createDataFrame([(i, [i / 4, i / 2, 0.0]) for i in range(9)], schema)).collect()
    first = {r.vec_id: r for r in line if r.component == 1}
    assert first[8].whitened == pytest.approx(-first[0].whitened) and first[0].explained == pytest.approx(1)
    assert all(r.whitened is None for r in line if r.component > 1)


def test_whiten_holds_what_is_too_large(spark):
    rows = [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 3.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 6 and max(r.deviation for r in got) == (1 << 63) - 1


def test_sums_beyond_a_long_are_exact():
    x = np.array([[3, 5], [10**6, 7]])
    gap = whitening._deviations(x, 10**13, [10**18, 10**19])
    assert gap.tolist() == [[3 * 10**13 - 10**18, 5 * 10**13 - 10**19], [10**19 - 10**18, 7 * 10**13 - 10**19]]
    batch = pa.RecordBatch.from_pydict({"x": [[3, 5]], "weight": [2]})
    assert next(whitening._products(1, [1, 1])(iter([batch])))["row"].to_pylist() == [[8.0, 16.0], [16.0, 32.0]]
