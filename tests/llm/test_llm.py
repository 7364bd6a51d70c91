"""Operators of ``turnloom.llm`` against brute force, on hard inputs and on the small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from turnloom.llm import (
    byte_bpe,
    cover_tree,
    html_text,
    line_crf,
    ngram_trie,
    packing,
    piece_codec,
    simhash,
    substrings,
    token_counts,
    toxicity,
)

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = " ".join(f"w{i}" for i in range(60))
# null and empty texts, copies, near copies, repeated rows, a null id, a long text, odd blanks
TEXTS = [
    (1, BASE),
    (2, BASE),
    (2, BASE),
    (3, BASE + " more"),
    (4, None),
    (5, ""),
    (6, " \n\t "),
    (None, "one two"),
    (7, "One  TWO\nthree é 日本 <|endoftext|>"),
    (8, " ".join(f"x{i % 997}" for i in range(30_000))),
    (9, "a b " * 40),
    (10, "start " + " ".join(f"w{i}" for i in range(20, 50)) + " end"),
]


@pytest.fixture(scope="module")
def docs(spark, shared_folder):
    df = spark.createDataFrame(TEXTS, "doc_id long, text string")
    # names that operators might use themselves
    for name in ("uid", "fp", "rank", "kept", "component_id", "id", "row"):
        df = df.withColumn(name, F.lit(name))
    df.coalesce(2).write.mode("overwrite").parquet(f"{shared_folder}/llm-docs")
    return spark.read.parquet(f"{shared_folder}/llm-docs")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def words(text):
    return WORD.findall(text or "")


def fingerprint(text):
    found = words(_lower(text))
    grams = [" ".join(found[i : i + 3]) for i in range(len(found) - 2)]
    grams = grams or ([" ".join(found)] if found else [])
    values = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def _lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def test_simhash(spark, docs, empty):
    rows = simhash.near_duplicates(docs).collect()
    prints = [(i, fingerprint(t)) for i, t in TEXTS]
    assert Counter((r.doc_id, r.fp % (1 << 64)) for r in rows) == Counter(prints)
    near = lambda a, b: (a ^ b).bit_count() <= 3
    values = {p for _, p in prints}
    for r in rows:
        reached, seen = {r.fp % (1 << 64)}, set()
        while reached - seen:
            x = (reached - seen).pop()
            seen.add(x)
            reached |= {v for v in values if near(x, v)}
        ids = [i for i, p in prints if p in reached and i is not None]
        assert r.component_id == (min(ids) if ids else None)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    stays = {r.doc_id for r in rows if r.doc_id is not None and r.doc_id == r.component_id}
    assert 2 not in stays and sorted(r.doc_id for r in kept.collect() if r.doc_id) == sorted(stays)
    assert simhash.near_duplicates(empty).count() == 0


def test_gray_index_finds_the_components():
    rng = np.random.default_rng(0)
    for _ in range(20):
        base = rng.integers(0, 2**63, rng.integers(1, 5), dtype=np.uint64)
        values = []
        for _ in range(rng.integers(1, 300)):
            x = int(rng.choice(base))
            for bit in rng.integers(0, 64, rng.integers(0, 5)):
                x ^= 1 << int(bit)
            values.append(x)
        index = simhash.GrayIndex(np.array(values, np.uint64))
        near = np.bitwise_count(index.values[:, None] ^ index.values[None, :]) <= 3
        labels = np.arange(len(near))
        while (lower := np.array([labels[row].min() for row in near])).tolist() != labels.tolist():
            labels = lower
        assert (index.components(3) == labels).all()


@pytest.mark.parametrize("rows", [10, 10**8, 10**10])
def test_bucket_masks_miss_no_near_pair(rows):
    masks = simhash.bucket_masks(rows)
    rng = np.random.default_rng(1)
    for _ in range(500):
        gap = sum(1 << int(b) for b in set(rng.integers(0, 64, 3).tolist()))
        assert any(not gap & m for m in masks)


def test_components_of_a_path(spark):
    edges = spark.range(1, 40).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    assert {r.root for r in simhash.components(edges).collect()} == {0}


def repeats(rows):
    seen, out = set(), []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    for i in order:
        found = words(rows[i][1])
        gone = [False] * len(found)
        for s in range(len(found) - 19):
            window = tuple(found[s : s + 20])
            if window in seen:
                gone[s : s + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, g in zip(found, gone) if not g)
        out.append((rows[i][0], len(found), sum(gone), kept))
    return Counter(out)


@pytest.mark.parametrize("hot", [False, True])
def test_substrings(docs, empty, monkeypatch, hot):
    if hot:  # every minimiser is dealt in two rounds
        monkeypatch.setattr(substrings, "HOT_RUNS", 1)
    got = substrings.remove_repeats(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == repeats(TEXTS)
    assert substrings.with_kept_text(docs).columns == docs.columns
    assert substrings.remove_repeats(empty).count() == 0


def test_substrings_tell_equal_hashes_apart():
    words_ = substrings.split([b"a b c d"])
    place, owner = np.array([0, 2]), np.array([0, 0])
    assert not substrings._same_words(words_, place, owner, np.array([0, 1]), 2)
    assert substrings._first_equal_words(words_, place, 2).tolist() == [0, 1]


PAGES = {
    "<nav><a href=1>Menu</a></nav><article><h1>T</h1><p>a &amp; b<p>c<br>d</article>x": "T\n\na & b\n\nc d",
    "<article><p>t</p><aside>no</aside><form>no</form><div class='comments'>no</div></article>": "t",
    '<div id="cookie-notice">no</div><p>' + "the story of the town " * 20: "the story of the town " * 20,
    "<script>if (a < b) { '</p>' }</script><style>p{}</style><!-- no": "",
    "<article>a\n  b <b>c</b></article><footer>no": "a b c",
}


def test_html(spark, empty):
    for page, text in PAGES.items():
        assert html_text.main_text(page) == text.strip()
    assert html_text.main_text(None) == html_text.main_text("") == ""
    df = spark.createDataFrame([(1, None), (2, "<article>x" + "y" * 100_000)], "page_id long, html string")
    got = {r.page_id: len(r.t) for r in df.select("page_id", html_text.extract().alias("t")).collect()}
    assert got == {1: 0, 2: 100_001}


def test_pieces_match_and_come_back(docs):
    piece_codec.verify(PIECES, [t for _, t in TEXTS if t and len(t) < 5000])
    rows = docs.select("text", piece_codec.encode(PIECES).alias("ids"))
    rows = rows.select("text", piece_codec.decode(PIECES, "ids").alias("back")).collect()
    assert all(r.back == (r.text or "") for r in rows)


def test_unigram_model_is_rebuilt():
    model = piece_codec.Model(
        [("<unk>", 0.0, 2), ("▁a", -1.0, 1), ("b", -2.0, 1), ("▁ab", -1.5, 1)], 1, False, b"", True, True, True
    )
    tokenizer = piece_codec.rebuild(model)
    assert tokenizer.encode("ab  a").ids == [3, 1]


def test_token_counts(docs, empty):
    library = Tokenizer.from_file(BPE)
    expected = Counter((i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in TEXTS)
    got = token_counts.token_counts(docs, BPE).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == expected
    assert token_counts.token_counts(empty, BPE).count() == 0


def test_plain_characters_are_cut_alike():
    library = Tokenizer.from_file(BPE).pre_tokenizer
    plain = re.compile(f"[{byte_bpe.PLAIN}]")
    for c in filter(plain.match, map(chr, range(0x20000))):
        for text in (f"a{c}b1{c}2 {c} x  {c}{c}-{c}-", f"{c}'s '{c}"):
            cut = [text[a:b] for _, (a, b) in library.pre_tokenize_str(text)]
            assert byte_bpe._cut.findall(text) == cut


def test_top_k(spark, empty, monkeypatch):
    monkeypatch.setattr(cover_tree, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=4)], 0) for i in range(170)]
    rows += [(i, [1.0, 1.0, 0.0, 0.0], 0) for i in range(170, 240)]
    rows += [(240, None, 0), (241, [1.0, None, 0.0, 0.0], 0), (242, [math.inf] * 4, 0), (None, [1.0] * 4, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    good = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows[:240]]
    expected = set()
    for q, v in good:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)
            expected |= {(q, r, i, -s) for r, (s, i) in enumerate(scored[:5], 1)}
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in cover_tree.top_k(df).collect()}
    assert got == expected
    assert cover_tree.top_k(df.limit(0)).count() == 0


def test_cover_tree_invariants():
    tree = cover_tree.CoverTree(np.random.default_rng(3).normal(size=(500, 2)))
    assert sum(len(m) for m in tree.members if m is not None) == 500
    for node, children in enumerate(tree.children):
        if children is None:
            rows = tree.members[node]
            assert (tree._distances(int(tree.center[node]), rows) <= tree.radius[node] + 1e-12).all()


def test_line_counts():
    texts = [t for _, t in TEXTS] + ["x\nx\n\nx #$ y\n", "p q r s t u v w " * 2 + "z"]
    _, counts = line_crf.describe([None if t is None else t.encode() for t in texts])
    for i, text in enumerate(texts):
        found = words(text)
        lines = [x for x in (text or "").split("\n") if words(x)]
        grams = Counter(tuple(found[j : j + 8]) for j in range(len(found) - 7))
        covered = {
            k for j in range(len(found) - 7) if grams[tuple(found[j : j + 8])] > 1 for k in range(j, j + 8)
        }
        expected = (
            len(found),
            sum(map(len, found)),
            len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)),
            len(covered),
        )
        assert tuple(int(c[i]) for c in counts) == expected


def test_viterbi_and_training():
    rng = np.random.default_rng(4)
    label = rng.integers(0, 2, 60)
    first = np.concatenate([[0], np.cumsum(rng.integers(1, 9, 60))])
    gold = np.repeat(label, np.diff(first))
    noise = rng.random(len(gold)) < 0.15
    lines = np.where(gold ^ noise, 1, 2).astype(np.uint64)
    field = line_crf.train(lines, first, label)
    found = line_crf.decode(field, lines, first)
    assert (found == gold).mean() > 0.9
    score = line_crf._matrix(lines) @ field.weights + field.bias
    for d in range(5):  # the best of all label sequences
        s = score[first[d] : first[d + 1]]
        best = max(
            (
                sum(x for x, y in zip(s, way) if y) + sum(field.stay[a, b] for a, b in zip(way, way[1:])),
                way,
            )
            for way in ([int(c) for c in f"{n:0{len(s)}b}"] for n in range(1 << len(s)))
        )[1]
        assert found[first[d] : first[d + 1]].tolist() == best


def test_quality_and_toxicity_on_the_tables(spark, docs, empty):
    folder = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    field = line_crf.fit(documents, labels)
    rows = documents.join(labels, "doc_id").select("quality", line_crf.judge(field).alias("r"))
    judged = [(r.quality, r.r.kept) for r in rows.collect() if not r.r.base_failed]
    assert sum(kept == bool(q) for q, kept in judged) > 0.95 * len(judged)
    chain = toxicity.fit(documents, labels, {"low": "quality = 0", "toxic": "toxic = 1"})
    rows = documents.join(labels, "doc_id").select("toxic", toxicity.probabilities(chain).alias("p"))
    rows = [(r.toxic, r.p.toxic >= 0.5) for r in rows.collect()]
    assert sum(p == bool(t) for t, p in rows) > 0.93 * len(rows)
    for df in (docs, empty):
        both = df.select("doc_id", toxicity.probabilities(chain).alias("p"), line_crf.judge(field).alias("r")).collect()
        assert len(both) == df.count() and all(0 <= x.p.toxic <= 1 for x in both)
        assert all(not x.r.kept for x in both if x.r.base_failed)
    none = toxicity.fit(documents, labels.limit(0), {"toxic": "toxic = 1"})
    assert docs.filter(toxicity.probabilities(none).toxic > 0.5).count() == 0
    assert line_crf.fit(documents, labels.limit(0)).bias > 0


def test_earlier_probabilities_are_out_of_fold():
    rng = np.random.default_rng(5)
    n = 400
    y = rng.integers(0, 2, n)
    doc = np.concatenate([np.arange(n), np.arange(n)])
    word = np.concatenate([np.where(y == 1, 10, 11), rng.integers(20, 30, n)])
    labels = np.stack([y, y], axis=1)
    chain = toxicity.train(doc, word, labels, np.arange(n) % 5)
    assert len(chain[0].earlier) == 0 and len(chain[1].earlier) == 1
    p = toxicity._predict(chain[0], doc, word, n, np.zeros((n, 0)))
    assert ((p > 0.5) == (y == 1)).all()


def language_model(rows):
    tokens = [[w for w in words(_lower(t))] + [None] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    c1, c2, c3 = Counter(), Counter(), Counter()
    for t, h in zip(tokens, held):
        if not h:
            padded = ["<", "<", *t]
            c1.update(t)
            c2.update(zip(padded[1:], t))
            c3.update(zip(padded, padded[1:], t))
    total, kinds = c1.total(), len(c1)

    def behind(counts, context, word, lower):
        n = sum(v for k, v in counts.items() if k[:-1] == context)
        if not n:
            return lower
        seen = sum(1 for k in counts if k[:-1] == context)
        return (max(counts[*context, word] - 0.75, 0) + 0.75 * seen * lower) / n

    for (i, _), t, h in zip(rows, tokens, held):
        single = [(c1[w] + 0.5) / (total + 0.5 * (kinds + 1)) for w in t]
        padded = ["<", "<", *t]
        p3 = [
            behind(c3, (a, b), w, behind(c2, (b,), w, p))
            for a, b, w, p in zip(padded, padded[1:], t, single)
        ]
        yield i, h, len(t), sum(c1[w] > 0 for w in t), total, sum(map(math.log10, single)), sum(map(math.log10, p3))


@pytest.mark.parametrize("shard", [1 << 19, 20])
def test_language_model(spark, docs, empty, shared_folder, monkeypatch, shard):
    monkeypatch.setattr(ngram_trie, "SHARD_TOKENS", shard)
    rows = [(i, t) for i, t in TEXTS if not t or len(t) < 1000]
    path = f"{shared_folder}/lm-{shard}"
    spark.createDataFrame(rows, "doc_id long, text string").write.mode("overwrite").parquet(path)
    key = lambda r: (r[0] is None, r[0] or 0)
    got = sorted(map(tuple, ngram_trie.score(spark.read.parquet(path)).collect()), key=key)
    for a, b in zip(got, sorted(language_model(rows), key=key), strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9)
        assert abs(a[6] - b[6]) < 0.05 * a[2]
    assert ngram_trie.score(empty).count() == 0


def test_rare_words_keep_their_counts(spark, docs, monkeypatch):
    full = {r.doc_id: r for r in ngram_trie.score(docs).collect()}
    monkeypatch.setattr(ngram_trie, "VOCABULARY", 10)
    for r in ngram_trie.score(docs).collect():
        assert (r.n_known, r.base_score) == (full[r.doc_id].n_known, pytest.approx(full[r.doc_id].base_score))
        assert math.isfinite(r.score)


def test_scores_when_rows_come_in_another_order_each_time(spark, docs):
    def shuffled(batches):
        for batch in batches:
            yield batch.take(np.random.default_rng().permutation(batch.num_rows))

    rows = docs.select("doc_id", "text").coalesce(1)
    moved = rows.mapInArrow(shuffled, rows.schema)
    key = lambda r: (r.doc_id is None, r.doc_id or 0)
    got = sorted(ngram_trie.score(moved).collect(), key=key)
    for a, b in zip(got, sorted(ngram_trie.score(docs).collect(), key=key), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == (pytest.approx(b[5]), pytest.approx(b[6]))


def test_trie_can_be_mapped(tmp_path):
    rng = np.random.default_rng(6)
    key, n = np.unique((rng.integers(2, 9, (500, 3)) << np.array([40, 20, 0])).sum(axis=1), return_counts=True)
    log_p1 = np.log10(np.full(9, 0.1))
    none = np.zeros(0, np.int64)
    data = ngram_trie.build(key, n, none, none, log_p1)
    (tmp_path / "trie").write_bytes(data)
    mapped = ngram_trie.Trie(memoryview(np.memmap(tmp_path / "trie", np.uint8, "r")))
    assert (mapped.score(key, log_p1) == ngram_trie.Trie(data).score(key, log_p1)).all()


def test_packing(docs, empty):
    library = Tokenizer.from_file(BPE)
    ids = [library.encode(t or "", add_special_tokens=False).ids + [0] for _, t in TEXTS]
    expected = Counter()
    for (i, _), found in zip(TEXTS, ids):
        for piece, (start, length) in enumerate(packing.cut(len(found))):
            part = np.array(found[start : start + length], "<u4").tobytes()
            expected[i, piece, start, length, zlib.crc32(part)] += 1
    rows = packing.pack(docs, BPE).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY
    assert packing.pack(empty, BPE).count() == 0


def test_plan_is_near_the_bound():
    rng = np.random.default_rng(7)
    lengths = Counter(np.minimum(2048, rng.lognormal(6.3, 0.9, 20_000).astype(int) + 1).tolist())
    plan, bound = packing.solve(lengths)
    held = Counter()
    for chosen, times in plan.items():
        assert sum(chosen) <= 2048
        for length in chosen:
            held[length] += times
    assert held == lengths
    assert bound <= plan.total() <= 1.003 * bound + 2
    keys, sequences, offsets = packing.slots(plan)
    assert len(keys) == sum(map(len, plan))


def test_pipeline_stages(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    rows = corpus_pipeline.run(spark, folder).collect()
    found = {r.doc_id for r in rows}
    assert found and found <= {r.doc_id for r in documents.collect()}
    assert len(corpus_pipeline.STAGES) == 5


def test_digest_of_kept_words(spark):
    from turnloom.llm.queries import op3_substring_dedup

    got = op3_substring_dedup(spark, "/root/testdata/sf0.001").collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    expected = Counter(
        (i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in repeats(rows).elements()
    )
    assert Counter(tuple(r) for r in got) == expected
