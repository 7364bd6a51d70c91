"""What the second review found, each as a case that failed before."""

from array import array
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from turnloom.llm import (
    byte_bpe,
    html_text,
    ngram_trie,
    packing,
    piece_codec,
    queries,
    substrings,
    words,
)


def test_spans_stay_with_their_rows_when_the_scan_is_cut_anew(spark, shared_folder):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, f"{passage} own{i}" if i % 3 == 0 else f"word{i} alone{i}") for i in range(24)]
    path = f"{shared_folder}/cut-anew"
    spark.createDataFrame(rows, "doc_id long, text string").repartition(8, "doc_id").write.parquet(path)
    split = "spark.sql.files.maxPartitionBytes"
    kept = spark.conf.get(split)
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        found = [f(spark.read.parquet(path)) for f in (substrings.remove_repeats, substrings.with_kept_text)]
        spark.conf.set(split, "600")
        got = [{r["doc_id"]: r[c] for r in df.collect()} for df, c in zip(found, ("kept", "text"))]
    finally:
        spark.conf.set(split, kept)
        spark.conf.unset("spark.sql.files.minPartitionNum")
    want = {i: f"own{i}" if i % 3 == 0 and i else t for i, t in rows}
    assert got == [want, want]


@pytest.mark.parametrize("shard", [1 << 19, 20])
def test_words_without_ids_keep_their_own_ngrams(spark, shared_folder, monkeypatch, shard):
    # the same words in other order: one id for all words without ids could not tell them apart
    rows = [(i, " ".join(f"w{(i * k + j) % 17}" for j in range(9)) + f" only{i}") for i, k in zip(range(60), [1, 3, 5] * 20)]
    path = f"{shared_folder}/own-ngrams-{shard}"
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    monkeypatch.setattr(ngram_trie, "SHARD_TOKENS", shard)
    docs = spark.read.parquet(path)
    full = {r.doc_id: r for r in ngram_trie.score(docs).collect()}
    for size in (0, 5) if shard > 20 else (12,):
        monkeypatch.setattr(ngram_trie, "VOCABULARY", size)
        for r in ngram_trie.score(docs).collect():
            want = full[r.doc_id]
            assert r[:5] == want[:5]
            assert r.base_score == pytest.approx(want.base_score)
            assert abs(r.score - want.score) < 0.02 * r.n_tokens


def test_tries_of_very_many_words_are_the_same():
    rng = np.random.default_rng(7)
    v, u, w = rng.integers(2, 9, (3, 500))
    n, none = np.ones(500, np.int64), np.zeros(0, np.int64)
    log_p1 = np.log10(np.full(9, 0.1))
    got = []
    for bits in (20, 25):
        data = ngram_trie.build_wide(v << bits | u, w, n, none, none, log_p1, bits)
        got.append(ngram_trie.Trie(data, bits).score_wide(v, u, w, log_p1))
    assert (got[0] == got[1]).all()


def test_names_set_aside_only_what_they_name():
    story = "the story of the town and of the people in it was told by them " * 4
    for page in (
        f"<main class='no-sidebar'><p>{story}</main>",
        f"<div class='has-sidebar'><p>{story}</div>",
        f"<div class='sidebar'><article class='comments-open'><p>{story}</article></div>",
        f"<article><section id='discussion'><p>{story}</section></article>",
        f"<article><p class='notice-board'>{story}</article>",
    ):
        assert html_text.main_text(page) == story.strip()
    assert html_text.main_text(f"<article><h2 id='related-work'>Work</h2><p>{story}</article>").startswith("Work")
    assert html_text.main_text(f"<article>t</article><div class='site-footer'><p>{story}</div>") == "t"


def test_pages_without_known_stop_words_have_text():
    text = "Kaupungin asukkaat kertoivat tarinan kirjastossa eilen illalla " * 5
    assert html_text.main_text(f"<nav>Valikko</nav><div><p>{text}</div>") == text.strip()


def test_hashes_do_not_depend_on_the_bytes_taken_at_a_time(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join("x" * int(n) + str(n) for n in rng.integers(1, 200, 60)).encode() for _ in range(9)]
    found = words.split([*texts, None, b"", b"y" * 5000])
    whole = words.hashes(found)
    for size in (1, 50, 1000):
        monkeypatch.setattr(words, "HASH_BYTES", size)
        assert (words.hashes(found) == whole).all()
    assert len(set(whole.tolist())) == len({w for t in texts for w in t.split()}) + 1


def test_odd_characters_are_told_alike_both_ways():
    for c in [*range(0, 0x300), 0x2010, 0x2028, 0x20AC, 0x65E5, 0x1F600]:
        text = "a" + chr(c) + "b"
        assert byte_bpe.is_odd(text) == bool(byte_bpe._odd.search(text))


def test_a_plan_is_never_worse_than_best_fit():
    rng = np.random.default_rng(0)
    lengths = np.clip(rng.lognormal(6.8, 0.6, 20_000).astype(int), 1, 2048)
    plan, bound = packing.solve(Counter(lengths.tolist()))
    counts = np.bincount(lengths, minlength=2049)
    alone = packing.best_fit(np.where(np.arange(2049) < 2048, counts, 0), 2048).total() + counts[2048]
    assert bound <= plan.total() <= alone


def test_one_function_encodes_and_decodes(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = [(1, "One two  three"), (2, None), (3, ""), (4, "日本 \x01 été")]
    df = spark.createDataFrame(texts, "n int, text string")
    both = piece_codec.there_and_back(path).alias("x")
    rows = df.select("n", both, piece_codec.encode(path).alias("ids")).collect()
    assert [r.x.ids for r in rows] == [r.ids for r in rows]
    back = df.select("n", piece_codec.encode(path).alias("ids")).select("n", piece_codec.decode(path).alias("t"))
    assert [r.x.text for r in rows] == [r.t for r in back.collect()]
    shown = queries.QUERIES["op5_sentencepiece"](spark, "/root/testdata/sf0.001")
    plan = shown._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1 and "encode" not in plan


def test_chained_pieces_have_the_ids_of_each_alone():
    path = public_tokenizers.path("byte_bpe_50k.json")
    words_ = packing.IdBytes(path)
    pieces = ["The", " quick", "\nbrown's", " été", " 日本", "  ", " x ", " a,b", "\n", " <|endoftext|>", " 1234567"] * 3
    alone = [words_.resolve([p])[0] for p in pieces]
    library = [array("I", x).tobytes() for x in words_.encode(pieces)]
    assert words_.resolve(pieces) == alone == library
    assert words_._parted("ab", [1, 1]) is None or len(words_.encode(["ab"])[0]) == 2


def test_a_page_in_an_unknown_language_keeps_its_text():
    # "on" and "se" are listed words of other languages, and too few to decide by
    first = "Talo on vanha ja se sijaitsee meren rannalla, jossa tuuli puhaltaa usein kovaa syksyisin. " * 4
    second = "Kylän asukkaat kertovat mielellään tarinoita menneistä ajoista ja kalastajien elämästä. " * 3
    menu = "<ul>" + "".join(f'<li><a href="/{i}">sivu {i}</a></li>' for i in range(9)) + "</ul>"
    page = f"<body>{menu}<div>{first}</div><p>Lyhyt väli.</p><div>{second}</div><footer>yhteys</footer></body>"
    assert html_text.main_text(page) == f"{first.strip()}\n\nLyhyt väli.\n\n{second.strip()}"
