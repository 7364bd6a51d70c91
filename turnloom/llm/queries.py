"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from turnloom.llm import (
    ball_tree,
    common_lines,
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
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary files lie; the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex("fp").alias("fingerprint"), "component_id")


# Categories in the order of the chain, as conditions on ``labels``.
CATEGORIES = {
    "low_quality": "quality = 0",
    "toxic": "toxic = 1",
    "toxic_and_low": "toxic = 1 and quality = 0",
}


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    chain = toxicity.fit(documents, table(spark, sf_dir, "labels"), CATEGORIES)
    scored = documents.select("doc_id", toxicity.probabilities(chain).alias("p"))
    return scored.select(
        "doc_id",
        *[F.col(f"p.{c}").alias(f"p_{c}") for c in CATEGORIES],
        (F.col("p.toxic") >= toxicity.THRESHOLD).alias("toxic"),
    )


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "pages")
        .select("page_id", "url", html_text.extract("html").alias("text"))
        .withColumn("n_chars", F.char_length("text").cast("long"))
    )


@query
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("piece_bpe_32k.model")
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", "text", piece_codec.there_and_back(path, "text").alias("codec"))
        .select(
            "doc_id",
            (F.octet_length("codec.ids") / 4).cast("long").alias("n_tokens"),
            F.crc32("codec.ids").alias("ids_crc32"),
            (F.col("codec.text") == F.coalesce("text", F.lit(""))).alias("round_trip"),
        )
    )


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return token_counts.token_counts(documents, tokenizer_path("byte_bpe_50k.json"))


@query
def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.top_k(table(spark, sf_dir, "embeddings"))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    field = line_crf.fit(documents, table(spark, sf_dir, "labels"))
    return documents.select("doc_id", line_crf.judge(field).alias("r")).select("doc_id", "r.*")


@query
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_trie.score(table(spark, sf_dir, "documents"))


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return packing.pack(documents, tokenizer_path("byte_bpe_50k.json"))


@query
def op11_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return ball_tree.top_documents(documents, table(spark, sf_dir, "benchmark"))


ORACLES["op11_ranked_lexical_search"] = r"""
    WITH doc_terms AS (
        SELECT doc_id, row_number() OVER () AS uid,
               regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents),
    sizes AS (SELECT uid, doc_id, len(terms) AS n FROM doc_terms WHERE len(terms) > 0),
    totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM sizes),
    tfs AS (SELECT uid, term, count(*) AS tf FROM (SELECT uid, unnest(terms) AS term FROM doc_terms) GROUP BY ALL),
    weights AS (
        SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
        FROM tfs, totals GROUP BY term),
    items AS (
        SELECT row_number() OVER () AS item, item_id,
               list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms
        FROM benchmark),
    asked AS (SELECT item, item_id, unnest(terms) AS term FROM items),
    scores AS (
        SELECT item, any_value(item_id) AS item_id, s.uid, any_value(doc_id) AS doc_id,
               sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))))::BIGINT AS score
        FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN sizes s ON s.uid = tfs.uid, totals
        GROUP BY item, s.uid)
    SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM scores WHERE score > 0 QUALIFY rank <= 50""".replace("\\", "\\")


@query
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = common_lines.drop_common_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op12_line_dedup"] = r"""
    WITH docs AS (
        SELECT row_number() OVER () AS uid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    lines AS (
        SELECT uid, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM docs),
    keyed AS (
        SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
    common AS (
        SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
        GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
    judged AS (
        SELECT k.*, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM keyed k LEFT JOIN common USING (key))
    SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count_if(gone)::BIGINT AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
    FROM judged GROUP BY uid"""


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
