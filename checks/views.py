"""The given tables in the shapes the operators expect; ``SQL`` holds the same views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def turns(spark: SparkSession, sf_dir: str, language: bool = False) -> DataFrame:
    """User turns are the AAC user's; what they typed is a plainer form of the text.

    Only views that need it pay for the join with the language. Both sides are plain
    scans, so adaptive execution can split a hot conversation.
    """
    rows = table(spark, sf_dir, "conversations")
    is_aac = F.col("role") == "user"
    typed = F.regexp_replace(F.lower("text"), r"\.\z", "")
    rows = rows.select(
        F.col("conv_id").alias("conversation_id"),
        F.col("turn").alias("turn_number"),
        F.col("role").alias("speaker"),
        is_aac.alias("is_aac_user"),
        F.when(is_aac, typed).otherwise(F.col("text")).alias("utterance"),
        F.col("text").alias("utterance_intended"),
    )
    if not language:
        return rows
    langs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("conversation_id"), F.col("lang").alias("language_code")
    )
    return rows.join(langs, "conversation_id", "left")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole conversations, each one nested record; its first turn has no intended text."""
    first = F.col("turn_number") == 0
    turn = F.struct(
        "turn_number",
        "speaker",
        "utterance",
        F.when(~first, F.col("utterance_intended")).alias("utterance_intended"),
        "is_aac_user",
    )
    rows = turns(spark, sf_dir, language=True)
    return rows.groupBy("conversation_id", "language_code").agg(
        F.transform(
            F.sort_array(F.collect_list(turn)), lambda t: t.dropFields("turn_number")
        ).alias("conversation")
    )


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("position"),
        F.col("p_name").alias("head"),
        F.col("p_type").alias("relation"),
        F.when(F.col("p_size") <= 7, "None").otherwise(F.col("p_brand")).alias("tail"),
    )


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples(spark, sf_dir).select(
        "position", F.col("head").alias("topic"), "relation", F.col("tail").alias("which")
    )


def custom_id(conversation: Column) -> Column:
    return F.concat(F.lit("c_"), conversation.cast("string"))


def contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One answer text per record; records of 2, 3 and 4 turns are damaged."""
    whole = F.to_json(
        F.struct(
            F.lit(1).alias("template_id"),
            F.concat(F.lit("scene "), F.col("conversation_id").cast("string")).alias("scene"),
            "conversation",
        )
    )
    n = F.size("conversation")
    damaged = (
        F.when(n == 2, F.replace(F.col("whole"), F.lit('"scene":'), F.lit("scene:")))
        .when(n == 3, F.regexp_replace("whole", r"\]\}\z", ",]}"))
        .when(n == 4, F.regexp_replace("whole", r"\]\}\z", ""))
        .otherwise(F.col("whole"))
    )
    return (
        conversations(spark, sf_dir)
        .withColumn("whole", whole)
        .select(
            custom_id(F.col("conversation_id")).alias("custom_id"),
            "language_code",
            F.col("conversation_id").alias("line_no"),
            damaged.alias("content"),
        )
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response line per record; the language says where the content is."""
    message = F.struct(F.struct("content").alias("message"))
    text = F.struct(F.col("content").alias("text"))
    as_message = F.struct(F.lit("m1").alias("model"), F.array(message).alias("choices"))
    as_text = F.struct(F.lit("m1").alias("model"), F.array(text).alias("choices"))
    bare = F.struct(
        F.lit("x").alias("id"), F.lit("chat.completion").alias("object"), F.col("content")
    )

    def line(body: Column) -> Column:
        return F.to_json(
            F.struct(
                F.concat(F.lit("r_"), F.col("custom_id")).alias("id"),
                "custom_id",
                F.struct(F.lit(200).alias("status_code"), body.alias("body")).alias("response"),
            )
        )

    lang = F.col("language_code")
    value = (
        F.when(lang == "fr", line(as_text))
        .when(lang == "de", line(F.to_json(as_message)))
        .when(lang == "es", line(bare))
        .otherwise(line(as_message))
    )
    return contents(spark, sf_dir).select("line_no", "custom_id", value.alias("value"))


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request metadata: one row per document, and a later one per labelled document.

    Some documents have only a longer id, Spanish ones an id of another kind.
    """
    docs = table(spark, sf_dir, "documents")
    longer = F.when(F.col("source").isin("src0", "src1", "src2", "src3"), "_x").otherwise("")
    kind = F.when(F.col("lang") == "es", "z_").otherwise("c_")
    early = docs.select(
        F.concat(kind, F.col("doc_id").cast("string"), longer).alias("custom_id"),
        F.col("doc_id").alias("line_no"),
        F.concat(F.lit("m_"), F.col("source")).alias("model"),
        F.col("lang").alias("lang_code"),
    )
    late = table(spark, sf_dir, "labels").select(
        F.concat(F.lit("c_"), F.col("doc_id").cast("string")).alias("custom_id"),
        (F.col("doc_id") + 1_000_000_000_000).alias("line_no"),
        F.concat(F.lit("q_"), F.col("quality").cast("string")).alias("model"),
        F.lit(None).cast("string").alias("lang_code"),
    )
    return early.unionByName(late)


# Every view a query's SQL may name, in the order they build on each other.
SQL = {
    "turns": r"""
        SELECT c.conv_id AS conversation_id, c.turn AS turn_number, d.lang AS language_code,
               c.role AS speaker, c.role = 'user' AS is_aac_user,
               CASE WHEN c.role = 'user' THEN regexp_replace(lower(c.text), '\.\z', '')
                    ELSE c.text END AS utterance,
               c.text AS utterance_intended
        FROM conversations c LEFT JOIN documents d ON d.doc_id = c.conv_id""",
    "nested": r"""
        SELECT *, turn_number AS place, count(*) OVER (PARTITION BY conversation_id) AS n,
               CASE WHEN turn_number = 0 THEN NULL ELSE utterance_intended END AS intended,
               'c_' || conversation_id AS custom_id
        FROM turns""",
    "triples": r"""
        SELECT p_partkey AS position, p_name AS head, p_type AS relation,
               CASE WHEN p_size <= 7 THEN 'None' ELSE p_brand END AS tail
        FROM part""",
    "entries": "SELECT position, head AS topic, relation, tail AS which FROM triples",
    "metadata": r"""
        SELECT CASE WHEN lang = 'es' THEN 'z_' ELSE 'c_' END || doc_id ||
               CASE WHEN source IN ('src0', 'src1', 'src2', 'src3') THEN '_x' ELSE '' END
               AS custom_id, doc_id AS line_no, 'm_' || source AS model, lang AS lang_code
        FROM documents
        UNION ALL
        SELECT 'c_' || doc_id, doc_id + 1000000000000, 'q_' || quality, NULL FROM labels""",
    "ids": "SELECT DISTINCT custom_id, conversation_id, n FROM nested",
    "latest": r"""
        SELECT custom_id, arg_max(model, line_no) AS model,
               max(line_no) AS line_no, min(line_no) AS first_line FROM metadata GROUP BY 1""",
    "latest_lang": r"""
        SELECT custom_id, lang_code FROM (SELECT *, row_number() OVER (
            PARTITION BY custom_id ORDER BY line_no DESC) AS r FROM metadata) WHERE r = 1""",
    "prefixed": r"""
        SELECT r.custom_id, arg_min(l.custom_id, (l.first_line, l.custom_id)) AS matched_id
        FROM ids r JOIN latest l
          ON starts_with(r.custom_id, l.custom_id) OR starts_with(l.custom_id, r.custom_id)
        WHERE r.custom_id NOT IN (SELECT custom_id FROM latest) GROUP BY 1""",
    "matched": r"""
        SELECT i.custom_id, i.conversation_id, i.n,
               coalesce(l.custom_id, p.matched_id) AS matched_id
        FROM ids i LEFT JOIN latest l ON l.custom_id = i.custom_id
        LEFT JOIN prefixed p ON p.custom_id = i.custom_id
        WHERE coalesce(l.custom_id, p.matched_id) IS NOT NULL""",
    "strings": r"""
        SELECT field, original,
               row_number() OVER (PARTITION BY field ORDER BY md5(original || '|0')) - 1 AS idx
        FROM (SELECT DISTINCT 'topic' AS field, topic AS original FROM entries
              UNION ALL SELECT DISTINCT 'which', which FROM entries)""",
    "lookup": r"""
        SELECT field, original, upper(original) AS translation FROM strings
        QUALIFY count(*) OVER (PARTITION BY field, idx // 20) = 20""",
}


def with_views(*names: str) -> str:
    """A WITH clause of the views and all views they name."""
    needed: set[str] = set()

    def add(name: str) -> None:
        needed.add(name)
        for other, text in SQL.items():
            if other != name and other not in needed and _names(SQL[name], other):
                add(other)

    for name in names:
        add(name)
    return "WITH " + ", ".join(f"{n} AS ({t})" for n, t in SQL.items() if n in needed) + " "


def _names(sql: str, view: str) -> bool:
    words = sql.replace("(", " ").replace(")", " ").replace(",", " ").split()
    return any(a in ("FROM", "JOIN") and b == view for a, b in zip(words, words[1:]))
