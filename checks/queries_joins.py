"""Sources, joins, sampling, prompts, responses and translation."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.views import (
    contents,
    conversations,
    custom_id,
    entries,
    envelopes,
    metadata,
    table,
    triples,
    turns,
    with_views,
)
from turnloom.functions import text as text_fn
from turnloom.functions.prompts import build_request as request_struct
from turnloom.functions.prompts import (
    prompt_of,
    relation_context,
    relation_phrase,
    situation_text,
)
from turnloom.functions.response import parse_conversation as parse_content
from turnloom.functions.response import repair_json, response_content, response_format
from turnloom.operators import joins, sampling, stats, translation
from turnloom.operators import turns as t
from turnloom.plans import jobs

# Joins


@query(
    """SELECT o_custkey AS customer, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS path,
    max(o_orderdate)::DATE::VARCHAR AS modified FROM orders GROUP BY 1"""
)
def latest_per_group(spark, d):
    files = table(spark, d, "orders").select(
        F.col("o_custkey").alias("customer"),
        F.col("o_orderkey").alias("path"),
        F.col("o_orderdate").alias("modified"),
    )
    newest = joins.latest_file(files, ["customer"])
    return newest.withColumn("modified", F.col("modified").cast("date").cast("string"))


def _response_ids(spark, d):
    return turns(spark, d).select(custom_id(F.col("conversation_id")).alias("custom_id")).distinct()


@query(
    with_views("ids", "latest", "latest_lang")
    + """SELECT custom_id, model, lang_code FROM ids JOIN latest USING (custom_id)
    JOIN latest_lang USING (custom_id)"""
)
def attach_metadata(spark, d):
    return joins.attach_metadata(_response_ids(spark, d), metadata(spark, d))


@query(
    with_views("prefixed", "latest")
    + """SELECT p.custom_id, p.matched_id, l.model FROM prefixed p
    JOIN latest l ON l.custom_id = p.matched_id"""
)
def prefix_join(spark, d):
    return joins.attach_by_prefix(_response_ids(spark, d), metadata(spark, d)).select(
        "custom_id", "matched_id", "model"
    )


@query(
    """SELECT o_orderkey, o_custkey FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"""
)
def pending_work(spark, d):
    done = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    work = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return joins.pending(work, done, "o_orderkey")


@query(
    "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
)
def missing_set(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return joins.missing(docs, table(spark, d, "labels"), "doc_id")


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def available_set(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return joins.available(docs, table(spark, d, "labels"), "doc_id")


@query(
    """WITH langs AS (SELECT doc_id, lang || '-' || upper(source) AS lang_code, lang AS base
        FROM documents),
    res(lang_code, value) AS (VALUES ('en-SRC1', 'exact'), ('fr', 'base'), ('en', 'last'))
    SELECT doc_id, l.lang_code, coalesce(a.value, b.value, c.value) AS value FROM langs l
    LEFT JOIN res a ON a.lang_code = l.lang_code LEFT JOIN res b ON b.lang_code = l.base
    LEFT JOIN res c ON c.lang_code = 'en'"""
)
def resolve_resource(spark, d):
    langs = table(spark, d, "documents").select(
        "doc_id", F.concat_ws("-", "lang", F.upper("source")).alias("lang_code")
    )
    resources = spark.createDataFrame(
        [("en-SRC1", "exact"), ("fr", "base"), ("en", "last")], "lang_code string, value string"
    )
    return joins.resolve_resource(langs, resources, "value")


@query(
    """WITH c AS (SELECT DISTINCT l_linenumber AS template_id, l_returnflag AS flag,
        l_linestatus AS status, l_suppkey AS supplier FROM lineitem),
    done AS (SELECT DISTINCT l_linenumber AS template_id, l_returnflag AS flag,
        l_linestatus AS status, l_suppkey AS supplier FROM lineitem WHERE l_quantity > 40)
    SELECT * FROM c EXCEPT SELECT * FROM done"""
)
def new_combinations(spark, d):
    items = table(spark, d, "lineitem")

    def combination(names):
        values = {
            "flag": F.col("l_returnflag"),
            "status": F.col("l_linestatus"),
            "supplier": F.col("l_suppkey").cast("string"),
        }
        pairs = [c for name in names for c in (F.lit(name), values[name])]
        return F.create_map(*pairs).alias("substitutions")

    template = F.col("l_linenumber").alias("template_id")
    candidates = items.select(template, combination(["flag", "status", "supplier"]))
    done = items.filter(F.col("l_quantity") > 40).select(
        template, combination(["supplier", "status", "flag"])
    )
    fresh = joins.new_combinations(candidates, done)
    return fresh.select(
        "template_id",
        F.col("substitutions")["flag"].alias("flag"),
        F.col("substitutions")["status"].alias("status"),
        F.col("substitutions")["supplier"].cast("long").alias("supplier"),
    )


@query(
    """SELECT doc_id AS id, text, lang, NULL::VARCHAR AS html FROM documents
    UNION ALL SELECT page_id, NULL, NULL, html FROM pages
    UNION ALL SELECT item_id, text, NULL, NULL FROM benchmark"""
)
def union_sources(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "lang")
    pages = table(spark, d, "pages").select(F.col("page_id").alias("id"), "html")
    items = table(spark, d, "benchmark").select(F.col("item_id").alias("id"), "text")
    return joins.union_sources(docs, pages, items)


# Translation


@query(with_views("strings") + "SELECT field, original, idx::BIGINT AS idx FROM strings")
def unique_strings(spark, d):
    return translation.unique_strings(entries(spark, d), ["topic", "which"])


@query(
    with_views("triples")
    + """SELECT position, 'head' AS path, head AS text FROM triples
    UNION ALL SELECT position, 'parts.' || p || '.word', string_split(head, ' ')[p + 1]
    FROM (SELECT position, head, unnest(range(len(string_split(head, ' ')))) AS p FROM triples)
    WHERE trim(string_split(head, ' ')[p + 1]) <> ''"""
)
def translatable_strings(spark, d):
    words = F.transform(F.split("head", " "), lambda w: F.struct(w.alias("word"), w.alias("code")))
    nested = triples(spark, d).select("position", "head", "relation", words.alias("parts"))
    return translation.translatable_strings(nested, "position", ["head", "word"])


@query(
    with_views("triples")
    + """SELECT position, upper(head) AS head, relation,
    array_to_string(list_transform(string_split(head, ' '), lambda w: upper(w) || '/' || w), ' ')
    AS parts FROM triples"""
)
def translated_in_place(spark, d):
    words = F.transform(F.split("head", " "), lambda w: F.struct(w.alias("word"), w.alias("code")))
    nested = triples(spark, d).select("position", "head", "relation", words.alias("parts"))
    texts = translation.translatable_strings(nested, "position", ["head", "word"])
    upper = texts.withColumn("text", F.upper("text"))
    done = translation.put_back(nested, "position", upper, ["head", "word"])
    parts = F.transform("parts", lambda p: F.concat_ws("/", p["word"], p["code"]))
    return done.withColumn("parts", F.array_join(parts, " "))


@query(
    with_views("strings")
    + r"""SELECT 'translate_fr-FR_' || field || '_' || (idx // 25) || '_0' AS custom_id, field,
    (idx // 25)::BIGINT AS chunk, count(*) AS strings,
    'Translate the following texts from en to fr-FR. Keep the meaning intact but make it sound '
    || 'natural in the target language. Return only the translations, one per line, with the '
    || 'same index numbers:' || chr(10) || chr(10)
    || string_agg((idx % 25 + 1) || '. ' || original || chr(10), '' ORDER BY idx) AS prompt
    FROM strings GROUP BY field, idx // 25"""
)
def chunk_requests(spark, d):
    return jobs.translation_requests(entries(spark, d), ["topic", "which"], "fr-FR", size=25)


ANSWERED = 20


def _answers(strings):
    """Responses in capitals to chunks of 20 strings; the last, shorter chunk has none yet."""
    pos = F.col("idx") % ANSWERED
    listed = F.transform(
        F.sort_array(F.collect_list(F.struct(pos.alias("pos"), "original"))),
        lambda s: F.concat_ws(". ", (s["pos"] + 1).cast("string"), F.upper(s["original"])),
    )
    chunk = F.floor(F.col("idx") / ANSWERED)
    content = F.struct(F.array_join(listed, "\n").alias("content"))
    choices = F.array(F.struct(content.alias("message")))
    return (
        strings.groupBy("field", chunk.alias("chunk"))
        .agg(F.to_json(F.struct(choices.alias("choices"))).alias("response"), F.count("*").alias("n"))
        .filter(F.col("n") == ANSWERED)
        .select(
            F.col("chunk").alias("line_no"),
            F.concat_ws(
                "_", F.lit("translate_fr-FR"), "field", F.col("chunk").cast("string"), F.lit("0")
            ).alias("custom_id"),
            "response",
        )
    )


@query(with_views("lookup") + "SELECT field, original, translation FROM lookup")
def index_lookup(spark, d):
    strings = translation.unique_strings(entries(spark, d), ["topic", "which"])
    return translation.index_lookup(strings, translation.read_batches(_answers(strings)), ANSWERED)


TRANSLATED_SQL = """SELECT position, coalesce(a.translation, topic) AS topic, relation,
    coalesce(b.translation, which) AS which, a.translation IS NOT NULL AS topic_found,
    b.translation IS NOT NULL AS which_found FROM entries
    LEFT JOIN lookup a ON a.field = 'topic' AND a.original = topic
    LEFT JOIN lookup b ON b.field = 'which' AND b.original = which"""


@query(
    """WITH lookup AS (SELECT DISTINCT p_brand AS original, upper(p_brand) AS translation FROM part
        WHERE p_brand < 'Brand#2')
    SELECT p_partkey AS position, coalesce(translation, p_brand) AS which,
    translation IS NOT NULL AS which_found FROM part LEFT JOIN lookup ON original = p_brand"""
)
def dict_translate(spark, d):
    brands = table(spark, d, "part").select(
        F.col("p_partkey").alias("position"), F.col("p_brand").alias("which")
    )
    lookup = (
        brands.filter(F.col("which") < "Brand#2")
        .select(F.lit("which").alias("field"), F.col("which").alias("original"))
        .distinct()
        .withColumn("translation", F.upper("original"))
    )
    return translation.translate_columns(brands, lookup, ["which"])


@query(with_views("entries", "lookup") + TRANSLATED_SQL)
def translation_round_trip(spark, d):
    rows = entries(spark, d)
    answers = _answers(translation.unique_strings(rows, ["topic", "which"]))
    return jobs.translation_round_trip(rows, ["topic", "which"], answers, ANSWERED)[0]


@query(
    with_views("entries", "lookup")
    + f""", done AS ({TRANSLATED_SQL})
    SELECT 'topic' AS field, count(*) FILTER (topic_found) AS matched, count(*) AS total,
    round(count(*) FILTER (topic_found) * 100.0::DOUBLE / count(*), 1) AS percent FROM done
    UNION ALL SELECT 'which', count(*) FILTER (which_found), count(*),
    round(count(*) FILTER (which_found) * 100.0::DOUBLE / count(*), 1) FROM done"""
)
def coverage(spark, d):
    rows = entries(spark, d)
    answers = _answers(translation.unique_strings(rows, ["topic", "which"]))
    return jobs.translation_round_trip(rows, ["topic", "which"], answers, ANSWERED)[1]


@query(
    """WITH lines AS (SELECT upper(p_name) AS tr, row_number() OVER (ORDER BY p_partkey) AS i
        FROM part WHERE p_size <> 7),
    e AS (SELECT p_partkey AS position, p_name AS topic,
          row_number() OVER (ORDER BY p_partkey) AS i FROM part)
    SELECT position, coalesce(tr, topic) AS topic FROM e LEFT JOIN lines USING (i)"""
)
def positional_zip(spark, d):
    parts = table(spark, d, "part")
    batches = (
        parts.filter(F.col("p_size") != 7)
        .groupBy(F.floor(F.col("p_partkey") / 25).alias("batch_index"))
        .agg(
            F.transform(
                F.sort_array(F.collect_list(F.struct("p_partkey", "p_name"))),
                lambda s: F.upper(s["p_name"]),
            ).alias("translations")
        )
    )
    rows = parts.select(F.col("p_partkey").alias("position"), F.col("p_name").alias("topic"))
    return joins.zip_translations(rows, batches, "topic", ["position"])


@query(
    with_views("strings")
    + r"""SELECT field, idx // 20 AS chunk, count(*) AS n, string_agg(upper(original), '|'
    ORDER BY idx) AS lines FROM strings GROUP BY ALL"""
)
def numbered_lines(spark, d):
    strings = translation.unique_strings(entries(spark, d), ["topic", "which"])
    pos = F.col("idx") % 20
    chunk = F.floor(F.col("idx") / 20).alias("chunk")
    listed = F.transform(
        F.sort_array(F.collect_list(F.struct(pos.alias("pos"), "original"))),
        lambda s: F.concat(
            (s["pos"] + 1).cast("string"), F.lit(". "), F.upper(s["original"]), F.lit("\nnote\n")
        ),
    )
    chunks = strings.groupBy("field", chunk).agg(F.array_join(listed, "").alias("text"))
    lines = text_fn.numbered_lines("text")
    return chunks.select(
        "field", "chunk", F.size(lines).cast("long").alias("n"), F.array_join(lines, "|").alias("lines")
    )


@query(
    """SELECT doc_id, CASE WHEN lang <> 'es' THEN 'loc-' || lang END AS lang,
    CASE WHEN lang <> 'es' THEN source END AS field,
    CASE WHEN lang <> 'es' THEN n_chars::INTEGER END AS batch_index FROM documents"""
)
def parse_custom_id(spark, d):
    docs = table(spark, d, "documents")
    start = F.when(F.col("lang") == "es", "other").otherwise("translate")
    id_ = F.concat_ws(
        "_", start, F.concat(F.lit("loc-"), "lang"), "source", F.col("n_chars").cast("string"),
        F.lit("9.1"),
    )
    return docs.select("doc_id", text_fn.parse_custom_id(id_).alias("id")).select(
        "doc_id", "id.lang", "id.field", "id.batch_index"
    )


# Sampling


@query("SELECT doc_id, lang FROM documents ORDER BY md5(doc_id || '|7') LIMIT 150")
def sample_n(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return sampling.sample_n(docs, 150, ["doc_id"], seed=7)


@query(
    """WITH n AS (SELECT count(*) AS n FROM part),
    numbered AS (SELECT p_partkey, p_name, row_number() OVER (
        ORDER BY md5(p_partkey || '|3')) - 1 AS i FROM part),
    extra AS (SELECT ('0x' || substr(md5(id || '|fill|3'), 1, 13))::BIGINT % n AS i
        FROM (SELECT unnest(range((n / 2)::BIGINT)) AS id, n FROM n))
    SELECT p_partkey, p_name FROM part
    UNION ALL SELECT p_partkey, p_name FROM extra JOIN numbered USING (i)"""
)
def sample_fill(spark, d):
    parts = table(spark, d, "part").select("p_partkey", "p_name")
    n = parts.count()
    return sampling.sample_fill(parts, n + n // 2, ["p_partkey"], seed=3)


@query(
    """SELECT conv_id, turn, CASE WHEN row_number() OVER (ORDER BY md5(conv_id || '|' || turn
    || '|0')) <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
    FROM conversations"""
)
def train_test_split(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn")
    return sampling.split_exact(rows, ["conv_id", "turn"])


TEMPLATES = [
    "Talk about {{ topic }} at {{setting}}.",
    "{{ aac_user }} and {{ partner }}: {{ relation_context }} ({{ tone }})",
    "Scene: {{ atomic_context }}. {{ nobody }}",
    "{{ aac_user_role }} in the {{ time_of_day }}",
    "No holes here",
]
NAMES = {"aac_user": ["Ann", "Ben", "Cleo"], "partner": ["Dan", "Eve"], "tone": ["calm", "glad"],
         "time_of_day": ["morning", "evening"], "extra": ["unused"]}
SYSTEM = "You write {{ language }} dialogues for {{ aac_user }}."


def _templates(spark):
    return spark.createDataFrame(list(enumerate(TEMPLATES)), "template_id int, template string")


def _substitutions(spark):
    return spark.createDataFrame(list(NAMES.items()), "key string, values array<string>")


def _graph(spark, d):
    """Triples with relation codes and person tokens."""
    relation = F.create_map(
        *[F.lit(x) for kv in RELATION_OF.items() for x in kv]
    )[F.col("relation")]
    return triples(spark, d).select(
        "position",
        F.concat(F.lit("PersonX gives "), "head", F.lit(" to PersonY")).alias("topic"),
        relation.alias("relation"),
        F.concat("tail", F.lit(" for ___")).alias("which"),
        F.lit(None).cast("string").alias("aac_user_role"),
    )


RELATION_OF = {"SMALL": "xNeed", "PROMO": "oReact", "ECONOMY": "isAfter", "LARGE": "xIntent",
               "MEDIUM": "oWant", "STANDARD": "xAttr"}
GRAPH_SQL = """SELECT position, 'PersonX gives ' || head || ' to PersonY' AS topic,
    CASE relation """ + " ".join(
    f"WHEN '{a}' THEN '{b}'" for a, b in RELATION_OF.items()
) + """ END AS relation, tail || ' for ___' AS which FROM triples"""


def _draw(key: str, count) -> str:
    return f"('0x' || substr(md5(request || '|{key}|0'), 1, 13))::BIGINT % {count}"


def _pick(key: str, name: str | None = None) -> str:
    values = "[" + ", ".join(f"'{v}'" for v in NAMES[key]) + "]"
    return f"{values}[{_draw(name or key, len(NAMES[key]))} + 1]"


DRAWN_SQL = (
    with_views("triples")
    + f""", graph AS ({GRAPH_SQL}),
    numbered AS (SELECT *, row_number() OVER (ORDER BY md5(position || '|0')) - 1 AS e FROM graph),
    size AS (SELECT count(*) AS n FROM graph),
    ids AS (SELECT unnest(range(2 * n)) AS request, n FROM size),
    drawn AS (SELECT request, {_draw("template", len(TEMPLATES))} AS template_id,
        {_draw("entry", "n")} AS e, {_pick("aac_user")} AS u, {_pick("partner")} AS p,
        {_pick("tone")} AS tone, {_pick("time_of_day")} AS tod,
        {_pick("aac_user", "system.aac_user")} AS su FROM ids),
    full_ AS (SELECT * FROM drawn JOIN numbered USING (e))"""
)


@query(
    DRAWN_SQL
    + """ SELECT request, template_id::INTEGER AS template_id, position, topic, u AS aac_user,
    p AS partner, tone, tod AS time_of_day FROM full_"""
)
def cross_sample(spark, d):
    graph = _graph(spark, d)
    drawn = sampling.sample_requests(
        2 * graph.count(), _templates(spark), graph, ["position"], _substitutions(spark)
    )
    return drawn.select(
        "request", "template_id", "position", "topic",
        *[F.col("picks")[k].alias(k) for k in ("aac_user", "partner", "tone", "time_of_day")],
    )


FILLED_SQL = """, texts AS (SELECT *, replace(replace(replace(topic, 'PersonX', u), 'PersonY', p),
        '___', p) AS t, replace(replace(replace(which, 'PersonX', u), 'PersonY', p), '___', p) AS w,
        CASE relation WHEN 'xNeed' THEN 'what ' || u || ' needs for this'
        WHEN 'oReact' THEN 'how ' || p || ' reacts to this'
        WHEN 'xIntent' THEN 'what ' || u || ' intends by this'
        WHEN 'oWant' THEN 'what ' || p || ' wants in this situation'
        WHEN 'xAttr' THEN 'attributes of ' || u || ' in this context' END AS phrase FROM full_),
    said AS (SELECT *, coalesce(phrase || ': ' || w, w) AS context,
        'The conversation is about ''' || t || '''. where ' || w || coalesce('. ' || phrase, '')
        AS situation FROM texts)"""


@query(
    DRAWN_SQL
    + FILLED_SQL
    + """ SELECT 'b_' || request AS custom_id, 'POST' AS method, '/v1/chat/completions' AS url,
    'gpt-4o-mini' AS model, 0.7::DOUBLE AS temperature, 1500 AS max_tokens,
    'You write French dialogues for ' || su || '.' AS system_prompt,
    CASE template_id WHEN 0 THEN 'Talk about ' || t || ' at home.'
    WHEN 1 THEN u || ' and ' || p || ': ' || context || ' (' || tone || ')'
    WHEN 2 THEN 'Scene: ' || situation || '. '
    WHEN 3 THEN 'person with ALS in the ' || tod ELSE 'No holes here' END AS user_prompt,
    template_id::INTEGER AS template_id, 'fr-FR' AS lang_code FROM said"""
)
def request_table(spark, d):
    graph = _graph(spark, d)
    requests = jobs.build_request_table(
        2 * graph.count(), "fr-FR", _templates(spark), graph, ["position"],
        _substitutions(spark), SYSTEM, batch_id="b",
    )
    body = F.col("request.body")
    return requests.select(
        "request.custom_id", "request.method", "request.url",
        body["model"].alias("model"), body["temperature"].alias("temperature"),
        body["max_tokens"].alias("max_tokens"),
        body["messages"][0]["content"].alias("system_prompt"),
        body["messages"][1]["content"].alias("user_prompt"),
        "metadata.template_id", "metadata.lang_code",
    )


LANGUAGES = ["en", "fr-FR", "de-AT", "es-ES"]  # es has neither templates nor names
BY_LANGUAGE = {
    "en": (TEMPLATES[:1] + TEMPLATES[2:], NAMES),
    "fr": (["Parlez de {{ topic }} ({{ tone }})", "{{ aac_user }} et {{ partner }}"],
           {"aac_user": ["Zoe", "Yves"], "partner": ["Xav"], "tone": ["gai"], "extra": []}),
    "de-AT": (["Rede über {{ topic }} am {{ time_of_day }}"], None),
}
MANY_SQL = f"""WITH langs(lang, tl, sl) AS (VALUES ('en', 'en', 'en'), ('fr-FR', 'fr', 'fr'),
        ('de-AT', 'de-AT', 'en'), ('es-ES', 'en', 'en')),
    written(tl, tn, count) AS (VALUES {", ".join(
        f"('{lang}', {i}, {len(texts)})" for lang, (texts, _) in BY_LANGUAGE.items() for i in range(len(texts)))}),
    names(sl, key, vals) AS (VALUES {", ".join(
        f"('{lang}', '{key}', {values})" for lang, (_, names) in BY_LANGUAGE.items() if names
        for key, values in names.items() if values)}),
    counts AS (SELECT tl, max(count) AS count FROM written GROUP BY 1),
    {with_views("triples").removeprefix("WITH ").strip()}, graph AS ({GRAPH_SQL}),
    numbered AS (SELECT *, row_number() OVER (ORDER BY md5(position || '|0')) - 1 AS e FROM graph),
    size AS (SELECT count(*) AS n FROM graph),
    ids AS (SELECT lang, tl, sl, unnest(range(n // 2)) AS request, n FROM langs, size),
    drawn AS (SELECT *, ('0x' || substr(md5(lang || '|' || request || '|template|0'), 1, 13))::BIGINT
        % count AS tn, ('0x' || substr(md5(lang || '|' || request || '|entry|0'), 1, 13))::BIGINT % n AS e
        FROM ids JOIN counts USING (tl)),
    picked AS (SELECT lang, request, draw || key AS name, vals[('0x' || substr(md5(lang || '|' || request
        || '|' || draw || key || '|0'), 1, 13))::BIGINT % len(vals) + 1] AS value
        FROM drawn JOIN names USING (sl), (VALUES (''), ('system.')) AS d(draw)),
    wide AS (SELECT lang, request, max(value) FILTER (name = 'aac_user') AS u,
        max(value) FILTER (name = 'partner') AS p, max(value) FILTER (name = 'tone') AS tone,
        max(value) FILTER (name = 'time_of_day') AS tod,
        max(value) FILTER (name = 'system.aac_user') AS su FROM picked GROUP BY 1, 2),
    full_ AS (SELECT d.*, u, p, tone, tod, su, topic, which, relation FROM drawn d
        JOIN wide USING (lang, request) JOIN numbered USING (e))"""


@query(
    MANY_SQL
    + FILLED_SQL
    + """ SELECT 'b_' || lang || '_' || request AS custom_id, lang AS lang_code, tn::INTEGER AS template_id,
    'You write ' || CASE lang WHEN 'en' THEN 'en' WHEN 'fr-FR' THEN 'French' WHEN 'de-AT' THEN
    'German' ELSE 'Spanish' END || ' dialogues for ' || su || '.' AS system_prompt,
    CASE WHEN tl = 'fr' AND tn = 0 THEN 'Parlez de ' || t || ' (' || tone || ')'
    WHEN tl = 'fr' THEN u || ' et ' || p
    WHEN tl = 'de-AT' THEN 'Rede über ' || t || ' am ' || tod
    WHEN tn = 0 THEN 'Talk about ' || t || ' at home.'
    WHEN tn = 1 THEN 'Scene: ' || situation || '. '
    WHEN tn = 2 THEN 'person with ALS in the ' || tod ELSE 'No holes here' END AS user_prompt
    FROM said"""
)
def request_tables(spark, d):
    """Four languages in one plan; two of them fall back on others' templates or names."""
    graph = _graph(spark, d)
    texts = [(lang, i, x) for lang, (xs, _) in BY_LANGUAGE.items() for i, x in enumerate(xs)]
    names = [(lang, k, v) for lang, (_, kv) in BY_LANGUAGE.items() if kv for k, v in kv.items()]
    requests = jobs.build_request_tables(
        graph.count() // 2,
        spark.createDataFrame([(x,) for x in LANGUAGES], "lang_code string"),
        spark.createDataFrame(texts, "lang_code string, template_id int, template string"),
        graph,
        ["position"],
        spark.createDataFrame(names, "lang_code string, key string, values array<string>"),
        SYSTEM,
        batch_id="b",
    )
    body = F.col("request.body")
    return requests.select(
        "request.custom_id", "metadata.lang_code", "metadata.template_id",
        body["messages"][0]["content"].alias("system_prompt"),
        body["messages"][1]["content"].alias("user_prompt"),
    )


@query(
    with_views("turns")
    + """SELECT conversation_id, turn_number, rtrim(CASE turn_number % 3
    WHEN 0 THEN speaker || ' said: ' || utterance || '!'
    WHEN 1 THEN 'To ' || speaker || ' []' ELSE utterance || ' and ' || utterance END, '') AS rendered
    FROM turns"""
)
def render_template(spark, d):
    choices = F.array(
        F.lit("{{ speaker }} said: {{utterance}}!"),
        F.lit("To {{  speaker }} [{{ nobody }}]"),
        F.lit("{{ utterance }} and {{ utterance }}"),
    )
    values = F.create_map(F.lit("speaker"), "speaker", F.lit("utterance"), "utterance")
    template = F.get(choices, (F.col("turn_number") % 3).cast("int"))
    return turns(spark, d).select(
        "conversation_id", "turn_number", text_fn.render(template, values).alias("rendered")
    )


@query(
    with_views("triples")
    + """SELECT position, CASE WHEN relation = 'SMALL' THEN 'Ann daje ' || head || ' Bo, Bo'
    ELSE 'Ann gives ' || head || ' to Bo, Bo' END AS filled FROM triples"""
)
def fill_placeholders(spark, d):
    slovenian = F.col("relation") == "SMALL"
    rows = triples(spark, d).select(
        "position",
        F.when(slovenian, "sl-SI").otherwise("en-GB").alias("lang"),
        F.when(slovenian, F.concat(F.lit("OsebaX daje "), "head", F.lit(" oseboY, ___")))
        .otherwise(F.concat(F.lit("PersonX gives "), "head", F.lit(" to PersonY, ___")))
        .alias("text"),
    )
    people = text_fn.fill_people("text", F.lit("Ann"), F.lit("Bo"), "lang")
    return rows.select("position", text_fn.fill_blank(people, F.lit("Bo")).alias("filled"))


@query(
    with_views("triples")
    + f""", graph AS ({GRAPH_SQL}), full_ AS (SELECT *, 'Ann' AS u, 'Bo' AS p FROM graph)
    {FILLED_SQL} SELECT position, phrase, coalesce(phrase || ': ' || which, which) AS context,
    'The conversation is about ''' || topic || '''. where ' || which || coalesce('. ' || phrase, '')
    AS situation FROM said"""
)
def relation_context_(spark, d):
    phrase = relation_phrase("relation", F.lit("Ann"), F.lit("Bo"))
    return _graph(spark, d).select(
        "position",
        phrase.alias("phrase"),
        relation_context(phrase, "which").alias("context"),
        situation_text("topic", "which", phrase).alias("situation"),
    )


@query(
    """SELECT 'd_' || doc_id AS custom_id, 'POST' AS method, '/v1/chat/completions' AS url,
    'm1' AS model, 0.7::DOUBLE AS temperature, 1500 AS max_tokens, 'json_object' AS format,
    lang AS system_text, text AS prompt FROM documents"""
)
def build_request(spark, d):
    docs = table(spark, d, "documents")
    id_ = F.concat(F.lit("d_"), F.col("doc_id").cast("string"))
    requests = docs.select(request_struct(id_, "lang", "text", "m1").alias("r")).select("r.*")
    return requests.select(
        "custom_id", "method", "url", "body.model", "body.temperature", "body.max_tokens",
        F.col("body.response_format.type").alias("format"),
        F.col("body.messages")[0]["content"].alias("system_text"),
        prompt_of("body").alias("prompt"),
    )


# Responses


CONTENT_SQL = r""", turn_json AS (SELECT custom_id, language_code, conversation_id, n, place,
        '{"speaker":' || to_json(speaker) || ',"utterance":' || to_json(utterance)
        || CASE WHEN intended IS NULL THEN ''
                ELSE ',"utterance_intended":' || to_json(intended) END
        || ',"is_aac_user":' || is_aac_user::VARCHAR || '}' AS j FROM nested),
    whole AS (SELECT custom_id, language_code, conversation_id, n,
        '"scene":"scene ' || conversation_id || '","conversation":['
        || string_agg(j, ',' ORDER BY place) AS w FROM turn_json
        GROUP BY custom_id, language_code, conversation_id, n),
    content AS (SELECT custom_id, language_code, n, '{"template_id":1,' || CASE
        WHEN n = 2 THEN replace(w, '"scene":', 'scene:') || ']}'
        WHEN n = 3 THEN w || ',]}' WHEN n = 4 THEN w ELSE w || ']}' END AS content FROM whole)"""


@query(
    with_views("nested") + CONTENT_SQL + " SELECT custom_id, content FROM content"
)
def response_content_(spark, d):
    lines = envelopes(spark, d).withColumn("v", F.try_parse_json("value"))
    return lines.select("custom_id", response_content("v").alias("content"))


@query(
    with_views("nested")
    + "SELECT 'openai_batch_direct' AS format, count(DISTINCT custom_id) AS n FROM nested"
)
def response_format_(spark, d):
    lines = envelopes(spark, d).withColumn("v", F.try_parse_json("value"))
    return lines.groupBy(response_format("v").alias("format")).agg(F.count("*").alias("n"))


@query(
    with_views("nested")
    + """SELECT custom_id, place AS turn_number, speaker, utterance, intended AS utterance_intended,
    is_aac_user FROM nested WHERE n NOT IN (2, 3, 4)"""
)
def parse_conversation(spark, d):
    parsed = contents(spark, d).select("custom_id", parse_content("content").alias("c"))
    return t.explode_turns(parsed.select("custom_id", "c.conversation")).withColumn(
        "turn_number", F.col("turn_number").cast("long")
    )


@query(
    with_views("nested")
    + """SELECT custom_id, CASE WHEN n = 4 THEN NULL ELSE n END AS turns FROM nested
    GROUP BY custom_id, n"""
)
def repair_json_(spark, d):
    """Every text through the repair, also the sound ones, which come out whole."""
    fixed = contents(spark, d).select(
        "custom_id", parse_content(repair_json("content")).alias("c")
    )
    n = F.size("c.conversation").cast("long")
    return fixed.select("custom_id", F.when(F.col("c").isNotNull(), n).alias("turns"))


@query("SELECT doc_id, '[' || n_chars || ', \"' || lang || '\"]' AS inner_json FROM documents")
def unfence_json(spark, d):
    docs = table(spark, d, "documents")
    inner = F.concat(
        F.lit("["), F.col("n_chars").cast("string"), F.lit(', "'), "lang", F.lit('"]')
    )
    fenced = (
        F.when(F.col("lang") == "en", F.concat(F.lit("Here:\n```json\n"), inner, F.lit("\n```\nok")))
        .when(F.col("lang") == "fr", F.concat(F.lit("```\n"), inner, F.lit("\n```")))
        .otherwise(inner)
    )
    return docs.select("doc_id", text_fn.unfence_json(fenced).alias("inner_json"))


@query(
    """SELECT doc_id, '[' || n_chars || '] and [' || lang || ']' AS inner_json FROM documents"""
)
def bracket_json(spark, d):
    wrapped = F.concat(
        F.lit("So "), F.lit("["), F.col("n_chars").cast("string"), F.lit("] and ["), "lang",
        F.lit("]\nbye"),
    )
    return table(spark, d, "documents").select(
        "doc_id", text_fn.bracket_json(wrapped).alias("inner_json")
    )


STATUS_SQL = """CASE WHEN n = 4 THEN 'error' WHEN n IN (2, 3) THEN 'recovered' ELSE 'ok' END"""


@query(
    with_views("ids") + f"SELECT {STATUS_SQL} AS status, count(*) AS rows FROM ids GROUP BY 1"
)
def outcome_counts(spark, d):
    return stats.outcome_counts(jobs.read_responses(envelopes(spark, d)))


@query(
    with_views("matched", "latest", "latest_lang")
    + f"""SELECT m.custom_id, m.matched_id, {STATUS_SQL} AS status, 1 AS template_id,
    'scene ' || m.conversation_id AS scene, n AS turns, l.lang_code, l2.model,
    'openai' AS provider, k.intended FROM matched m
    JOIN latest l2 ON l2.custom_id = m.matched_id
    JOIN latest_lang l ON l.custom_id = m.matched_id
    JOIN (SELECT custom_id, count(CASE WHEN is_aac_user THEN coalesce(intended, utterance) END)
          AS intended FROM nested GROUP BY 1) k ON k.custom_id = m.custom_id
    WHERE n <> 4"""
)
def process_responses(spark, d):
    stored, _ = jobs.process_responses(envelopes(spark, d), metadata(spark, d))
    known = F.filter("conversation", lambda x: x["utterance_intended"].isNotNull())
    return stored.select(
        "custom_id", "matched_id", "status", "template_id", "scene",
        F.size("conversation").cast("long").alias("turns"),
        "metadata.lang_code", "metadata.model", "metadata.provider",
        F.size(known).cast("long").alias("intended"),
    )


@query(
    with_views("nested", "matched")
    + CONTENT_SQL
    + """ SELECT custom_id, 'invalid JSON' AS error, content FROM content WHERE n = 4
    UNION ALL SELECT custom_id, 'no metadata', content FROM content
    WHERE n <> 4 AND custom_id NOT IN (SELECT custom_id FROM matched)"""
)
def rejected_responses(spark, d):
    _, rejects = jobs.process_responses(envelopes(spark, d), metadata(spark, d))
    return rejects.select("custom_id", "error", "content")
