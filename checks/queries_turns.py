"""Turns, filters, text, statistics, noise and task views."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.views import conversations, custom_id, table, triples, turns, with_views
from turnloom.functions.keyboard import key_grid, neighbours
from turnloom.functions.noise import draw_numbers, edit_count, edit_positions, let, noisy
from turnloom.functions.text import (
    fully_corrected,
    is_aac_speaker,
    language_name,
    locale_base,
    minimally_corrected,
    over_token_limit,
    token_estimate,
    word_count,
)
from turnloom.operators import filters, stats, tasks
from turnloom.operators import turns as t
from turnloom.operators.scale import spread
from turnloom.plans.jobs import augment_conversations, augment_turns, stats_report
from turnloom.schemas import ERROR_RATES, FLAT_COLUMNS, LAYOUTS

KEY = ["conversation_id", "turn_number"]
SMALL_RELATIONS = ("SMALL", "PROMO", "ECONOMY")
SMALL_KEYWORDS = ("ring", "bol", "hot")


@query(
    with_views("triples")
    + """SELECT head AS topic, relation, 'Alex' AS aac_user, 'Taylor' AS partner,
    'person with ALS' AS aac_user_role, tail AS which, position FROM triples
    WHERE relation IN ('SMALL', 'PROMO', 'ECONOMY')
      AND (contains(lower(head), 'ring') OR contains(lower(head), 'bol')
           OR contains(lower(head), 'hot'))
      AND lower(tail) <> 'none' ORDER BY position LIMIT 200"""
)
def kg_subset(spark, d):
    kept = filters.filter_relations(triples(spark, d), SMALL_RELATIONS)
    kept = filters.drop_none_tail(filters.filter_keywords(kept, "head", SMALL_KEYWORDS))
    return filters.limit_entries(filters.to_entries(kept, keep=["position"]), 200, ["position"])


@query(
    with_views("turns")
    + "SELECT conversation_id, turn_number, speaker, utterance FROM turns WHERE is_aac_user"
)
def aac_turns(spark, d):
    return filters.aac_turns(turns(spark, d)).select(*KEY, "speaker", "utterance")


@query(
    with_views("turns")
    + """SELECT conversation_id, turn_number, language_code, utterance FROM turns
    WHERE starts_with(language_code, 'en')"""
)
def lang_filter(spark, d):
    return filters.by_language(turns(spark, d, language=True), prefix="en").select(
        *KEY, "language_code", "utterance"
    )


NESTED = "conversation_id, place AS turn_number, speaker, utterance, "


@query(
    with_views("nested")
    + f"""SELECT {NESTED} CASE WHEN is_aac_user THEN coalesce(intended, utterance)
    ELSE intended END AS utterance_intended FROM nested"""
)
def fill_intended(spark, d):
    filled = filters.fill_intended(conversations(spark, d))
    return _nested_turns(filled)


@query(
    with_views("nested")
    + f"SELECT {NESTED} CASE WHEN is_aac_user THEN intended END AS utterance_intended FROM nested"
)
def strip_partner_intended(spark, d):
    return _nested_turns(filters.strip_partner_intended(conversations(spark, d)))


def _nested_turns(nested):
    return t.explode_turns(nested).select(
        "conversation_id", F.col("turn_number").cast("long").alias("turn_number"),
        "speaker", "utterance", "utterance_intended",
    )


@query(
    with_views("turns")
    + """SELECT conversation_id, turn_number, CASE WHEN is_aac_user
    THEN speaker || ' (AAC User):' || chr(10) || '  Intended: ' || utterance_intended || chr(10)
         || '  Actual: ' || utterance
    ELSE speaker || ':' || chr(10) || '  ' || utterance END AS rendered FROM turns"""
)
def render_turns(spark, d):
    return t.render_turns(turns(spark, d))


@query(
    with_views("nested")
    + """SELECT conversation_id, string_agg(CASE WHEN is_aac_user
         AND coalesce(intended, '') <> utterance
    THEN speaker || ' (AAC User):' || chr(10) || '  Intended: ' || coalesce(intended, '')
         || chr(10) || '  Actual: ' || utterance
    ELSE speaker || ':' || chr(10) || '  ' || utterance END, chr(10) || chr(10) ORDER BY place)
    AS rendered FROM nested GROUP BY 1"""
)
def render_conversations(spark, d):
    nested = conversations(spark, d).withColumn("scene", F.lit(""))
    return t.render_conversations(nested, only_if_different=True).select(
        "conversation_id", "rendered"
    )


CONTEXT_SQL = """coalesce(string_agg({c}, '|') OVER w3, '') AS {name}"""
WINDOWS = """WINDOW w AS (PARTITION BY conversation_id ORDER BY turn_number),
    w3 AS (PARTITION BY conversation_id ORDER BY turn_number
           ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)"""


@query(
    with_views("turns")
    + f"""SELECT conversation_id, turn_number,
    {CONTEXT_SQL.format(c="speaker", name="context_speakers")},
    {CONTEXT_SQL.format(c="utterance", name="context_utterances")} FROM turns {WINDOWS}"""
)
def turn_context(spark, d):
    return t.with_context(turns(spark, d)).select(
        *KEY,
        F.array_join("context_speakers", "|").alias("context_speakers"),
        F.array_join("context_utterances", "|").alias("context_utterances"),
    )


@query(
    with_views("turns")
    + f"""SELECT conversation_id, turn_number,
    lead(speaker, 1, '') OVER w AS next_turn_speaker,
    lead(utterance, 1, '') OVER w AS next_turn_utterance FROM turns {WINDOWS}"""
)
def next_turn(spark, d):
    return t.with_next(turns(spark, d)).select(*KEY, "next_turn_speaker", "next_turn_utterance")


FLAT_SQL = f"""SELECT conversation_id::VARCHAR AS conversation_id, turn_number, language_code,
    -1::BIGINT AS template_id, '' AS scene,
    {CONTEXT_SQL.format(c="speaker", name="context_speakers")},
    {CONTEXT_SQL.format(c="utterance", name="context_utterances")},
    speaker, utterance, utterance_intended,
    lead(speaker, 1, '') OVER w AS next_turn_speaker,
    lead(utterance, 1, '') OVER w AS next_turn_utterance,
    'unknown' AS model, 'unknown' AS provider, is_aac_user FROM turns {WINDOWS}"""


def _joined_context(flat):
    return flat.withColumn("context_speakers", F.array_join("context_speakers", "|")).withColumn(
        "context_utterances", F.array_join("context_utterances", "|")
    )


@query(with_views("turns") + f"SELECT * EXCLUDE (is_aac_user) FROM ({FLAT_SQL}) WHERE is_aac_user")
def flatten_turns(spark, d):
    flat = t.flatten_turns(turns(spark, d, language=True))
    return _joined_context(flat).select(*FLAT_COLUMNS[:14])


@query(
    with_views("nested")
    + """SELECT * EXCLUDE (is_aac_user) FROM (
    SELECT custom_id AS conversation_id, place AS turn_number, language_code,
    -1::BIGINT AS template_id, '' AS scene,
    coalesce(string_agg(speaker, '|') OVER w3, '') AS context_speakers,
    coalesce(string_agg(utterance, '|') OVER w3, '') AS context_utterances,
    speaker, utterance, coalesce(intended, utterance) AS utterance_intended,
    lead(speaker, 1, '') OVER w AS next_turn_speaker,
    lead(utterance, 1, '') OVER w AS next_turn_utterance,
    'unknown' AS model, 'unknown' AS provider, is_aac_user FROM nested
    WINDOW w AS (PARTITION BY custom_id ORDER BY place),
    w3 AS (PARTITION BY custom_id ORDER BY place ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))
    WHERE is_aac_user"""
)
def flatten_examples(spark, d):
    nested = conversations(spark, d).withColumn(
        "conversation_id", custom_id(F.col("conversation_id"))
    )
    return _joined_context(t.flatten_examples(nested)).select(*FLAT_COLUMNS[:14])


@query(
    with_views("turns")
    + """SELECT conv_id, language_code || '_' || row_number() OVER (
    PARTITION BY language_code ORDER BY conv_id) AS conversation_id
    FROM (SELECT DISTINCT conversation_id AS conv_id, language_code FROM turns)"""
)
def conversation_id(spark, d):
    ids = turns(spark, d, language=True).select(
        F.col("conversation_id").alias("conv_id"), "language_code"
    )
    return t.assign_conversation_id(ids.distinct(), ["conv_id"]).select(
        "conv_id", "conversation_id"
    )


@query(
    with_views("turns")
    + f"""SELECT conversation_id, turn_number, speaker || ': ' || utterance AS line,
    CASE WHEN ns <> '' AND nu <> '' THEN ns || ': ' || nu END AS next_line FROM (
    SELECT *, lead(speaker, 1, '') OVER w AS ns, lead(utterance, 1, '') OVER w AS nu
    FROM turns {WINDOWS})"""
)
def rebuild_conversation(spark, d):
    return t.rebuild(t.with_next(turns(spark, d)))


# Text


@query(
    with_views("turns")
    + r"""SELECT conversation_id, turn_number, len(list_filter(
    string_split_regex(utterance, '\s+'), lambda x: x <> ''))::INTEGER AS words FROM turns"""
)
def word_count_(spark, d):
    return turns(spark, d).select(*KEY, word_count("utterance").alias("words"))


CORRECTED = r"""CASE WHEN regexp_matches({c}, '^\p{{L}}')
    THEN upper(left({c}, 1)) || substr({c}, 2) ELSE {c} END ||
    CASE WHEN {c} = '' OR right({c}, 1) IN ('.', '!', '?') THEN '' ELSE '.' END"""
MINIMAL, FULL = CORRECTED.format(c="utterance"), CORRECTED.format(c="utterance_intended")


@query(
    with_views("turns")
    + f"""SELECT conversation_id, turn_number, {MINIMAL} AS minimally_corrected,
    {FULL} AS fully_corrected FROM turns"""
)
def corrections(spark, d):
    return turns(spark, d).select(
        *KEY,
        minimally_corrected("utterance").alias("minimally_corrected"),
        fully_corrected("utterance_intended").alias("fully_corrected"),
    )


@query(
    """SELECT lang, source, lang || '-' || upper(source) AS locale, lang AS base, count(*) AS n
    FROM documents GROUP BY lang, source"""
)
def locale_base_(spark, d):
    locales = table(spark, d, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"))
    locales = locales.withColumn("locale", F.concat_ws("-", "lang", F.upper("source")))
    return locales.withColumn("base", locale_base("locale"))


@query(
    with_views("turns")
    + """SELECT speaker || CASE WHEN is_aac_user THEN ' (AAC)' ELSE ' (aac)' END AS name,
    is_aac_user AS is_aac, count(*) AS n FROM turns GROUP BY ALL"""
)
def is_aac_speaker_(spark, d):
    mark = F.when(F.col("is_aac_user"), " (AAC)").otherwise(" (aac)")
    names = turns(spark, d).select(F.concat("speaker", mark).alias("name"))
    return names.groupBy("name", is_aac_speaker("name").alias("is_aac")).agg(
        F.count("*").alias("n")
    )


@query(
    """SELECT doc_id, (length(text) + 500) // 4 AS tokens,
    (length(text) + 500) // 4 > 1000 * 0.8 AS over_80 FROM documents"""
)
def token_estimate_(spark, d):
    docs = table(spark, d, "documents").select(
        "doc_id", token_estimate("text", overhead=500).alias("tokens")
    )
    return docs.withColumn("over_80", over_token_limit("tokens", 1000))


@query(
    """SELECT lang, sum(length(text) // 4)::BIGINT AS tokens, count(*) AS rows,
    sum(length(text) // 4) > 1000000 * 0.8 AS over_80,
    sum(length(text) // 4) > 1000000 * 0.9 AS over_90 FROM documents GROUP BY 1"""
)
def token_totals(spark, d):
    return stats.token_totals(table(spark, d, "documents"), "text", 1_000_000, by=["lang"])


@query(
    """SELECT lang || '-' || upper(source) AS lang_code, count(*) AS n FROM documents
    WHERE lang <> 'en' AND lang || '-' || upper(source) <> 'fr-SRC1' GROUP BY 1"""
)
def eligible_locales(spark, d):
    code = F.concat_ws("-", "lang", F.upper("source")).alias("lang_code")
    locales = table(spark, d, "documents").groupBy(code).agg(F.count("*").alias("n"))
    return filters.eligible_locales(locales, unsupported=["fr-SRC1"])


@query(
    """SELECT doc_id, CASE lang WHEN 'fr' THEN 'French' WHEN 'de' THEN 'German'
    WHEN 'es' THEN 'Spanish' ELSE 'en' END AS name FROM documents"""
)
def language_name_(spark, d):
    region = F.when(F.col("lang") != "en", F.concat(F.lit("-"), F.upper("lang"))).otherwise("")
    return table(spark, d, "documents").select(
        "doc_id", language_name(F.concat("lang", region)).alias("name")
    )


@query(
    """SELECT doc_id, source AS provider, lang AS model FROM documents
    WHERE source = 'src3' AND lang = 'fr'"""
)
def by_generator(spark, d):
    rows = table(spark, d, "documents").select(
        "doc_id", F.col("source").alias("provider"), F.col("lang").alias("model")
    )
    return filters.by_generator(rows, "src3", "fr")


# Statistics

STATS_SQL = r"""SELECT language_code, count(DISTINCT conversation_id) AS num_conversations,
    count(*) AS total_turns, count(*) FILTER (is_aac_user) AS aac_utterances,
    count(*) FILTER (NOT is_aac_user) AS non_aac_utterances,
    coalesce(sum(w) FILTER (is_aac_user), 0)::BIGINT AS aac_word_count,
    coalesce(sum(w) FILTER (NOT is_aac_user), 0)::BIGINT AS non_aac_word_count
    FROM (SELECT *, len(list_filter(string_split_regex(utterance, '\s+'), lambda x: x <> ''))
          AS w FROM turns) GROUP BY language_code"""
RATIOS_SQL = """total_turns / num_conversations AS avg_conversation_length,
    CASE WHEN aac_utterances > 0 THEN aac_word_count / aac_utterances ELSE 0 END AS aac_mlu,
    CASE WHEN non_aac_utterances > 0 THEN non_aac_word_count / non_aac_utterances ELSE 0 END
    AS non_aac_mlu"""


@query(
    with_views("turns")
    + f"""SELECT * REPLACE (round(avg_conversation_length, 6) AS avg_conversation_length,
    round(aac_mlu, 6) AS aac_mlu, round(non_aac_mlu, 6) AS non_aac_mlu) FROM (
    SELECT *, {RATIOS_SQL} FROM ({STATS_SQL}))"""
)
def corpus_stats(spark, d):
    out = stats.corpus_stats(turns(spark, d, language=True))
    for c in ("avg_conversation_length", "aac_mlu", "non_aac_mlu"):
        out = out.withColumn(c, F.round(c, 6))
    return out


@query(
    with_views("turns")
    + f""", per AS ({STATS_SQL}), both_ AS (SELECT * FROM per UNION ALL
    SELECT 'TOTAL', sum(num_conversations)::BIGINT, sum(total_turns)::BIGINT,
    sum(aac_utterances)::BIGINT, sum(non_aac_utterances)::BIGINT,
    sum(aac_word_count)::BIGINT, sum(non_aac_word_count)::BIGINT FROM per)
    SELECT language_code AS "Language", num_conversations AS "Conversations",
    total_turns AS "Total Turns", aac_utterances AS "AAC Utterances",
    non_aac_utterances AS "Non-AAC Utterances", aac_word_count AS "AAC Words",
    non_aac_word_count AS "Non-AAC Words", round(avg_conversation_length, 2) AS "Avg Turns/Conv",
    round(aac_mlu, 2) AS "AAC MLU", round(non_aac_mlu, 2) AS "Non-AAC MLU"
    FROM (SELECT *, {RATIOS_SQL} FROM both_)"""
)
def corpus_stats_total(spark, d):
    return stats_report(turns(spark, d, language=True))


@query(
    """SELECT turns, count(*) AS conversations FROM (
    SELECT conv_id, count(*) AS turns FROM conversations GROUP BY 1) GROUP BY 1"""
)
def length_histogram(spark, d):
    return stats.length_distribution(turns(spark, d))


@query(
    """SELECT ch AS char, count(*) AS n FROM (
    SELECT unnest(string_split(text, '')) AS ch FROM documents) WHERE ch <> '' GROUP BY 1"""
)
def char_frequency(spark, d):
    return stats.char_frequency(spread(table(spark, d, "documents")), "text")


@query(
    """SELECT event_type, count(*) AS rows FROM events GROUP BY 1"""
)
def ledger_status_counts(spark, d):
    return stats.outcome_counts(table(spark, d, "events"), "event_type")


@query(
    """SELECT count(*) FILTER (ok) AS succeeded, count(*) FILTER (NOT ok) AS failed,
    (count(*) FILTER (ok) * 10)::BIGINT AS total_requests, round(sum(s), 2) AS seconds
    FROM (SELECT user_id, bool_and(event_type <> 'error') AS ok, sum(value) AS s
          FROM events GROUP BY 1)"""
)
def run_summary(spark, d):
    runs = table(spark, d, "events").groupBy("user_id").agg(
        F.bool_and(F.col("event_type") != "error").alias("success"), F.sum("value").alias("seconds")
    )
    return stats.run_summary(runs, 10)


# Noise


def _values(rows) -> str:
    def cell(x):
        if isinstance(x, list):
            return "[" + ", ".join(cell(y) for y in x) + "]"
        return repr(x) if not isinstance(x, str) else "'" + x.replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(cell(x) for x in row) + ")" for row in rows)


# The key grids written out, row by row; neighbours are found by the SQL itself.
CELLS = """rows_(layout, r, keys) AS (VALUES
        ('qwerty', 0, 'QWERTYUIOP'), ('qwerty', 1, 'ASDFGHJKLZ'), ('qwerty', 2, 'XCVBNM_'),
        ('abc', 0, 'ABCDEFGHIJ'), ('abc', 1, 'KLMNOPQRST'), ('abc', 2, 'UVWXYZ_'),
        ('frequency', 0, '_ETAOINSRH'), ('frequency', 1, 'DLUCMFYWGP'), ('frequency', 2, 'BVKXQJZ')),
    cells AS (SELECT layout, r, c, substr(keys, c, 1) AS key
        FROM (SELECT *, unnest(range(1, length(keys) + 1))::INTEGER AS c FROM rows_)),
    nb AS (SELECT a.layout, a.key, list(b.key ORDER BY b.r, b.c) AS keys FROM cells a JOIN cells b
        ON a.layout = b.layout AND abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1
        AND (a.r <> b.r OR a.c <> b.c) GROUP BY 1, 2),
    grids AS (SELECT layout, list(key ORDER BY r, c) AS all_keys FROM cells GROUP BY 1)"""


@query(
    with_views("turns")
    + f""", {CELLS},
    chars AS (SELECT ch, count(*) AS n FROM (SELECT unnest(string_split(utterance, '')) AS ch
              FROM turns) GROUP BY 1)
    SELECT ch, n, l.layout, coalesce(array_to_string(nb.keys, ' '), '') AS neighbours
    FROM chars CROSS JOIN (SELECT DISTINCT layout FROM nb) l LEFT JOIN nb
      ON nb.layout = l.layout AND nb.key = CASE WHEN ch = ' ' THEN '_' ELSE upper(ch) END"""
)
def neighbours_(spark, d):
    chars = stats.char_frequency(turns(spark, d), "utterance").withColumnRenamed("char", "ch")
    found = [
        F.struct(
            F.lit(layout).alias("layout"),
            F.array_join(neighbours("ch", key_grid(layout)), " ").alias("neighbours"),
        )
        for layout in LAYOUTS
    ]
    return chars.select("ch", "n", F.inline(F.array(*found)))


def noise_sql(layouts, severities, text="utterance") -> str:
    """The noise, character by character, as further views that end in ``noisy``."""
    variants = _values(
        (f"noisy_{l}_{s}", l, ERROR_RATES[s]) for l in layouts for s in severities
    )
    number = "('0x' || substr(h, {}, 7))::BIGINT"
    mix = "((({0} + {3}) * ({1} + {3}) % 2147483647) * ({2} + {3}) % 2147483647)"
    return f""", {CELLS},
    variants(tag, layout, rate) AS (VALUES {variants}),
    seeds AS (SELECT t.*, v.*, length(t.{text}) AS n, md5(t.conversation_id || '|' ||
        t.turn_number || '|' || v.tag || '|0') AS h FROM turns t CROSS JOIN variants v
        WHERE t.is_aac_user),
    numbered AS (SELECT *, {number.format(1)} AS a, {number.format(8)} AS b,
        {number.format(15)} AS c, {number.format(22)} AS d,
        CASE WHEN n <= 2 THEN 1 ELSE least(greatest(1, round_even(rate::DOUBLE * n, 0)::BIGINT),
            floor(n * 0.75)::BIGINT) END AS k FROM seeds),
    places AS (SELECT *, substr({text}, (i + 1)::INTEGER, 1) AS ch,
        {mix.format("a", "b", "c", "i")} AS r, {mix.format("b", "c", "d", "i")} AS e
        FROM (SELECT *, unnest(range(n)) AS i FROM numbered)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY conversation_id, turn_number, tag
        ORDER BY r, i) <= k AS picked FROM places),
    edited AS (SELECT r.*, CASE WHEN NOT picked THEN ch
        WHEN e % 3 = 0 THEN coalesce(lower(nb.keys[(e // 3) % len(nb.keys) + 1]), ch)
        WHEN e % 3 = 1 THEN CASE WHEN n > 1 THEN '' ELSE ch END
        ELSE lower(all_keys[(e // 3) % len(all_keys) + 1]) || ch END AS out
        FROM ranked r JOIN grids USING (layout) LEFT JOIN nb ON nb.layout = r.layout
          AND nb.key = CASE WHEN ch = ' ' THEN '_' ELSE upper(ch) END),
    rough AS (SELECT conversation_id, turn_number, tag, layout, {text} AS text, n, a, c, d,
        string_agg(out, '' ORDER BY i) AS out FROM edited GROUP BY ALL),
    again AS (SELECT *, {mix.format("c", "d", "a", "n")} AS f FROM rough),
    spot AS (SELECT *, f // 3 AS u, ((f // 3 // 64) % n)::INTEGER AS p FROM again),
    noisy AS (SELECT conversation_id, turn_number, tag, text, CASE WHEN out <> text THEN out
        WHEN f % 3 = 0 AND nb.key IS NOT NULL
            THEN left(text, p) || nb.keys[u % len(nb.keys) + 1] || substr(text, p + 2)
        WHEN f % 3 = 2 OR n = 1
            THEN left(text, p) || all_keys[u % len(all_keys) + 1] || substr(text, p + 1)
        ELSE left(text, p) || substr(text, p + 2) END AS noisy
        FROM spot JOIN grids USING (layout) LEFT JOIN nb ON nb.layout = spot.layout
          AND nb.key = CASE WHEN substr(text, p + 1, 1) = ' ' THEN '_'
                            ELSE upper(substr(text, p + 1, 1)) END)"""


@query(
    with_views("turns")
    + noise_sql(["qwerty"], ["moderate"])
    + """ SELECT conversation_id, turn_number,
    string_agg(i::VARCHAR, ',' ORDER BY i) AS positions FROM ranked WHERE picked GROUP BY 1, 2"""
)
def noise_positions(spark, d):
    n = F.length("utterance")
    picks = let(
        draw_numbers(KEY, "noisy_qwerty_moderate", 0),
        lambda s: edit_positions(n, edit_count(n, ERROR_RATES["moderate"]), s["a"], s["b"], s["c"]),
    )
    rows = filters.aac_turns(spread(turns(spark, d)))
    return rows.select(*KEY, F.array_join(picks.cast("array<string>"), ",").alias("positions"))


@query(
    with_views("turns")
    + noise_sql(["qwerty"], ["moderate"])
    + " SELECT conversation_id, turn_number, noisy FROM noisy"
)
def noisy_text(spark, d):
    rows = filters.aac_turns(spread(turns(spark, d)))
    tag = "noisy_qwerty_moderate"
    edited = noisy("utterance", key_grid("qwerty"), ERROR_RATES["moderate"], KEY, tag)
    return rows.select(*KEY, edited.alias("noisy"))


def _pivot(layouts, severities) -> str:
    return ", ".join(
        f"max(noisy) FILTER (tag = 'noisy_{l}_{s}') AS noisy_{l}_{s}"
        for l in layouts
        for s in severities
    )


@query(
    with_views("turns")
    + noise_sql(LAYOUTS, ERROR_RATES)
    + f""", wide AS (SELECT conversation_id, turn_number, {_pivot(LAYOUTS, ERROR_RATES)}
    FROM noisy GROUP BY 1, 2)
    SELECT t.conversation_id, t.turn_number, is_aac_user, wide.* EXCLUDE (conversation_id, turn_number),
    CASE WHEN is_aac_user THEN {MINIMAL} END AS minimally_corrected,
    CASE WHEN is_aac_user THEN {FULL} END AS fully_corrected
    FROM turns t LEFT JOIN wide USING (conversation_id, turn_number)"""
)
def augment_turns_(spark, d):
    rows = augment_turns(spread(turns(spark, d)))
    return rows.drop("speaker", "utterance", "utterance_intended")


@query(
    with_views("turns")
    + noise_sql(LAYOUTS, ERROR_RATES)
    + f""", wide AS (SELECT conversation_id, turn_number, {_pivot(LAYOUTS, ERROR_RATES)}
    FROM noisy GROUP BY 1, 2)
    SELECT t.conversation_id, t.turn_number, is_aac_user, wide.* EXCLUDE (conversation_id, turn_number),
    CASE WHEN is_aac_user THEN {MINIMAL} END AS minimally_corrected,
    CASE WHEN is_aac_user THEN {FULL} END AS fully_corrected
    FROM turns t LEFT JOIN wide USING (conversation_id, turn_number)"""
)
def augment_conversations_(spark, d):
    """Whole conversations: the noise is drawn by a turn's place in the array, its number here."""
    turn = F.struct("turn_number", "speaker", "utterance", "utterance_intended", "is_aac_user")
    nested = (
        turns(spark, d, language=True)
        .groupBy("conversation_id", "language_code")
        .agg(F.sort_array(F.collect_list(turn)).alias("conversation"))
    )
    rows = t.explode_turns(
        augment_conversations(nested).withColumn(
            "conversation", F.transform("conversation", lambda x: x.dropFields("turn_number"))
        )
    )
    return rows.withColumn("turn_number", F.col("turn_number").cast("long")).drop(
        "language_code", "speaker", "utterance", "utterance_intended"
    )


@query(
    with_views("turns")
    + """SELECT count(DISTINCT conversation_id) AS conversations,
    count(*) FILTER (is_aac_user) AS augmented_turns FROM turns"""
)
def augmentation_counts(spark, d):
    return stats.augmentation_counts(augment_turns(spread(turns(spark, d))))


@query(
    with_views("turns")
    + noise_sql(LAYOUTS, ERROR_RATES)
    + """ SELECT split_part(tag, '_', 2) AS layout, split_part(tag, '_', 3) AS severity,
    count(*) AS texts, avg((noisy <> text)::INTEGER) AS differs_rate FROM noisy GROUP BY 1, 2"""
)
def noise_report(spark, d):
    rows = filters.aac_turns(augment_turns(spread(turns(spark, d))))
    return stats.noise_report(rows, distance=False)


# The other engine's edit distance counts bytes: characters beyond ASCII become single bytes first.
CODES = "".join(chr(i) for i in range(1, 32) if i not in (9, 10, 13))


@query(
    with_views("turns")
    + noise_sql(LAYOUTS, ERROR_RATES)
    + f""", odd AS (SELECT coalesce(string_agg(DISTINCT ch, ''), '') AS chars FROM (
        SELECT unnest(string_split(utterance, '')) AS ch FROM turns) WHERE unicode(ch) > 127),
    told AS (SELECT tag, text, noisy, length(text) AS n, levenshtein(
        translate(text, chars, '{CODES}'), translate(noisy, chars, '{CODES}')) AS edits FROM noisy, odd)
    SELECT split_part(tag, '_', 2) AS layout, split_part(tag, '_', 3) AS severity, count(*) AS texts,
    avg((noisy <> text)::INTEGER) AS differs_rate, avg(edits) AS mean_distance,
    avg(CASE WHEN n > 0 THEN edits / n * 100 END) AS mean_changed FROM told GROUP BY 1, 2"""
)
def noise_distances(spark, d):
    rows = filters.aac_turns(augment_turns(spread(turns(spark, d))))
    return stats.noise_report(rows)


@query(
    with_views("turns")
    + noise_sql(LAYOUTS, ERROR_RATES)
    + f""" SELECT n.conversation_id, n.turn_number, split_part(tag, '_', 2) AS layout,
    split_part(tag, '_', 3) AS severity, noisy, {FULL} AS target
    FROM noisy n JOIN turns USING (conversation_id, turn_number)"""
)
def correction_pairs(spark, d):
    return tasks.correction_pairs(augment_turns(spread(turns(spark, d))))


@query(
    with_views("turns")
    + """SELECT conversation_id, turn_number, utterance AS telegraphic,
    utterance_intended AS expanded FROM turns WHERE is_aac_user"""
)
def expansion_pairs(spark, d):
    return tasks.expansion_pairs(filters.aac_turns(turns(spark, d)))


@query(
    with_views("turns")
    + f"""SELECT conversation_id::VARCHAR AS conversation_id, turn_number, context, utterance,
    ns || ': ' || nu AS response FROM (
    SELECT *, lead(speaker, 1, '') OVER w AS ns, lead(utterance, 1, '') OVER w AS nu,
    coalesce(string_agg(speaker || ': ' || utterance, chr(10)) OVER w3, '') AS context
    FROM turns {WINDOWS}) WHERE is_aac_user AND nu <> ''"""
)
def response_pairs(spark, d):
    return tasks.response_pairs(t.flatten_turns(turns(spark, d, language=True)))
