"""DuckDB SQL per query, written from the definition of the operator, not from its Spark plan."""

from newsloom.functions.stopwords import SUMMARY_STOP_WORDS, TITLE_STOP_WORDS
from newsloom.operators.sentiment import BOOSTERS, DAMPENERS, NEGATIONS

SPACE = r"[ \t\n\v\f\r]+"


def quoted(words) -> str:
    return ", ".join("'" + word.replace("'", "''") + "'" for word in words)


def clean_summary(text: str) -> str:
    return rf"regexp_replace(lower({text}), '[^a-zA-Z \t\n\v\f\r]', '', 'g')"


def clean_title(text: str) -> str:
    return f"lower(regexp_replace({text}, '[^a-zA-Z0-9 ]', '', 'g'))"


def tokens(text: str) -> str:
    return f"list_filter(string_split_regex(coalesce({text}, ''), '{SPACE}'), lambda t: t <> '')"


def without(words: str, stop_words) -> str:
    return f"list_filter({words}, lambda t: t NOT IN ({quoted(stop_words)}))"


def spoken(text: str) -> str:
    bare = "regexp_replace(t, '^[[:punct:]]+|[[:punct:]]+$', '', 'g')"
    return f"list_filter(list_transform({tokens(text)}, lambda t: {bare}), lambda t: t <> '')"


def spoken_tokens(text: str) -> str:
    bare = "regexp_replace(t, '^[[:punct:]]+|[[:punct:]]+$', '', 'g')"
    return f"list_transform({tokens(text)}, lambda t: CASE WHEN length({bare}) > 2 THEN {bare} ELSE t END)"


def numbered_words(words: str, key: str, table: str) -> str:
    """key, word and its place, one row per word."""
    return f"""
    SELECT {key}, unnest(ws) AS word, unnest(range(len(ws))) AS place
    FROM (SELECT {key}, {words} AS ws FROM {table})"""


ARTICLES = """
articles AS (
    SELECT 'articles' AS source, CAST(doc_id AS VARCHAR) AS id, lang AS title, text AS summary,
           source AS news_site, 'https://' || lang || '.example.org/' || source AS url
    FROM documents)"""
SUMMARY_WORDS = without(tokens(clean_summary("text")), SUMMARY_STOP_WORDS)
DOCUMENT_TERMS = f"""
occurrences AS (SELECT doc_id, unnest({SUMMARY_WORDS}) AS term FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM occurrences GROUP BY ALL),
frequencies AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total FROM counts GROUP BY term),
weighted AS (
    SELECT doc_id, term, tf, df,
           round(tf * ln(CAST((SELECT count(*) FROM documents) + 1 AS DOUBLE) / (df + 1)), 6) AS tfidf
    FROM counts JOIN frequencies USING (term))"""

LEXICON = f"""
lexicon AS (
    SELECT DISTINCT word AS token, CAST(length(word) % 9 - 4 AS DOUBLE) AS valence
    FROM (SELECT unnest({tokens(clean_summary("text"))}) AS word FROM benchmark))"""
def stepped(step: int, fade: float) -> str:
    """The valence after the word ``step`` places before has had its say."""
    never = {1: "false", 2: "l1 IN ('so', 'this')", 3: "(l1 IN ('so', 'this') OR l2 IN ('so', 'this'))"}[step]
    doubt = {1: "false", 2: "l1 = 'doubt'", 3: "(l1 = 'doubt' OR l2 = 'doubt')"}[step]
    old, word, up = f"v{step - 1}", f"l{step}", f"u{step}"
    degree = f"CASE WHEN {word} IN ({quoted(BOOSTERS)}) THEN 0.293 WHEN {word} IN ({quoted(DAMPENERS)}) THEN -0.293 END"
    added = f"""({degree} * CASE WHEN {old} < 0 THEN -1 ELSE 1 END
        + CASE WHEN mixed AND {up} THEN CASE WHEN {old} > 0 THEN 0.733 ELSE -0.733 END ELSE 0 END) * {fade}"""
    scale = f"""CASE WHEN {word} = 'never' AND {never} THEN 1.25 WHEN {word} = 'without' AND {doubt} THEN 1
        WHEN {word} IN ({quoted(NEGATIONS)}) OR contains({word}, 'n''t') THEN -0.74 ELSE 1 END"""
    return f"""CASE WHEN {word} IS NULL OR k{step} THEN {old} ELSE ({old} + coalesce({added}, 0)::DOUBLE) * {scale} END AS v{step}"""


SENTIMENT = f"""
said AS ({numbered_words(spoken_tokens("summary"), "id", "articles")}),
heard AS (
    SELECT id, place, lower(word) AS l0, upper(word) = word AND lower(word) <> word AS u0, valence,
           valence IS NOT NULL AS k0
    FROM said LEFT JOIN lexicon ON lower(word) = token),
lagged AS (
    SELECT *, {", ".join(f"lag({c}0, {n}) OVER w AS {c}{n}" for c in "luk" for n in (1, 2, 3))},
           count(*) FILTER (u0) OVER d > 0 AND count(*) FILTER (u0) OVER d < count(*) OVER d AS mixed,
           min(place) FILTER (l0 = 'but') OVER d AS but
    FROM heard WINDOW w AS (PARTITION BY id ORDER BY place), d AS (PARTITION BY id)),
zero AS (
    SELECT *, valence + CASE WHEN mixed AND u0 THEN CASE WHEN valence > 0 THEN 0.733 ELSE -0.733 END ELSE 0 END::DOUBLE AS v0
    FROM lagged WHERE k0 AND l0 NOT IN ({quoted([*BOOSTERS, *DAMPENERS])})),
one AS (SELECT *, {stepped(1, 1.0)} FROM zero),
two AS (SELECT *, {stepped(2, 0.95)} FROM one),
three AS (SELECT *, {stepped(3, 0.9)} FROM two),
valued AS (
    SELECT id, v3 * CASE WHEN l1 = 'least' AND NOT k1 AND coalesce(l2, '') NOT IN ('at', 'very') THEN -0.74 ELSE 1 END
           * CASE WHEN place < but THEN 0.5 WHEN place > but THEN 1.5 ELSE 1 END AS valence
    FROM three),
marks AS (
    SELECT id, least(len(regexp_extract_all(summary, '!')), 4) * 0.292::DOUBLE
           + CASE WHEN len(regexp_extract_all(summary, '[?]')) <= 1 THEN 0
                  WHEN len(regexp_extract_all(summary, '[?]')) <= 3 THEN len(regexp_extract_all(summary, '[?]')) * 0.18
                  ELSE 0.96 END::DOUBLE AS emphasis
    FROM articles),
totals AS (
    SELECT id, total + sign(total) * emphasis AS total
    FROM (SELECT id, sum(valence) AS total FROM valued GROUP BY id) JOIN marks USING (id)),
scores AS (SELECT id, round(total / sqrt(total * total + 15), 6) AS sentiment_score FROM totals)"""

GAZETTEER = f"""
gazetteer AS (
    SELECT DISTINCT array_to_string(list_slice(ws, first, first + size - 1), ' ') AS phrase, label
    FROM (SELECT ws, size, label, unnest(range(1, greatest(len(ws), 1) + 1, size)) AS first
          FROM (SELECT {tokens("text")} AS ws, item_id % 3 + 1 AS size,
                       ['PERSON', 'ORG', 'GPE'][item_id % 3 + 1] AS label FROM benchmark)))"""


def names(label: str, column: str) -> str:
    found = f"list(DISTINCT phrase) FILTER (label = '{label}')"
    return f"array_to_string(list_sort(coalesce({found}, [])), '|') AS {column}"


NAMES = ", ".join([names("PERSON", "persons"), names("ORG", "organizations"), names("GPE", "locations")])
ENTITIES = f"""
spoken AS (SELECT id, ' ' || array_to_string({spoken("summary")}, ' ') || ' ' AS words FROM articles),
sought AS (SELECT phrase, label, array_to_string({spoken("phrase")}, ' ') AS bare FROM gazetteer),
found AS (SELECT id, phrase, label FROM spoken JOIN sought ON contains(words, ' ' || bare || ' ')),
lists AS (SELECT id, {NAMES} FROM found GROUP BY id)"""

STORED = """
stored AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS title, o_orderdate AS updated_at,
           true AS is_active
    FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), o_orderpriority, o_orderdate - INTERVAL 30 DAY, false
    FROM orders WHERE o_orderstatus = 'F')"""
ARRIVING = """
once AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS id, 'again ' || o_orderpriority AS title, o_orderstatus AS status,
           o_orderdate + CASE o_orderpriority
               WHEN '1-URGENT' THEN INTERVAL 10 DAY WHEN '2-HIGH' THEN INTERVAL 0 DAY
               WHEN '3-MEDIUM' THEN INTERVAL (-5) DAY WHEN '4-NOT SPECIFIED' THEN INTERVAL 20 DAY
               ELSE INTERVAL (-40) DAY END AS updated_at
    FROM orders),
arriving AS (
    SELECT id, title, updated_at FROM once
    UNION ALL
    SELECT id, 'late ' || title, updated_at + INTERVAL 5 DAY FROM once WHERE status = 'O'),
latest AS (
    SELECT id, title, updated_at FROM arriving
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1)"""
DATED = "strftime(updated_at, '%Y-%m-%d') AS updated_at"
ORDER_FEED = """
feed AS (
    SELECT 'articles' AS source, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey AS VARCHAR) END AS id,
           o_orderpriority AS title,
           CASE WHEN o_orderpriority <> '1-URGENT' THEN epoch_us(o_orderdate) END AS updated_us,
           CASE WHEN o_orderstatus = 'P' THEN 'null key'
                WHEN o_orderpriority = '1-URGENT' THEN 'malformed updated_at' ELSE '' END AS reason
    FROM orders)"""

TITLE_WORDS = without(tokens(clean_title("title")), TITLE_STOP_WORDS)
MONTHLY = f"""
worded AS (
    SELECT l_shipdate, unnest({TITLE_WORDS}) AS word
    FROM lineitem JOIN (SELECT p_partkey, p_name AS title FROM part) ON l_partkey = p_partkey),
trends AS (
    SELECT 'articles' AS source, CAST(year(l_shipdate) AS INTEGER) AS year,
           CAST(month(l_shipdate) AS INTEGER) AS month, word, count(*) AS count
    FROM worded GROUP BY ALL)"""
ACTIVITY = """
activity AS (
    SELECT 'articles' AS source, regexp_extract(html, 'lang="([a-z]+)"', 1) AS news_site,
           regexp_extract(url, '(https?://[^/]+)', 1) AS domain_url, count(*) AS count
    FROM pages GROUP BY ALL)"""
NATURAL = "source NULLS FIRST, news_site NULLS FIRST, domain_url NULLS FIRST"
TOPICS = """
topics AS (
    SELECT 'articles' AS source, CAST(vec_id AS VARCHAR) AS id,
           CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS topic
    FROM embeddings),
dim_topic AS (
    SELECT row_number() OVER (ORDER BY source, topic) AS topic_id, source, topic
    FROM (SELECT DISTINCT source, topic FROM topics))"""

SOCIALS = ", ".join(
    f"CASE WHEN a > 1 THEN '{name}/' || c_custkey END AS authors_socials_{name}"
    for name in ("youtube", "instagram", "linkedin", "mastodon", "bluesky")
)

ORACLE = {
    "scan_project": "SELECT doc_id, lang, source, n_chars FROM documents",
    "page_envelope_unnest": f"WITH {ARTICLES} SELECT id, title, summary, news_site, url FROM articles",
    "typed_rejects": f"WITH {ORDER_FEED} SELECT source, id, title, updated_us, reason FROM feed",
    "parse_timestamps": """
        SELECT event_id, CASE event_type WHEN 'error' THEN NULL
               WHEN 'view' THEN epoch_us(date_trunc('second', ts)) ELSE epoch_us(ts) END AS instant_us
        FROM events""",
    "ingest_stamp": """
        SELECT CAST(doc_id AS VARCHAR) AS id, 'blogs' AS source, true AS is_active, true AS is_stamped
        FROM documents""",
    "high_water_mark": """
        SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS mark FROM events GROUP BY event_type
        UNION ALL SELECT 'none', '1950-01-01 00:00:00.000000'""",
    "incremental_rows": """
        SELECT event_id, event_type, value FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'""",
    "flatten_cross": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS title,
               c_mktsegment || '-' || a AS authors_name, {SOCIALS},
               c_custkey || '-' || l AS launches_launch_id,
               CASE WHEN l IS NOT NULL THEN c_mktsegment END AS launches_provider,
               CAST(c_nationkey + e AS INTEGER) AS events_event_id,
               CASE WHEN e IS NOT NULL THEN c_name END AS events_provider
        FROM customer
        LEFT JOIN range(1, 4) authors(a) ON a <= c_nationkey % 3 AND c_mktsegment <> 'MACHINERY'
        LEFT JOIN range(1, 4) launches(l) ON l <= CAST(floor(c_acctbal) AS BIGINT) % 4
        LEFT JOIN range(1, 4) events(e) ON e <= c_nationkey % 2 AND c_acctbal > 0""",
    "flatten_single": """
        WITH cut AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda t: t <> '') AS lines
                     FROM documents)
        SELECT doc_id, unnest(CASE WHEN len(lines) = 0 THEN [NULL] ELSE lines END) AS line FROM cut""",
    "mark_superseded": f"""
        WITH {STORED} SELECT id, title, {DATED}, is_active AND title <> '1-URGENT' AS is_active FROM stored""",
    "new_rows_anti": f"""
        WITH {STORED}, {ARRIVING} SELECT id, title, {DATED} FROM arriving
        WHERE NOT EXISTS (SELECT 1 FROM stored WHERE stored.id = arriving.id)""",
    "latest_versions": f"WITH {ARRIVING} SELECT id, title, {DATED} FROM latest",
    "merge_flag_only": f"""
        WITH {STORED}, {ARRIVING}
        SELECT id, title, {DATED}, is_active AND id NOT IN (SELECT id FROM latest) AS is_active FROM stored
        UNION ALL
        SELECT id, title, {DATED}, true FROM latest WHERE id NOT IN (SELECT id FROM stored)""",
    "merge_history": f"""
        WITH {STORED}, {ARRIVING},
        newest AS (SELECT id, max(updated_at) AS stored_at FROM stored GROUP BY id),
        accepted AS (
            SELECT id, title, updated_at FROM latest LEFT JOIN newest USING (id)
            WHERE stored_at IS NULL OR updated_at > stored_at)
        SELECT id, title, {DATED}, is_active AND id NOT IN (SELECT id FROM accepted) AS is_active FROM stored
        UNION ALL SELECT id, title, {DATED}, true FROM accepted""",
    "union_missing_columns": """
        SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, CAST(NULL AS INTEGER) AS nation
        FROM customer
        UNION ALL SELECT s_name, s_acctbal, NULL, s_nationkey FROM supplier""",
    "clean_summary": f"SELECT doc_id, {clean_summary('text')} AS clean_summary FROM documents",
    "clean_title": f"SELECT conv_id, turn, {clean_title('text')} AS clean_title FROM conversations",
    "tokens": f"""
        SELECT doc_id, CAST(len(ws) AS INTEGER) AS n_tokens, array_to_string(ws, ' ') AS token_text
        FROM (SELECT doc_id, {tokens(clean_summary("text"))} AS ws FROM documents)""",
    "tokens_no_stopwords": f"""
        SELECT doc_id, CAST(len(ws) AS INTEGER) AS n_tokens, array_to_string(ws, ' ') AS token_text
        FROM (SELECT doc_id, {SUMMARY_WORDS} AS ws FROM documents)""",
    "title_tokens_no_stopwords": f"""
        SELECT conv_id, turn, CAST(len(ws) AS INTEGER) AS n_tokens, array_to_string(ws, ' ') AS token_text
        FROM (SELECT conv_id, turn, {without(tokens(clean_title("text")), TITLE_STOP_WORDS)} AS ws
              FROM conversations)""",
    "term_counts": f"WITH {DOCUMENT_TERMS} SELECT doc_id, term, tf FROM counts",
    "vocabulary_top1000": f"""
        WITH {DOCUMENT_TERMS} SELECT term, total AS count FROM frequencies ORDER BY total DESC, term LIMIT 1000""",
    "document_frequency": f"WITH {DOCUMENT_TERMS} SELECT term, df FROM frequencies",
    "tfidf": f"WITH {DOCUMENT_TERMS} SELECT doc_id, term, tf, df, tfidf FROM weighted",
    "tfidf_vocabulary": f"""
        WITH {DOCUMENT_TERMS},
        kept AS (SELECT term FROM frequencies ORDER BY total DESC, term LIMIT 1000)
        SELECT doc_id, term, tf, df, tfidf FROM weighted WHERE term IN (SELECT term FROM kept)""",
    "keywords_top5": f"""
        WITH {DOCUMENT_TERMS},
        ranked AS (
            SELECT doc_id, term, tfidf,
                   row_number() OVER (PARTITION BY doc_id ORDER BY tfidf DESC, term) AS rank
            FROM weighted)
        SELECT doc_id, CAST(rank AS INTEGER) AS rank, term, tfidf FROM ranked WHERE rank <= 5""",
    "argmax_index": """
        SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS topic
        FROM embeddings""",
    "sentiment": f"""
        WITH {ARTICLES}, {LEXICON}, {SENTIMENT} SELECT id, sentiment_score FROM scores""",
    "entities": f"""
        WITH {ARTICLES}, {GAZETTEER}, {ENTITIES} SELECT id, persons, organizations, locations FROM lists""",
    "content_analysis": f"""
        WITH {ARTICLES}, {LEXICON}, {GAZETTEER}, {SENTIMENT}, {ENTITIES}
        SELECT source, id, title, summary, {clean_summary("summary")} AS clean_summary, news_site,
               regexp_extract(url, '(https?://[^/]+)', 1) AS domain_url,
               coalesce(sentiment_score, 0) AS sentiment_score, coalesce(persons, '') AS persons,
               coalesce(organizations, '') AS organizations, coalesce(locations, '') AS locations
        FROM articles LEFT JOIN scores USING (id) LEFT JOIN lists USING (id)""",
    "word_trends_monthly": f"WITH {MONTHLY} SELECT source, year, month, word, count FROM trends",
    "top_trends": f"""
        WITH {MONTHLY} SELECT source, year, month, word, count FROM trends
        ORDER BY count DESC, year, month, word LIMIT 10""",
    "word_trends_by_source": f"""
        WITH titled AS (
            SELECT 'articles' AS source, text AS title, doc_id AS id FROM documents
            UNION ALL SELECT 'blogs', text, conv_id FROM conversations
            UNION ALL SELECT 'reports', text, item_id FROM benchmark),
        worded AS (SELECT source, DATE '1970-01-01' + CAST(id AS INTEGER) AS day, unnest({TITLE_WORDS}) AS word FROM titled)
        SELECT source, CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month, word, count(*) AS count
        FROM worded GROUP BY ALL""",
    "source_activity": f"WITH {ACTIVITY} SELECT source, news_site, domain_url, count FROM activity",
    "dim_news_source": f"""
        WITH {ACTIVITY}
        SELECT row_number() OVER (ORDER BY {NATURAL}) AS source_id, news_site AS name, domain_url AS url,
               count AS reliability_score, source
        FROM activity""",
    "dim_news_source_grown": f"""
        WITH {ACTIVITY},
        first AS (
            SELECT *, row_number() OVER (ORDER BY {NATURAL}) AS source_id
            FROM activity WHERE domain_url LIKE 'http://%'),
        later AS (
            SELECT *, (SELECT count(*) FROM first) + row_number() OVER (ORDER BY {NATURAL}) AS source_id
            FROM activity WHERE domain_url NOT LIKE 'http://%')
        SELECT source_id, news_site AS name, domain_url AS url, count AS reliability_score, source
        FROM (SELECT * FROM first UNION ALL SELECT * FROM later)""",
    "dim_topic": f"WITH {TOPICS} SELECT topic_id, source, topic FROM dim_topic",
    "fact_article": f"""
        WITH {ARTICLES}, {TOPICS},
        placed AS (SELECT *, regexp_extract(url, '(https?://[^/]+)', 1) AS domain_url FROM articles),
        sites AS (
            SELECT *, row_number() OVER (ORDER BY {NATURAL}) AS source_id
            FROM (SELECT DISTINCT source, news_site, domain_url FROM placed))
        SELECT p.id AS article_id, s.source_id, d.topic_id, p.source, p.title, t.topic
        FROM placed p JOIN sites s USING (source, news_site, domain_url)
        LEFT JOIN topics t ON t.id = p.id AND t.source = p.source
        LEFT JOIN dim_topic d ON d.topic = t.topic AND d.source = p.source""",
    "fact_article_measures": f"""
        WITH {ARTICLES}, {TOPICS}, {LEXICON}, {GAZETTEER}, {SENTIMENT}, {ENTITIES},
        placed AS (SELECT *, regexp_extract(url, '(https?://[^/]+)', 1) AS domain_url FROM articles),
        sites AS (
            SELECT *, row_number() OVER (ORDER BY {NATURAL}) AS source_id
            FROM (SELECT DISTINCT source, news_site, domain_url FROM placed))
        SELECT p.id AS article_id, s.source_id, d.topic_id, p.source, p.title, p.summary,
               {clean_summary("p.summary")} AS clean_summary, coalesce(persons, '') AS persons,
               coalesce(organizations, '') AS organizations, coalesce(locations, '') AS locations,
               coalesce(sentiment_score, 0) AS sentiment_score,
               (SELECT array_to_string([CAST(CAST(floor(CAST(x AS DOUBLE) * 1000) AS BIGINT) AS VARCHAR) FOR x IN embedding], '|')
                FROM embeddings WHERE CAST(vec_id AS VARCHAR) = p.id) AS topic_distribution, t.topic
        FROM placed p JOIN sites s USING (source, news_site, domain_url)
        LEFT JOIN topics t ON t.id = p.id AND t.source = p.source
        LEFT JOIN dim_topic d ON d.topic = t.topic AND d.source = p.source
        LEFT JOIN scores ON scores.id = p.id LEFT JOIN lists ON lists.id = p.id""",
    "lda_topics_checked": f"""
        WITH {DOCUMENT_TERMS},
        kept AS (SELECT term FROM frequencies ORDER BY total DESC, term LIMIT 1000),
        worded AS (SELECT DISTINCT doc_id FROM counts WHERE term IN (SELECT term FROM kept))
        SELECT doc_id, CASE WHEN worded.doc_id IS NULL THEN 0 ELSE 1 END::DOUBLE AS mass,
               worded.doc_id IS NULL AS no_topic, true AS in_range
        FROM documents LEFT JOIN worded USING (doc_id)""",
    "topic_terms_checked": "SELECT range AS topic, CAST(10 AS BIGINT) AS n_terms, CAST(10 AS BIGINT) AS n_known FROM range(5)",
    "topic_vectors": f"""
        WITH {DOCUMENT_TERMS},
        kept AS (SELECT term FROM frequencies ORDER BY total DESC, term LIMIT 1000)
        SELECT doc_id, term, tfidf AS weight FROM weighted WHERE tfidf > 0 AND term IN (SELECT term FROM kept)""",
    "audit_log": f"""
        WITH {ORDER_FEED}
        SELECT 'load articles' AS process_name, CASE reason WHEN '' THEN 'accepted' ELSE 'rejected' END AS stage,
               'Completed' AS status, count(*) AS record_count
        FROM feed GROUP BY ALL""",
}
ORACLE["merge_stored"] = ORACLE["merge_history"]
ORACLE["merge_compacted"] = ORACLE["merge_history"]
ORACLE["versions_by_index"] = f"""
    WITH merged AS ({ORACLE["merge_history"]}),
    oldest AS (
        SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderstatus <> 'P' ORDER BY o_orderdate, o_orderkey LIMIT 20)
    SELECT id, updated_at FROM merged JOIN oldest USING (id)"""
ORACLE["trends_by_batch"] = f"""
    WITH merged AS ({ORACLE["merge_history"]}),
    worded AS (SELECT CAST(updated_at AS DATE) AS day, unnest({TITLE_WORDS}) AS word FROM merged WHERE is_active)
    SELECT 'articles' AS source, CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month, word, count(*) AS count
    FROM worded GROUP BY ALL"""
ORACLE["activity_by_batch"] = """
    WITH moved AS (
        SELECT CASE WHEN page_id % 3 = 0 THEN 'new ' ELSE '' END || regexp_extract(html, 'lang="([a-z]+)"', 1) AS news_site,
               regexp_extract(url, '(https?://[^/]+)', 1) AS domain_url
        FROM pages)
    SELECT 'blogs' AS source, news_site, domain_url, count(*) AS count FROM moved GROUP BY ALL"""
ORACLE["ledger_runs"] = """
    WITH landed AS (SELECT (doc_id // 100) % 2 AS part FROM documents)
    SELECT 'run ' || run AS run_id, count(*) FILTER (part = step) AS merged, count(*) FILTER (part = step) > 0 AS read_files
    FROM landed, (VALUES (0, 0), (1, -1), (2, 1), (3, -1)) AS runs(run, step) GROUP BY run, step"""
ORACLE["rescued_fields"] = "SELECT CAST(doc_id AS VARCHAR) AS id, lang, n_chars, source FROM documents"
ORACLE["versions_read"] = """
    WITH members AS (
        SELECT 'part ' || n_nationkey % 3 AS source, n_name AS news_site, CAST(n_regionkey AS BIGINT) AS count FROM nation)
    SELECT 'before' AS version, * FROM members
    UNION ALL SELECT 'latest', source, news_site, CASE WHEN source = 'part 1' THEN count + 100 ELSE count END FROM members"""
ORACLE["topics_continued"] = """
    WITH listed AS (
        SELECT vec_id, label, unnest(range(len(embedding))) AS term, unnest(embedding) AS x FROM embeddings WHERE label < 4),
    stored AS (SELECT label AS topic, term, avg(abs(x)::DOUBLE) AS weight FROM listed WHERE vec_id % 2 = 0 GROUP BY ALL),
    fresh AS (SELECT (label + 1) % 4 AS topic, term, avg(abs(x)::DOUBLE) AS weight FROM listed WHERE vec_id % 2 = 1 GROUP BY ALL),
    alike AS (
        SELECT fresh.topic AS t, stored.topic AS s,
               sum(fresh.weight * stored.weight) / sqrt(sum(fresh.weight ** 2) * sum(stored.weight ** 2)) AS l
        FROM fresh JOIN stored USING (term) GROUP BY ALL),
    best AS (
        SELECT a.s AS n0, b.s AS n1, c.s AS n2, d.s AS n3
        FROM alike a, alike b, alike c, alike d
        WHERE a.t = 0 AND b.t = 1 AND c.t = 2 AND d.t = 3 AND a.s NOT IN (b.s, c.s, d.s) AND b.s NOT IN (c.s, d.s) AND c.s <> d.s
        ORDER BY a.l + b.l + c.l + d.l DESC LIMIT 1)
    SELECT CAST(topic AS BIGINT) AS topic, CAST(number AS BIGINT) AS number
    FROM (SELECT unnest([0, 1, 2, 3]) AS topic, unnest([n0, n1, n2, n3]) AS number FROM best)"""
ORACLE["analysis_row"] = f"""
    WITH analysed AS ({ORACLE["content_analysis"]}),
    checked AS ({ORACLE["lda_topics_checked"]})
    SELECT analysed.*, mass, no_topic, true AS largest FROM analysed JOIN checked ON id = CAST(doc_id AS VARCHAR)"""
ORACLE["topic_weights_checked"] = f"""
    WITH {DOCUMENT_TERMS},
    kept AS (SELECT term FROM frequencies ORDER BY total DESC, term LIMIT 1000)
    SELECT topic, count(*) AS n_terms, count(*) AS n_known, CAST(1 AS DOUBLE) AS total
    FROM kept, (SELECT unnest(range(5)) AS topic) GROUP BY topic"""
