"""The same results in SQL that DuckDB runs on the driver's tables."""

from __future__ import annotations

import unicodedata

from broadsheet.operators.corpus import STOP_WORDS
from broadsheet.operators.prompts import DEFAULT_TASKS, prompt_text
from broadsheet.plans.views import ANSWERS


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _nested_replace(sql: str, pairs: dict[str, str]) -> str:
    for old, new in pairs.items():
        sql = f"replace({sql}, {_quoted(old)}, {_quoted(new)})"
    return sql


# -- views ------------------------------------------------------------------------

_ARTICLES = """
numbered AS (
  SELECT *, regexp_extract(source, '[0-9]+')::INT AS num FROM documents
),
v_articles AS (
  SELECT doc_id, lang, regexp_extract(text, '^[^.\\n]*') AS title, text AS body,
         'https://news.example.com/' || substr(sha256(text), 1, 16) AS url, source,
         (DATE '2024-01-01' + (n_chars % 365)::INT)::DATE::VARCHAR || 'T00:00:00Z' AS published_at,
         'Desk ' || lang AS author,
         '2024-01-0' || (num % 3 + 1)::VARCHAR || 'T06:00:00' AS fetched_at,
         CASE WHEN num < 10 THEN 0 ELSE 1 END AS source_ord, num AS feed_ord
  FROM numbered
),
v_untitled AS (
  SELECT * REPLACE (CASE WHEN length(title) <= 300 THEN title END AS title) FROM v_articles
)"""


def _articles(select: str, *ctes: str) -> str:
    return f"WITH {_ARTICLES}{''.join(', ' + c for c in ctes)} {select}"


_BY_LANG = "row_number() OVER (PARTITION BY lang, doc_id // 100 ORDER BY doc_id) - 1"
_BY_SOURCE = "row_number() OVER (PARTITION BY source, doc_id // 1000 ORDER BY doc_id) - 1"

_REST = f"""rest AS (
  SELECT title, body, url, CASE WHEN lang = 'en' THEN source WHEN lang = 'fr' THEN 'unknown' ELSE 'unknown' END AS source,
         CASE lang WHEN 'en' THEN published_at WHEN 'fr' THEN published_at WHEN 'de' THEN NULL ELSE '' END AS published_at,
         CASE lang WHEN 'en' THEN author WHEN 'de' THEN NULL ELSE '' END AS author,
         lang AS category, 'newsapi' AS provider, 0::BIGINT AS source_ord, 0::BIGINT AS feed_ord,
         ({_BY_LANG})::BIGINT AS pos
  FROM v_untitled {{where}}
)"""
_FEEDS = f"""feeds AS (
  SELECT title, body, url,
         CASE WHEN source_ord = 0 THEN 'Feed ' || source ELSE 'https://feeds.example.com/' || source END AS source,
         CASE WHEN lang = 'es' THEN '' ELSE published_at END AS published_at,
         CASE WHEN lang = 'en' THEN author ELSE '' END AS author,
         'https://feeds.example.com/' || source AS feed_url, 'rss' AS provider,
         source_ord::BIGINT AS source_ord, feed_ord::BIGINT AS feed_ord, ({_BY_SOURCE})::BIGINT AS pos
  FROM v_untitled {{where}}
)"""
_ITEMS = f"items AS (SELECT lang AS category, ({_BY_LANG})::BIGINT AS pos, url FROM v_untitled)"

_DAILY = """
  SELECT *, substr(fetched_at, 1, 10) AS ingest_date FROM v_articles
  WHERE title <> '' AND source_ord = {ord}
  QUALIFY row_number() OVER (PARTITION BY substr(fetched_at, 1, 10), url ORDER BY fetched_at, source_ord, feed_ord, doc_id) = 1
"""

# -- text -------------------------------------------------------------------------

_LATIN = {
    c: unicodedata.normalize("NFKD", c)
    for c in map(chr, range(0xC0, 0x100))
    if unicodedata.normalize("NFKD", c) != c
}
_WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _html(sql: str) -> str:
    blocks = [r"<!--.*?-->"]
    blocks += [rf"<{t}(?:\s[^>]*)?>.*?</{t}\s*>" for t in ("script", "style", "template", "rt", "rp")]
    blocks += [r"""<[a-zA-Z/](?:[^'">]|"[^"]*"|'[^']*')*>""", r"<[!?][^>]*>"]
    for pattern in blocks:  # all markup becomes one kind of mark, then runs of it a space
        sql = f"regexp_replace({sql}, {_quoted(pattern)}, chr(1), 'gis')"
    # a reference may lack its semicolon where something other than a name goes on
    sql = f"regexp_replace({sql}, '&(lt|gt|quot|copy|middot|amp)([^;a-zA-Z0-9.-])', '&\\1;\\2', 'g')"
    sql = f"regexp_replace(trim({sql}, chr(1)), chr(1) || '+', ' ', 'g')"
    entities = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&copy;": "©", "&middot;": "·", "&amp;": "&"}
    return _nested_replace(sql, entities)


def _nfkd(sql: str) -> str:
    return _nested_replace(sql, _LATIN)


def _ws(sql: str) -> str:
    return f"trim(regexp_replace({sql}, {_quoted(_WS)}, ' ', 'g'))"


def _clean(sql: str) -> str:
    return _ws(_nfkd(_html(f"coalesce({sql}, '')")))


def _corpus_clean(sql: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({sql}), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g'))"


# -- corpus -----------------------------------------------------------------------

_STOP = ", ".join(_quoted(w) for w in STOP_WORDS)
_TOKENS = f"""
tokens AS (
  SELECT doc_id, list_filter(string_split({_corpus_clean("text")}, ' '),
                             lambda w: regexp_full_match(w, '[a-z]+') AND w NOT IN ({_STOP})) AS tokens
  FROM documents
),
terms AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM tokens)
  WHERE length(term) >= 2 GROUP BY doc_id, term
),
stats AS (SELECT term, count(*)::BIGINT AS df, sum(tf)::BIGINT AS tf_total FROM terms GROUP BY term),
top AS (SELECT * FROM stats ORDER BY tf_total DESC, term LIMIT 5000),
vocab AS (
  SELECT term, (row_number() OVER (ORDER BY term) - 1)::BIGINT AS term_idx, df, tf_total,
         ln((1.0 + (SELECT count(*) FROM tokens)) / (1.0 + df)) + 1.0 AS idf
  FROM top
),
weighted AS (SELECT doc_id, term_idx, term, tf * idf AS w FROM terms JOIN vocab USING (term))"""
_LABELLED = "SELECT d.doc_id, d.text, l.quality AS label FROM documents d JOIN labels l USING (doc_id) WHERE l.quality IS NOT NULL"
_HASHED = "('0x' || substr(md5('42:' || {id}), 1, 8))::BIGINT % 10000 < 1000"


def _prompts(select: str) -> str:
    around = {t: prompt_text(t).split("{title}\n{body}") for t in DEFAULT_TASKS}
    tasks = ", ".join(
        f"({i}::BIGINT, {_quoted(t)}, {_quoted(around[t][0])}, {_quoted(around[t][1])})" for i, t in enumerate(DEFAULT_TASKS)
    )
    made = f"""made AS (
      SELECT doc_id, title, url, substr(sha256(url), 1, 16) AS uid, task_ord, task,
             head || title || chr(10) || substr(body, 1, 2000) || tail AS prompt
      FROM v_articles CROSS JOIN (VALUES {tasks}) AS t(task_ord, task, head, tail)
    )"""
    return _articles(select, made)


_FLAT = "title, body, url, source, published_at, author"
_ARTICLE_AUTHOR = "CASE WHEN lang = 'de' THEN NULL WHEN lang = 'es' THEN {absent} ELSE author END AS author"


_SCORE = "try_cast(nullif(regexp_extract(answer, 'Impact Score: *([0-9]+) *[|] *Description: *(.*)', 1, 's'), '') AS INT)"
_GIVEN = "answers AS (" + " UNION ALL ".join(
    f"SELECT doc_id, lang, url, title, '{task}' AS task, {answer} AS answer FROM v_articles" for task, answer in ANSWERS.items()
) + ")"
_PARSED = f"""parsed AS (
  SELECT *, substr(sha256(url), 1, 16) AS uid,
         CASE WHEN task = 'sentiment' THEN nullif(regexp_extract(answer, 'Sentiment: *(Bullish|Bearish|Neutral) *[|] *Reasoning: *(.*)', 1, 's'), '') END AS sentiment,
         CASE WHEN task = 'sentiment' THEN nullif(regexp_extract(answer, 'Sentiment: *(Bullish|Bearish|Neutral) *[|] *Reasoning: *(.*)', 2, 's'), '') END AS reasoning,
         CASE WHEN task = 'impact' AND {_SCORE} BETWEEN 1 AND 10 THEN {_SCORE} END::BIGINT AS impact_score,
         CASE WHEN task = 'impact' THEN nullif(regexp_extract(answer, 'Impact Score: *([0-9]+) *[|] *Description: *(.*)', 2, 's'), '') END AS description,
         CASE WHEN task = 'entities' THEN array_to_string(list_filter([trim(e) FOR e IN string_split(answer, ',')], lambda e: e <> ''), '|') END AS entities
  FROM answers
)"""
_BY_SCORE = "ORDER BY impact_score DESC NULLS LAST, uid, doc_id"


# Classes of equal words, their runs of three, and all pairs of classes that share one.
_SIMILAR = r"""classes AS (
  SELECT normal, min(doc_id) AS id FROM (
    SELECT doc_id, array_to_string(regexp_extract_all(lower(body), '[^ \t\n\x0b\f\r]+'), ' ') AS normal FROM v_articles
  ) WHERE normal <> '' GROUP BY normal
),
sets AS (
  SELECT id, CASE WHEN len(w) < 3 THEN [normal]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
  FROM (SELECT *, string_split(normal, ' ') AS w FROM classes)
),
posted AS (SELECT id, len(s) AS n, unnest(s) AS shingle FROM sets),
pairs AS (
  SELECT a.id AS id_a, b.id AS id_b, count(*) AS n_common, any_value(a.n + b.n) - count(*) AS n_all
  FROM posted a JOIN posted b ON a.shingle = b.shingle AND a.id < b.id
  GROUP BY a.id, b.id HAVING 100 * count(*) >= 85 * (any_value(a.n + b.n) - count(*))
)"""


def oracle() -> dict[str, str]:
    page_title = "regexp_extract(html, '<title>(.*?)</title>', 1, 's')"
    page_author = "CASE WHEN html LIKE '%</html>' THEN regexp_extract(html, '<h1>(.*?)</h1>', 1, 's') END"
    return {
        "scan_raw_articles": _articles(
            f"SELECT lang || '-' || (doc_id // 100) || '.json' AS path, ({_BY_LANG})::BIGINT AS pos, title, body, url, "
            f"source, published_at, {_ARTICLE_AUTHOR.format(absent=chr(39) * 2)}, fetched_at, lang AS category FROM v_articles"
        ),
        "raw_rejects": _articles(
            "SELECT lang || '-' || chunk || '.json' AS path, n::BIGINT AS pos FROM files UNION ALL "
            "SELECT lang || '-' || chunk || '-torn.json', NULL FROM files",
            "files AS (SELECT lang, doc_id // 100 AS chunk, count(*) AS n FROM v_articles GROUP BY ALL)",
        ),
        "newsapi_items": _articles("SELECT * FROM items", _ITEMS),
        "page_capped": _articles("SELECT * FROM items WHERE pos < 50", _ITEMS),
        "newsapi_articles": _articles(
            f"SELECT {_FLAT}, category, provider, pos FROM rest WHERE title <> ''", _REST.format(where="")
        ),
        "rss_articles": _articles(
            f"SELECT {_FLAT}, feed_url, provider, source_ord, feed_ord, pos FROM feeds WHERE title <> ''",
            _FEEDS.format(where=""),
        ),
        "enabled_sources": """
            WITH arrivals AS (
              SELECT doc_id, 'newsapi' AS source_type, lang AS source_key FROM documents
              UNION ALL SELECT doc_id, 'rss', source FROM documents
            ),
            usable(source_type, source_key, source_ord, feed_ord, page_size) AS (VALUES
              ('rss', 'src3', 0, 0, 50), ('rss', 'src1', 0, 1, 50), ('rss', 'src19', 0, 2, 50),
              ('newsapi', 'fr', 1, 0, 100), ('newsapi', 'en', 1, 1, 100),
              ('rss', 'src12', 4, 0, 20), ('rss', 'src7', 4, 1, 20))
            SELECT doc_id, source_type, source_key, source_ord::BIGINT AS source_ord,
                   feed_ord::BIGINT AS feed_ord, page_size::BIGINT AS page_size
            FROM arrivals JOIN usable USING (source_type, source_key)""",
        "collect_union": _articles(
            f"SELECT {_FLAT}, source_ord, feed_ord, pos FROM rest WHERE title <> '' UNION ALL "
            f"SELECT {_FLAT}, source_ord, feed_ord, pos FROM feeds WHERE title <> ''",
            _REST.format(where="WHERE source_ord = 0"),
            _FEEDS.format(where="WHERE source_ord = 1"),
        ),
        "valid_articles": _articles("SELECT doc_id, url, title FROM v_untitled WHERE url <> '' AND title <> ''"),
        "dedup_url": _articles(
            "SELECT url, doc_id, source, title, body FROM v_articles "
            "QUALIFY row_number() OVER (PARTITION BY url ORDER BY source_ord, feed_ord, doc_id) = 1"
        ),
        "daily_merge": _articles(
            "SELECT ingest_date, url, source, title, body FROM stored UNION ALL "
            "SELECT ingest_date, url, source, title, body FROM batch ANTI JOIN stored USING (ingest_date, url)",
            f"stored AS ({_DAILY.format(ord=0)})",
            f"batch AS ({_DAILY.format(ord=1)})",
        ),
        "collection_stats": _articles(
            "SELECT source, count(*)::BIGINT AS n_rows, count(DISTINCT url)::BIGINT AS n_unique FROM v_articles GROUP BY source"
        ),
        "collection_totals": _articles(
            "SELECT count(*)::BIGINT AS n_rows, count(DISTINCT url)::BIGINT AS n_unique FROM v_articles"
        ),
        "hourly_collection": """
            SELECT date_trunc('hour', ts) AS interval_start, event_type AS source, count(*)::BIGINT AS n_rows,
                   count(DISTINCT user_id)::BIGINT AS n_unique
            FROM events GROUP BY 1, 2""",
        "article_uid": _articles("SELECT doc_id, url, substr(sha256(url), 1, 16) AS uid FROM v_articles"),
        "article_from_json": _articles(
            f"SELECT doc_id, title, body, url, source, published_at, {_ARTICLE_AUTHOR.format(absent=chr(39) * 2)}, "
            "fetched_at, lang AS category, 'newsapi' AS provider FROM v_articles"
        ),
        "article_to_json": _articles(
            "SELECT doc_id, to_json({'title': title, 'body': body, 'url': url, 'source': source, "
            "'published_at': published_at, 'author': author, "
            "'metadata': {'category': lang, 'provider': 'newsapi'}, 'fetched_at': fetched_at})::VARCHAR AS json FROM v_articles"
        ),
        "html_text": f"SELECT page_id, {_html('html')} AS text FROM pages",
        "nfkd_text": f"SELECT doc_id, {_nfkd('text')} AS text FROM documents",
        "normalize_ws": f"SELECT doc_id, {_ws('text')} AS text FROM documents",
        "clean_text": f"SELECT page_id, {_clean('html')} AS text FROM pages",
        "preprocess_articles": (
            f"SELECT page_id, url, {_clean(page_title)} AS title, {_clean('html')} AS body, "
            f"CASE WHEN author <> '' THEN {_clean('author')} ELSE author END AS author "
            f"FROM (SELECT *, {page_author} AS author FROM pages)"
        ),
        "preprocess_documents": _articles(
            f"SELECT doc_id, {_clean('title')} AS title, {_clean('body')} AS body, {_clean('author')} AS author FROM v_articles"
        ),
        "dataset_counts": "SELECT count(*)::BIGINT AS n_rows, count(*) = 0 AS is_empty FROM documents",
        "limit_articles": _articles("SELECT doc_id, url FROM v_articles ORDER BY url, doc_id LIMIT 100"),
        "train_test_split": _articles(
            f"SELECT doc_id, uid, CASE WHEN {_HASHED.format(id='uid')} THEN 'test' ELSE 'train' END AS split "
            "FROM (SELECT doc_id, substr(sha256(url), 1, 16) AS uid FROM v_articles)"
        ),
        "train_test_split_exact": """
            SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id))
                                     <= ceil((SELECT count(*) FROM documents) * 0.1::DECIMAL(3, 1)) THEN 'test' ELSE 'train' END AS split
            FROM documents""",
        "task_fanout": """
            SELECT doc_id, task_ord, task FROM documents CROSS JOIN
              (VALUES (0::BIGINT, 'summarize'), (1, 'sentiment'), (2, 'impact'), (3, 'entities')) AS t(task_ord, task)""",
        "build_prompts": _prompts("SELECT doc_id, uid, task_ord, task, prompt FROM made"),
        "generate_answers": _prompts("SELECT doc_id, task, 'chars:' || length(prompt) AS answer FROM made"),
        "analysis_report": _prompts("SELECT doc_id, title, url, task, 'chars:' || length(prompt) AS answer FROM made"),
        "labelled_corpus": f"SELECT text, label::BIGINT AS label FROM ({_LABELLED})",
        "shuffled_corpus": (
            "SELECT doc_id, (row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1)::BIGINT AS row_idx "
            f"FROM ({_LABELLED})"
        ),
        "corpus_clean": f"SELECT doc_id, {_corpus_clean('text')} AS text FROM documents",
        "corpus_tokens": (
            f"WITH {_TOKENS} SELECT doc_id, len(tokens)::BIGINT AS n_tokens, "
            "coalesce(array_to_string(tokens, ' '), '') AS text FROM tokens"
        ),
        "corpus_lemmas": f"""
            WITH {_TOKENS},
            lemma AS (SELECT term, left(term, length(term) - 1) AS base FROM stats
                      WHERE term LIKE '%s' AND left(term, length(term) - 1) IN (SELECT term FROM stats)),
            words AS (SELECT doc_id, unnest(tokens) AS term, generate_subscripts(tokens, 1) AS pos FROM tokens),
            joined AS (SELECT doc_id, string_agg(coalesce(base, term), ' ' ORDER BY pos) AS text
                       FROM words LEFT JOIN lemma USING (term) GROUP BY doc_id)
            SELECT doc_id, coalesce(text, '') AS text FROM tokens LEFT JOIN joined USING (doc_id)""",
        "term_stats": f"WITH {_TOKENS} SELECT term, df, tf_total FROM stats",
        "tfidf_vocab": f"WITH {_TOKENS} SELECT term, term_idx, df, tf_total, round(idf, 6) AS idf FROM vocab",
        "tfidf": f"""
            WITH {_TOKENS}
            SELECT doc_id, term_idx,
                   round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight
            FROM weighted""",
        "parsed_answers": _articles(
            "SELECT doc_id, task, answer, sentiment, reasoning, impact_score, description, entities FROM parsed", _GIVEN, _PARSED
        ),
        "length_filter": _articles("SELECT doc_id, body FROM v_articles WHERE length(body) BETWEEN 100 AND 10000"),
        "near_dup_pairs": _articles("SELECT id_a, id_b, n_common::BIGINT AS n_common, n_all::BIGINT AS n_all FROM pairs", _SIMILAR),
        "near_dedup": _articles(
            """SELECT doc_id, url FROM v_articles a
            LEFT JOIN classes c ON c.normal = array_to_string(regexp_extract_all(lower(a.body), '[^ \\t\\n\\x0b\\f\\r]+'), ' ')
            WHERE c.id IS NULL OR (a.doc_id = c.id AND NOT EXISTS (SELECT 1 FROM pairs p WHERE p.id_b = a.doc_id))""",
            _SIMILAR,
        ),
        "language_filter": _articles("SELECT doc_id, url FROM v_articles WHERE lang = 'en'"),
        "top_articles": _articles(
            f"SELECT doc_id, uid, impact_score FROM parsed WHERE task = 'impact' {_BY_SCORE} LIMIT 20", _GIVEN, _PARSED
        ),
        "report_sections": _articles(
            f"""SELECT section, place, doc_id, impact_score FROM (
              SELECT section, doc_id, impact_score, row_number() OVER (PARTITION BY section {_BY_SCORE}) AS place
              FROM parsed JOIN (VALUES ('en', 'Top Developments'), ('en', 'Key Signals'), ('es', 'Technology Highlights'),
                ('fr', 'Market Signals'), ('de', 'Geopolitical Events'), ('de', 'Key Signals')) AS m(lang, section) USING (lang)
              WHERE task = 'impact') WHERE place <= 20""",
            _GIVEN,
            _PARSED,
        ),
    }
