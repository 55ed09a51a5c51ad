"""SQL for DuckDB that gives the same rows as the registered queries."""

from __future__ import annotations

from contract.relations import CASED, SAMPLE, SINGLE_WORDS, TEST_SOURCES
from rolelake.dictionaries import KeywordDictionary

NOT_WORD = r"[^\pL\pN_]"
SPACES = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"
EVENTS_AS_OF = "TIMESTAMP '2024-01-30 12:00:00'"


def text_literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def stamp(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


UNUSUAL = r"""[^\pL\pN_ .,!?;:()''"/-]+"""


def clean(expr: str) -> str:
    collapsed = f"regexp_replace({expr}, '{SPACES}', ' ', 'g')"
    return f"coalesce(trim(regexp_replace({collapsed}, '{UNUSUAL}', '', 'g')), '')"


def variants_pattern(variants: list[str]) -> str:
    return "|".join(
        "".join(c if c.isalnum() or c == " " else "\\" + c for c in variant) for variant in variants
    )


def matches(expr: str, variants: list[str]) -> str:
    pattern = f"(^|{NOT_WORD})({variants_pattern(variants)})($|{NOT_WORD})"
    return f"regexp_matches({expr}, {text_literal(pattern)})"


def forms_as_matched(dictionary: KeywordDictionary, keyword: str) -> list[str]:
    forms = dictionary.variants[keyword]
    return [f if dictionary.case_sensitive else f.lower() for f in forms]


def keyword_list(expr: str, dictionary: KeywordDictionary) -> str:
    cells = ", ".join(
        f"CASE WHEN {matches(expr, forms_as_matched(dictionary, keyword))} THEN {text_literal(keyword)} END"
        for keyword in dictionary.variants
    )
    return f"list_sort(list_filter([{cells}], lambda k: k IS NOT NULL))"


def values(rows: list[tuple[str, ...]]) -> str:
    return ", ".join("(" + ", ".join(map(str, r)) + ")" for r in rows)


WEIGHTS = "weights(keyword, weight) AS (VALUES " + values(
    [(text_literal(k), f"CAST({w} AS DOUBLE)") for k, w in SAMPLE.weights.items()]
) + ")"
CATEGORIES = "categories(keyword, category) AS (VALUES " + values(
    [(text_literal(k), text_literal(c)) for k, c in SAMPLE.categories.items()]
) + ")"
PAIRINGS = "pairings(keyword, suggested) AS (VALUES " + values(
    [(text_literal(k), text_literal(s)) for k, skills in SAMPLE.pairings.items() for s in skills]
) + ")"

RAW_POSTINGS = f"""raw_postings AS (
  SELECT doc_id AS id, doc_id AS seq, split_part(text, chr(10), 1) AS job_title,
    CASE WHEN doc_id % 11 <> 0 THEN 'co' || (doc_id % 37) END AS company,
    'place ' || lang AS location, lang, text AS full_description,
    'https://' || source || '.example.com/' || (doc_id % 700) AS posting_url, source,
    CAST({AS_OF} - to_days(CAST(doc_id % 90 AS INTEGER)) AS DATE) AS posted_date,
    {AS_OF} - to_days(CAST(doc_id % 200 AS INTEGER)) AS scrape_timestamp,
    doc_id % 7 <> 3 AS is_active, doc_id % 5 = 0 AS is_notified
  FROM documents)"""

POSTINGS = RAW_POSTINGS + f""", texts AS (
  SELECT *, lower(job_title || ' ' || full_description) AS t, lower(job_title) AS lt FROM raw_postings
), listed AS (
  SELECT * EXCLUDE (t, lt), {keyword_list('t', SAMPLE)} AS ks, {keyword_list('lt', SAMPLE)} AS in_title
  FROM texts
), jobs AS (
  SELECT *, len(ks) AS n, array_to_string(ks, '|') AS keywords FROM listed
), pairs AS (SELECT id, source, scrape_timestamp, in_title, unnest(ks) AS keyword FROM jobs
)"""

SCORES = WEIGHTS + """, scores AS (
  SELECT jobs.id, coalesce(s.score, 0.0) AS keyword_score FROM jobs LEFT JOIN (
    SELECT id, sum(coalesce(weight, 1.0) * CASE WHEN list_contains(in_title, pairs.keyword) THEN 1.5 ELSE 1.0 END) AS score
    FROM pairs LEFT JOIN weights USING (keyword) GROUP BY id) s USING (id))"""

EVENT_JOBS = """event_jobs AS (
  SELECT event_id AS id, 'co' || user_id AS company, event_type AS source, ts AS scrape_timestamp,
    CAST(props->>'$.k' AS INTEGER) % 4 AS n, user_id % 7 <> 0 AS is_active, event_id % 3 = 0 AS is_notified
  FROM events)"""

FAULTY = RAW_POSTINGS + """, faulty AS (
  SELECT * REPLACE (
    CASE WHEN id % 19 <> 0 THEN job_title END AS job_title,
    CASE WHEN id % 17 = 0 THEN 'not a url ' || id WHEN id % 13 <> 0 THEN posting_url END AS posting_url,
    CASE WHEN id % 23 <> 0 THEN source END AS source)
  FROM raw_postings)"""

EXISTING = """existing AS (
  SELECT posting_url FROM raw_postings WHERE id IN (SELECT doc_id FROM labels))"""

ALLOWED = "(" + ", ".join(map(text_literal, TEST_SOURCES)) + ")"


def unnotified(min_keywords: int, relation: str = "jobs") -> str:
    return f"SELECT * FROM {relation} WHERE is_active AND NOT is_notified AND n >= {min_keywords}"


def pick(key: str, cells: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(cells))
    return f"CASE {key} % {len(cells)} {whens} END"


ANCHORS = r"""found AS (
  SELECT page_id, url,
    list_transform(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1),
      lambda h: replace(replace(h, '&quot;', '"'), '&amp;', '&')) AS hrefs,
    list_transform(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2),
      lambda h: replace(replace(h, '&quot;', '"'), '&amp;', '&')) AS titles
  FROM pages
), chosen AS (
  SELECT *, CASE WHEN list_any_value(list_filter(hrefs, lambda h: contains(h, '/th'))) IS NOT NULL THEN '/th'
                 WHEN list_any_value(list_filter(hrefs, lambda h: contains(h, '/d'))) IS NOT NULL THEN '/d'
                 ELSE '/' END AS pattern
  FROM found
), flat AS (
  SELECT page_id, url, pattern, hrefs, titles, unnest(hrefs) AS href, unnest(titles) AS title,
    generate_subscripts(hrefs, 1) - 1 AS pos
  FROM chosen
), firsts AS (
  SELECT * FROM flat WHERE contains(href, pattern) AND href <> url AND href <> ''
  QUALIFY row_number() OVER (PARTITION BY page_id, href ORDER BY pos) = 1
)"""

ORIGIN = "regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)"


def payload_text(name: str) -> str:
    """Text of a filled field: empty values other than strings count as missing."""
    kind, value = f"json_type(it, '$.{name}')", f"(it->>'$.{name}')"
    return (
        f"CASE WHEN {kind} = 'VARCHAR' THEN nullif({value}, '') "
        f"WHEN {value} IN ('0', 'false', '[]', '{{}}') THEN NULL ELSE {value} END"
    )


def payload_chain(*names: str, default: str | None = None) -> str:
    cells = [payload_text(n) for n in names] + ([text_literal(default)] if default else [])
    return f"coalesce({', '.join(cells)})"


PAYLOADS = """bodies AS (
  SELECT event_id, CASE event_id % 6
    WHEN 0 THEN '[{"title":"' || event_type || '","url":"/e/' || event_id || '","company":"u' || user_id || '"}]'
    WHEN 1 THEN '{"jobs":[],"results":[{"name":"' || event_type || '","link":"https://x.org/' || event_id || '","salary":' || (props->>'$.k') || '}]}'
    WHEN 2 THEN '{"data":[{"title":"","position":"' || event_type || '","job_url":"/p/' || event_id || '","city":"c' || user_id || '"},5,{"title":"no url"}]}'
    WHEN 3 THEN '{broken ' || event_id
    WHEN 4 THEN '{"listings":"text","items":[{"title":"t","url":"/never/' || event_id || '"}]}'
    ELSE '{"items":[{"title":' || (props->>'$.k') || ',"url":"/n/' || event_id || '","salary_text":"","salary_range":"' || (props->>'$.k') || 'k"}]}'
  END AS body FROM events
), parsed AS (SELECT event_id, TRY_CAST(body AS JSON) AS j FROM bodies
), arrays AS (
  SELECT event_id, CASE WHEN json_type(j) = 'ARRAY' THEN j ELSE coalesce(""" + ", ".join(
    f"CASE WHEN json_type(j, '$.{w}') IS NOT NULL AND CAST(j->'$.{w}' AS VARCHAR) NOT IN ('[]', '{{}}', '\"\"', '0', 'false', 'null') THEN j->'$.{w}' END"
    for w in ("jobs", "results", "data", "listings", "items")
) + """) END AS a FROM parsed
), items AS (
  SELECT event_id, unnest(from_json(a, '["JSON"]')) AS it, unnest(range(CAST(json_array_length(a) AS BIGINT))) AS item_pos
  FROM arrays WHERE json_type(a) = 'ARRAY'
)"""


def date_texts() -> str:
    cells = [
        "'Today'", "' just now '", "'Posted Yesterday'", "(event_id % 50) || ' days ago'",
        "(event_id % 9) || ' week ago'", "(event_id % 5) || 'months'", "(event_id % 70) || ' HOURS ago'",
        "'30+ days ago'", "'10 minutes ago'", "NULL", "''",
        "strftime(ts, '%Y-%m-%d')", "strftime(ts, '%-d/%-m/%Y')", "strftime(ts, '%d-%m-%Y')",
        "strftime(ts, '%B %-d, %Y')", "strftime(ts, '%-d %B %Y')", "upper(strftime(ts, '%b %-d, %Y'))",
        "strftime(ts, '%d  %b %Y')", "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')", "'31/02/2024'",
    ]
    return f"date_texts AS (SELECT event_id, ts, {pick('event_id', cells)} AS t FROM events)"


def relative(t: str = "lower(t)") -> str:
    hours = " ".join(
        f"WHEN regexp_matches({t}, '[0-9]+\\s*{unit}') THEN {EVENTS_AS_OF} - "
        f"to_hours(CAST(regexp_extract({t}, '([0-9]+)\\s*{unit}', 1) AS INTEGER) * {n})"
        for unit, n in (("day", 24), ("week", 168), ("month", 720), ("hour", 1))
    )
    return (
        f"CASE WHEN contains({t}, 'today') OR contains({t}, 'just now') THEN {EVENTS_AS_OF} "
        f"WHEN contains({t}, 'yesterday') THEN {EVENTS_AS_OF} - INTERVAL 1 DAY {hours} END"
    )


ABSOLUTE = (
    "try_strptime(regexp_replace(t, ' +', ' ', 'g'), ['%Y-%m-%d', '%d/%m/%Y', '%d-%m-%Y', "
    "'%B %d, %Y', '%d %B %Y', '%b %d, %Y', '%d %b %Y'])"
)

LINKS = "links AS (SELECT page_id, url, " + pick(
    "page_id",
    ["url", "'  ' || url", "regexp_replace(url, '^.*://', '')", "'1' || url", "url || '/a b'", "NULL"],
) + " AS link FROM pages)"

ORACLE: dict[str, str] = {}

ORACLE["page_links"] = f"""WITH {ANCHORS}
SELECT page_id, CAST(pos AS INTEGER) AS pos, href, {clean('title')} AS job_title,
  CASE WHEN starts_with(href, '/') THEN {ORIGIN} || href ELSE href END AS posting_url
FROM firsts WHERE length({clean('title')}) >= 4"""

ORACLE["page_links_hard"] = ORACLE["page_links"]

ORACLE["page_cards"] = f"""WITH {ANCHORS}, blocks AS (
  SELECT page_id, array_to_string(list_filter(list_transform(titles, lambda x: trim(x)), lambda x: x <> ''), '|') AS block,
    titles[list_position(list_transform(hrefs, lambda h: contains(h, '/a')), true)] AS company
  FROM chosen
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS card FROM firsts
)
SELECT page_id, CAST(card AS INTEGER) AS pos, {clean('title')} AS job_title,
  coalesce(CASE WHEN length(block) > length({clean('title')}) + 10 AND company IS NOT NULL THEN {clean('company')} END, 'N/A') AS company,
  CASE WHEN length(block) <= length({clean('title')}) + 10 THEN 'nowhere'
       WHEN contains(lower(block), 'und') THEN 'und' WHEN contains(lower(block), 'the') THEN 'the'
       WHEN contains(lower(block), 'de') THEN 'de' WHEN contains(lower(block), 'la') THEN 'la'
       ELSE 'nowhere' END AS location,
  CASE WHEN starts_with(href, '/') THEN 'https://jobs.example.com' || href ELSE href END AS posting_url,
  CAST(NULL AS VARCHAR) AS salary_text
FROM numbered JOIN blocks USING (page_id) WHERE {clean('title')} <> ''"""

ORACLE["payload_fields"] = f"""WITH {PAYLOADS}, fields AS (
  SELECT event_id, item_pos, {payload_chain('title', 'name', 'job_title', 'position')} AS raw_title,
    {payload_chain('url', 'link', 'posting_url', 'job_url')} AS u,
    {payload_chain('company', 'employer', 'affiliation', 'organisation', default='N/A')} AS raw_company,
    {payload_chain('location', 'city', 'location_name', default='Nairobi')} AS raw_location,
    {payload_chain('salary', 'salary_text', 'salary_range')} AS raw_salary
  FROM items WHERE json_type(it) = 'OBJECT')
SELECT event_id, item_pos, raw_title,
  CASE WHEN starts_with(u, 'http') THEN u ELSE 'https://www.brightermonday.co.ke' || u END AS raw_url,
  raw_company, raw_location, raw_salary
FROM fields WHERE raw_title IS NOT NULL AND u IS NOT NULL"""

ORACLE["union_fallback"] = """WITH tagged AS (
  SELECT event_id, user_id, event_type, CASE WHEN event_type = 'signup' AND user_id % 3 = 0 THEN 1
    WHEN event_type = 'click' AND user_id % 2 = 0 THEN 2 WHEN event_type = 'view' THEN 3 END AS method FROM events)
SELECT event_id, user_id, event_type FROM tagged WHERE method IS NOT NULL
QUALIFY method = min(method) OVER (PARTITION BY user_id)"""

ORACLE["merge_insert_new"] = f"""WITH {RAW_POSTINGS}, {EXISTING}
SELECT posting_url, min(seq) AS seq, arg_min(source, seq) AS source FROM raw_postings
WHERE posting_url NOT IN (SELECT posting_url FROM existing) GROUP BY posting_url"""

ORACLE["merge_insert_keys"] = ORACLE["merge_insert_new"]

ORACLE["dedup_last"] = f"""WITH {RAW_POSTINGS}
SELECT posting_url, seq, company, position FROM (
  SELECT posting_url, seq, company, min(seq) OVER (PARTITION BY posting_url) AS position,
    row_number() OVER (PARTITION BY posting_url ORDER BY seq DESC) AS r FROM raw_postings) WHERE r = 1"""

ORACLE["dedup_first"] = f"""WITH {RAW_POSTINGS}
SELECT posting_url, seq, company FROM raw_postings
QUALIFY row_number() OVER (PARTITION BY posting_url ORDER BY seq) = 1"""

ORACLE["union_sources"] = """SELECT event_id, user_id, value FROM events WHERE event_type = 'view'
UNION ALL SELECT event_id, NULL, value FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, user_id, NULL FROM events WHERE event_type = 'error'"""

ORACLE["run_log"] = f"""WITH {RAW_POSTINGS}, {EXISTING}, fresh AS (
  SELECT posting_url, arg_min(source, seq) AS source FROM raw_postings
  WHERE posting_url NOT IN (SELECT posting_url FROM existing) GROUP BY posting_url
), new_counts AS (SELECT lower(source) AS source, count(*) AS k FROM fresh GROUP BY 1)
SELECT b.source, b.found AS jobs_found, coalesce(k, 0) AS jobs_new, b.found - coalesce(k, 0) AS jobs_failed,
  'success' AS status, '2024-02-01 00:00:00' AS scrape_start, CAST(90.5 AS DOUBLE) AS duration_seconds
FROM (SELECT lower(source) AS source, count(*) AS found FROM raw_postings GROUP BY 1) b
LEFT JOIN new_counts USING (source)"""

ORACLE["run_log_events"] = f"""WITH e AS (
  SELECT user_id AS run_id, ts, event_id,
    CASE event_type WHEN 'signup' THEN 'partial' WHEN 'error' THEN 'failed' ELSE 'success' END AS status FROM events)
SELECT run_id, {stamp('min(ts)')} AS scrape_start,
  CASE WHEN arg_max(status, ts) <> 'partial' THEN {stamp('max(ts)')} END AS scrape_end,
  arg_max(status, ts) AS status, arg_max(event_id, ts) AS jobs_found
FROM e GROUP BY run_id"""

ORACLE["notification_log"] = f"""WITH {POSTINGS}, batch AS ({unnotified(2)})
SELECT 'team@example.com' AS recipient, count(*) || ' New Job Matches' AS subject, count(*) AS jobs_count,
  'sent' AS status, '2024-02-01 00:00:00' AS sent_at, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS job_ids
FROM batch"""

ORACLE["job_alerts"] = f"""WITH {EVENT_JOBS}
SELECT 'Job alert: job ' || id AS subject, CAST(1 AS BIGINT) AS jobs_count, id AS job_id
FROM ({unnotified(3, 'event_jobs')})"""

ORACLE["notify_once"] = f"""WITH {POSTINGS}
SELECT id, CAST(n AS INTEGER) AS keyword_match_count, posting_url FROM ({unnotified(2)})
WHERE NOT (scrape_timestamp < {AS_OF} - INTERVAL 100 DAY)"""

ORACLE["mark_notified"] = f"""WITH {EVENT_JOBS}, sent AS ({unnotified(3, 'event_jobs')})
SELECT id, is_notified OR id IN (SELECT id FROM sent) AS is_notified,
  CASE WHEN id IN (SELECT id FROM sent) THEN '2024-01-30 12:00:00' END AS notification_sent_at
FROM event_jobs"""

ORACLE["seed_dimension"] = """WITH dimension AS (
  SELECT event_type AS keyword, count(*) % 5 + 1 AS priority, 'event' AS category FROM events GROUP BY 1
), seed AS (
  SELECT DISTINCT lang AS keyword, CAST(1 AS BIGINT) AS priority, 'lang' AS category FROM documents
  UNION SELECT DISTINCT event_type, CAST(5 AS BIGINT), 'seed' FROM events)
SELECT * FROM dimension UNION ALL SELECT * FROM seed WHERE keyword NOT IN (SELECT keyword FROM dimension)"""

ORACLE["validate_rows"] = f"""WITH {FAULTY}, checked AS (
  SELECT id, list_filter([
    CASE WHEN coalesce(job_title, '') = '' THEN 'Missing required field: job_title' END,
    CASE WHEN coalesce(posting_url, '') = '' THEN 'Missing required field: posting_url' END,
    CASE WHEN coalesce(source, '') = '' THEN 'Missing required field: source' END,
    CASE WHEN coalesce(posting_url, '') <> '' AND NOT regexp_matches(posting_url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+')
      THEN 'Invalid posting URL' END,
    CASE WHEN source IS NULL OR source NOT IN {ALLOWED} THEN 'Invalid source: ' || coalesce(source, 'None') END
  ], lambda e: e IS NOT NULL) AS errors FROM faulty)
SELECT id, len(errors) = 0 AS valid, array_to_string(errors, '|') AS errors FROM checked"""

ORACLE["constraint_errors"] = f"""WITH {FAULTY}
SELECT id, array_to_string(list_filter([
    CASE WHEN job_title IS NULL THEN 'job_title is null' END,
    CASE WHEN length(job_title) > 500 THEN 'job_title is longer than 500' END,
    CASE WHEN length(company) > 300 THEN 'company is longer than 300' END,
    CASE WHEN posting_url IS NULL THEN 'posting_url is null' END,
    CASE WHEN length(posting_url) > 1000 THEN 'posting_url is longer than 1000' END,
    CASE WHEN source IS NULL THEN 'source is null' END,
    CASE WHEN source NOT IN {ALLOWED} THEN 'source is not an allowed value' END,
    CASE WHEN seq NOT BETWEEN 10 AND 900 THEN 'seq is not in 10..900' END
  ], lambda e: e IS NOT NULL), '|') AS errors FROM faulty"""

ORACLE["stored_record"] = f"""WITH {POSTINGS}
SELECT seq, md5(job_title) AS title_md5, company, posting_url, keywords AS keywords_matched,
  CAST(n AS BIGINT) AS keyword_match_count, '{{"lang":"' || lang || '"}}' AS metadata,
  strftime(posted_date, '%Y-%m-%d') AS posted_date FROM jobs"""

ORACLE["derived_columns"] = f"""WITH {EVENT_JOBS}
SELECT id, CAST(least(n, 3) AS BIGINT) AS keyword_match_count,
  CASE WHEN id % 4 = 1 THEN '2024-01-30 12:00:00' ELSE {stamp('scrape_timestamp')} END AS updated_at FROM event_jobs"""

ORACLE["recent_matched"] = f"""WITH {POSTINGS}
SELECT id, company, posting_url, keywords AS keywords_matched, CAST(n AS BIGINT) AS keyword_match_count,
  {stamp('scrape_timestamp')} AS scrape_timestamp, is_notified
FROM jobs WHERE is_active AND n > 0 AND scrape_timestamp > {AS_OF} - INTERVAL 7 DAY"""

ORACLE["new_with_keywords"] = f"""WITH {EVENT_JOBS}
SELECT id, company, source, CAST(n AS BIGINT) AS keyword_match_count, {stamp('scrape_timestamp')} AS scrape_timestamp
FROM event_jobs WHERE is_active AND n >= 2 AND scrape_timestamp >= {EVENTS_AS_OF} - INTERVAL 36 HOUR"""

ORACLE["by_source"] = f"""WITH {EVENT_JOBS}
SELECT id, company, source, is_active, {stamp('scrape_timestamp')} AS scrape_timestamp
FROM event_jobs WHERE source = 'click' AND scrape_timestamp >= {EVENTS_AS_OF} - INTERVAL 7 DAY"""

ORACLE["unnotified"] = f"""WITH {POSTINGS}
SELECT id, company, keywords AS keywords_matched, posting_url FROM ({unnotified(3)})"""

ORACLE["unnotified_brief"] = f"""WITH {POSTINGS}
SELECT id AS job_id, company, location, CAST(n AS BIGINT) AS keyword_match_count, posting_url FROM ({unnotified(1)})"""

ORACLE["keyword_search"] = f"""WITH {POSTINGS}
SELECT id AS job_id, company, keywords AS keywords_matched, posting_url
FROM jobs WHERE is_active AND list_has_any(ks, ['Rewh', 'License', 'Absent'])"""

ORACLE["keyword_search_lists"] = f"""WITH {POSTINGS}, changed AS (
  SELECT * REPLACE (CASE WHEN id % 4 = 1 THEN ['Rewh', 'New'] ELSE ks END AS ks) FROM jobs)
SELECT id AS job_id, company, array_to_string(ks, '|') AS keywords_matched, posting_url
FROM changed WHERE is_active AND list_has_any(ks, ['Rewh', 'License', 'Absent'])"""

ORACLE["sql_jobs_by_keywords"] = ORACLE["keyword_search"]
ORACLE["sql_unnotified"] = f"""WITH {POSTINGS}
SELECT id AS job_id, company, location, CAST(n AS BIGINT) AS keyword_match_count, posting_url FROM ({unnotified(1)})"""

ORACLE["sql_archive_and_logs"] = f"""WITH {RAW_POSTINGS}, changed AS (
  SELECT 'job' AS kind, scrape_timestamp AS stamped FROM raw_postings WHERE is_active AND scrape_timestamp < {AS_OF} - INTERVAL 90 DAY
  UNION ALL SELECT CASE WHEN event_id % 2 = 0 THEN 'run' ELSE 'notification' END, ts FROM events WHERE ts < {EVENTS_AS_OF} - INTERVAL 15 DAY)
SELECT kind, strftime(stamped, '%Y-%m-%d') AS day, count(*) AS n FROM changed GROUP BY ALL"""

ORACLE["sql_jobs_by_source"] = f"""WITH {RAW_POSTINGS}
SELECT id AS job_id, company, posting_url FROM raw_postings
WHERE source = 'src3' AND scrape_timestamp >= {AS_OF} - INTERVAL 60 DAY"""

ORACLE["keyword_match"] = ORACLE["keyword_match_join"] = f"""WITH texts AS (
  SELECT doc_id, lower(text) AS t FROM documents)
SELECT doc_id, unnest({keyword_list('t', SAMPLE)}) AS keyword FROM texts"""

ORACLE["keyword_score"] = f"WITH {POSTINGS}, {SCORES} SELECT id, keyword_score FROM scores"

ORACLE["keyword_score_join"] = (
    f"WITH {POSTINGS}, {SCORES} SELECT id, keyword_score FROM scores WHERE id IN (SELECT id FROM pairs)"
)

ORACLE["label_postings"] = f"""WITH {POSTINGS}, {SCORES}
SELECT id, keywords AS keywords_matched, CAST(n AS BIGINT) AS keyword_count, keyword_score
FROM jobs JOIN scores USING (id)"""

ORACLE["relabel"] = f"""WITH {POSTINGS}, {EVENT_JOBS}, base AS (
  SELECT id, array_to_string((['a', 'b', 'c'])[1:n], '|') AS k, n FROM event_jobs)
SELECT base.id, coalesce(jobs.keywords, base.k) AS keywords_matched,
  CAST(coalesce(jobs.n, base.n) AS BIGINT) AS keyword_match_count
FROM base LEFT JOIN jobs ON jobs.id = base.id"""

# Every separator is doubled, so that an occurrence never uses up its neighbour's boundary.
ORACLE["keyword_frequency"] = f"""WITH doubled AS (
  SELECT doc_id, regexp_replace(lower(text), '({NOT_WORD})', '\\1\\1', 'g') AS t FROM documents
), counts AS (""" + " UNION ALL ".join(
    f"SELECT doc_id, {text_literal(k)} AS keyword, len(regexp_extract_all(t, "
    + text_literal(
        f"(?:^|{NOT_WORD})(?:"
        + "|".join(
            "".join(c if c.isalnum() else c * 2 if c == " " else f"\\{c}" * 2 for c in v.lower())
            for v in forms
        )
        + f")(?:$|{NOT_WORD})"
    )
    + ")) AS n FROM doubled"
    for k, forms in SAMPLE.variants.items()
) + """)
SELECT doc_id, keyword, CAST(n AS BIGINT) AS occurrences FROM counts WHERE n > 0"""

ORACLE["keyword_context"] = f"""WITH words(keyword, variant) AS (VALUES {values(
    [(text_literal(k), text_literal(v.lower())) for k, forms in SINGLE_WORDS.variants.items() for v in forms]
)}), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[\\pL\\pN_]+|[^\\pL\\pN_]+')) AS run,
    generate_subscripts(regexp_extract_all(text, '[\\pL\\pN_]+|[^\\pL\\pN_]+'), 1) AS i
  FROM documents
), placed AS (
  SELECT doc_id, lower(run) AS variant, i, length(run) AS n,
    sum(length(run)) OVER (PARTITION BY doc_id ORDER BY i) - length(run) AS start FROM runs
), hits AS (
  SELECT doc_id, text, keyword, i, n, CAST(start AS BIGINT) AS s
  FROM placed JOIN words USING (variant) JOIN documents USING (doc_id))
SELECT doc_id, keyword, row_number() OVER (PARTITION BY doc_id, keyword ORDER BY i) - 1 AS occurrence,
  regexp_replace(regexp_replace(substring(text, greatest(s - 50, 0) + 1, s + n + 50 - greatest(s - 50, 0)), '^{SPACES}', ''), '{SPACES}$', '') AS context
FROM hits"""

ORACLE["skill_categories"] = ORACLE["skill_categories_join"] = f"""WITH {POSTINGS}, {CATEGORIES}
SELECT id, coalesce(category, 'other') AS category, string_agg(keyword, '|' ORDER BY keyword) AS keywords
FROM pairs LEFT JOIN categories USING (keyword) GROUP BY id, coalesce(category, 'other')"""

SUGGESTED = """suggested AS (
  SELECT DISTINCT pairs.id, pairings.suggested FROM pairs JOIN pairings USING (keyword)
  WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.id = pairs.id AND p.keyword = pairings.suggested))"""

ORACLE["skill_suggestions"] = f"""WITH {POSTINGS}, {PAIRINGS}, {SUGGESTED}
SELECT jobs.id, coalesce(string_agg(suggested, '|' ORDER BY suggested), '') AS suggested
FROM jobs LEFT JOIN suggested USING (id) GROUP BY jobs.id"""

ORACLE["skill_suggestions_join"] = f"WITH {POSTINGS}, {PAIRINGS}, {SUGGESTED} SELECT id, suggested FROM suggested"

ORACLE["daily_stats"] = f"""WITH {EVENT_JOBS}
SELECT strftime(CAST(scrape_timestamp AS DATE), '%Y-%m-%d') AS scrape_date, source, count(*) AS total_jobs,
  count(CASE WHEN n > 0 THEN 1 END) AS matched_jobs, avg(n) AS avg_keywords,
  count(CASE WHEN is_notified THEN 1 END) AS notified_jobs
FROM event_jobs WHERE scrape_timestamp > {EVENTS_AS_OF} - INTERVAL 30 DAY GROUP BY 1, 2"""

ORACLE["trending_keywords"] = f"""WITH {POSTINGS}
SELECT keyword, count(*) AS frequency, count(DISTINCT source) AS sources_count,
  {stamp('max(scrape_timestamp)')} AS last_seen
FROM pairs WHERE scrape_timestamp > {AS_OF} - INTERVAL 30 DAY GROUP BY keyword"""

ORACLE["trending_keywords_by_name"] = ORACLE["trending_keywords"]

ORACLE["company_stats"] = f"""WITH {POSTINGS}
SELECT company, count(*) AS total_postings, count(CASE WHEN n > 0 THEN 1 END) AS relevant_postings,
  {stamp('min(scrape_timestamp)')} AS first_seen, {stamp('max(scrape_timestamp)')} AS last_seen,
  array_to_string(list_sort(array_agg(DISTINCT source)), '|') AS job_boards
FROM jobs WHERE company IS NOT NULL AND scrape_timestamp > {AS_OF} - INTERVAL 60 DAY
GROUP BY company HAVING count(*) >= 2"""

ORACLE["global_stats"] = f"""WITH {EVENT_JOBS}
SELECT count(*) AS total_jobs, count(DISTINCT source) AS total_sources,
  count(CASE WHEN n > 0 THEN 1 END) AS jobs_with_keywords,
  count(CASE WHEN scrape_timestamp >= {EVENTS_AS_OF} - INTERVAL 24 HOUR THEN 1 END) AS jobs_last_24h,
  count(CASE WHEN scrape_timestamp >= {EVENTS_AS_OF} - INTERVAL 7 DAY THEN 1 END) AS jobs_last_7d,
  {stamp('max(scrape_timestamp)')} AS last_scrape, avg(n) AS avg_keyword_count
FROM event_jobs WHERE is_active"""

ORACLE["batch_analysis"] = f"""WITH {POSTINGS}, {SCORES}, counts AS (
  SELECT keyword, count(*) AS c FROM pairs GROUP BY keyword
), best AS (SELECT keyword, c FROM counts ORDER BY c DESC, keyword LIMIT 10)
SELECT count(*) AS total_jobs, avg(keyword_score) AS avg_score, max(keyword_score) AS max_score,
  min(keyword_score) AS min_score, (SELECT count(*) FROM counts) AS total_unique_keywords,
  avg(n) AS avg_keywords_per_job,
  (SELECT string_agg(keyword || ':' || c, '|' ORDER BY c DESC, keyword) FROM best) AS top_keywords
FROM jobs JOIN scores USING (id)"""

ORACLE["digest_summary"] = f"""WITH {POSTINGS}
SELECT count(*) AS total_jobs, CAST(sum(n) AS BIGINT) AS total_keywords,
  count(DISTINCT coalesce(company, '<none>')) AS companies, count(DISTINCT coalesce(source, '<none>')) AS sources
FROM ({unnotified(1)})"""

ORACLE["match_rate"] = f"""WITH {POSTINGS}
SELECT count(CASE WHEN n > 0 THEN 1 END) AS matched, count(*) AS processed FROM jobs"""

ORACLE["top_matches"] = f"""WITH {POSTINGS}
SELECT seq, source, array_to_string(ks[1:4], '|') AS keywords_shown FROM jobs ORDER BY n DESC, seq LIMIT 5"""

ORACLE["newest_unlabelled"] = f"""WITH {POSTINGS}
SELECT id, {stamp('scrape_timestamp')} AS scrape_timestamp, md5(job_title) AS title_md5, md5(full_description) AS text_md5 FROM jobs WHERE n = 0
ORDER BY jobs.scrape_timestamp DESC, id LIMIT 100"""

ORACLE["top_keywords"] = f"""WITH {POSTINGS}
SELECT keyword, count(*) AS n FROM pairs GROUP BY keyword ORDER BY n DESC, keyword LIMIT 10"""

ORACLE["digest_rank"] = f"""WITH {EVENT_JOBS}
SELECT id, row_number() OVER (ORDER BY n DESC, scrape_timestamp DESC, id) AS position
FROM ({unnotified(1, 'event_jobs')})"""

ORACLE["clean_text"] = f"""WITH c AS (SELECT doc_id, {clean('text')} AS c FROM documents)
SELECT doc_id, length(c) AS n, md5(c) AS cleaned_md5 FROM c"""

ORACLE["truncate_text"] = """WITH c AS (
  SELECT doc_id, CASE WHEN length(text) > 500 THEN substring(text, 1, 497) || '...' ELSE text END AS c FROM documents)
SELECT doc_id, length(c) AS n, md5(c) AS cut_md5 FROM c"""

SALARY_OFFERS = pick(
    "doc_id",
    [
        "'pay KES ' || doc_id || ',000 - kes ' || doc_id || ',500 per month'",
        "doc_id || ',000 - 9,999,999 KES'",
        "'Ksh. ' || doc_id || '  -  KSH ' || doc_id",
        "doc_id || '-' || doc_id || ' per  month'",
        "'Ksh ' || doc_id || ' to Ksh 75,000 or KES 1'",
        "'competitive'",
    ],
)
SALARY_FORMS = (
    r"(?i)KES\s*[\d,]+(?:\s*-\s*KES\s*[\d,]+)?",
    r"(?i)[\d,]+\s*-\s*[\d,]+\s*KES",
    r"(?i)Ksh\.?\s*[\d,]+(?:\s*-\s*Ksh\.?\s*[\d,]+)?",
    r"(?i)[\d,]+\s*-\s*[\d,]+\s*per\s+month",
)
ORACLE["extract_salary"] = f"""WITH offers AS (
  SELECT doc_id, text || ' ' || {SALARY_OFFERS} || ' ' || text AS t FROM documents
), hits AS (SELECT doc_id, coalesce({', '.join(f"nullif(regexp_extract(t, '{f}'), '')" for f in SALARY_FORMS)}) AS hit FROM offers)
SELECT doc_id, nullif({clean('hit')}, '') AS salary FROM hits"""

PLACES = pick(
    "doc_id",
    [
        "NULL", "''", "'Westlands, Nairobi County'", "'NAIROBI,  KENYA'", "'remote - kenya role'",
        "'Anywhere in Kenya'", "'Nairobi CBD & more'", "'Thika @ ' || lang", "'@@'", "text",
    ],
)
ORACLE["normalize_location"] = f"""WITH placed AS (SELECT doc_id, {PLACES} AS place FROM documents
), cleaned AS (SELECT *, {clean('place')} AS c FROM placed)
SELECT doc_id, md5(CASE WHEN coalesce(place, '') = '' THEN 'Kenya'
  WHEN contains(lower(c), 'nairobi, kenya') OR contains(lower(c), 'nairobi county') OR contains(lower(c), 'nairobi cbd') THEN 'Nairobi'
  WHEN contains(lower(c), 'remote - kenya') OR contains(lower(c), 'anywhere in kenya') THEN 'Remote (Kenya)'
  ELSE c END) AS location_md5 FROM cleaned"""

ORACLE["relative_date"] = f"WITH {date_texts()} SELECT event_id, {stamp(relative())} AS parsed FROM date_texts"
ORACLE["absolute_date"] = f"WITH {date_texts()} SELECT event_id, {stamp(ABSOLUTE)} AS parsed FROM date_texts"
ORACLE["parse_date"] = f"""WITH {date_texts()}, p AS (
  SELECT event_id, coalesce({relative()}, {ABSOLUTE}) AS d FROM date_texts)
SELECT event_id, {stamp('d')} AS parsed, {stamp(f'coalesce(d, {AS_OF})')} AS parsed_or_now FROM p"""

ORACLE["valid_url"] = f"""WITH {LINKS}
SELECT page_id, coalesce(regexp_matches(ltrim(link), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+'), false) AS valid FROM links"""

ORACLE["url_domain"] = f"""WITH {LINKS}
SELECT page_id, coalesce(regexp_extract(ltrim(link), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '') AS domain FROM links"""

FOLDER = "regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '[^/]*$', '')"
PARENT = f"regexp_replace({FOLDER}, '[^/]*/$', '')"
GRANDPARENT = f"regexp_replace({PARENT}, '[^/]*/$', '')"
ORACLE["absolute_url"] = "WITH r AS (SELECT *, " + ", ".join(
    [f"{ORIGIN} AS origin", f"{FOLDER} AS folder", f"{GRANDPARENT} AS grandparent"]
) + """ FROM pages)
SELECT page_id, """ + pick(
    "page_id",
    [
        "origin || '/abs/' || page_id",
        "origin || coalesce(nullif(folder, ''), '/') || 'rel/' || page_id || '?a=1'",
        "origin || coalesce(nullif(grandparent, ''), '/') || 'up/' || page_id",
        "regexp_extract(url, '^([a-z]+:)', 1) || '//other.org/' || page_id",
        "regexp_extract(url, '^([^?#]*)', 1) || '?q=' || page_id",
        "regexp_extract(url, '^([^#]*)', 1) || '#f' || page_id",
        "url",
        "'https://x.org/' || page_id",
    ],
) + " AS absolute FROM r"

TITLE_ENDINGS = pick("doc_id", ["' at Company ' || doc_id", "''", "' at Large at ' || doc_id", "' attached'"])
LOGOS = pick("doc_id", ["NULL", "'Acme logo'", "''", "NULL", "'Beta Logo '"])
ORACLE["split_title"] = f"""WITH titles AS (
  SELECT doc_id, split_part(text, chr(10), 1) || {TITLE_ENDINGS} AS t, {LOGOS} AS alt FROM documents
), parts AS (
  SELECT *, contains(t, ' at ') AS has_both, regexp_extract(t, '(?s)^(.*) at (.*)$', 1) AS head,
    regexp_extract(t, '(?s)^(.*) at (.*)$', 2) AS tail FROM titles)
SELECT doc_id, md5(CASE WHEN has_both THEN trim(head) ELSE t END) AS title_md5,
  CASE WHEN coalesce(alt, '') <> '' THEN trim(replace(replace(trim(alt), ' logo', ''), ' Logo', ''))
    ELSE coalesce(CASE WHEN has_both THEN nullif(trim(tail), '') END, 'N/A') END AS company
FROM parts"""

ORACLE["first_city"] = """SELECT doc_id, CASE WHEN contains(lower(text), 'rewh') THEN 'Rewh'
  WHEN contains(lower(text), 'thatin') THEN 'Thatin' WHEN contains(lower(text), 'mit') THEN 'MIT'
  WHEN contains(lower(text), 'von') THEN 'von' WHEN contains(lower(text), 'que') THEN 'Que' ELSE 'none' END AS city
FROM documents"""

ORACLE["alias_chain"] = """SELECT event_id, coalesce(CASE WHEN event_id % 3 = 2 THEN event_type END,
  CASE WHEN user_id % 3 = 1 THEN props END, 'N/A') AS chosen FROM events"""

ORACLE["archive_old"] = f"""WITH {RAW_POSTINGS}
SELECT id, is_active AND NOT scrape_timestamp < {AS_OF} - INTERVAL 90 DAY AS is_active FROM raw_postings"""

ORACLE["retain_logs"] = f"""SELECT event_id, event_type FROM events
WHERE NOT ts < {EVENTS_AS_OF} - INTERVAL 15 DAY"""

ORACLE["incremental_cycle"] = f"""WITH {FAULTY}, {EXISTING}, good AS (
  SELECT * FROM faulty WHERE coalesce(job_title, '') <> '' AND source IN {ALLOWED}
    AND regexp_matches(posting_url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+')
), latest AS (
  SELECT *, min(seq) OVER (PARTITION BY source, posting_url) AS position FROM good
  QUALIFY row_number() OVER (PARTITION BY source, posting_url ORDER BY seq DESC) = 1
), fresh AS (
  SELECT * FROM latest WHERE length(job_title) <= 500 AND posting_url NOT IN (SELECT posting_url FROM existing)
  QUALIFY row_number() OVER (PARTITION BY posting_url ORDER BY position) = 1
), labelled AS (
  SELECT *, {keyword_list("lower(job_title || ' ' || full_description)", SAMPLE)} AS ks FROM fresh)
SELECT posting_url, source, md5(job_title) AS title_md5, array_to_string(ks, '|') AS keywords_matched,
  CAST(len(ks) AS BIGINT) AS keyword_match_count, true AS is_active, '2024-02-01 00:00:00' AS created_at
FROM labelled"""

ORACLE["stored_cycle"] = f"""WITH {POSTINGS}, good AS (
  SELECT * FROM jobs WHERE length(job_title) <= 500
), first_run AS (
  SELECT *, TIMESTAMP '2023-07-16 00:00:00' AS created FROM good WHERE id % 2 = 0
  QUALIFY row_number() OVER (PARTITION BY posting_url ORDER BY seq) = 1
), second_run AS (
  SELECT *, {AS_OF} AS created FROM good WHERE posting_url NOT IN (SELECT posting_url FROM first_run)
  QUALIFY row_number() OVER (PARTITION BY posting_url ORDER BY seq) = 1
), stored AS (SELECT * FROM first_run UNION ALL SELECT * FROM second_run)
SELECT posting_url, created = {AS_OF} AS is_active, n >= 2 AS is_notified, CAST(n AS BIGINT) AS keyword_match_count,
  {stamp('created')} AS created_at, CASE WHEN n >= 2 THEN {stamp('created')} END AS notification_sent_at
FROM stored"""

ORACLE["page_containers"] = f"""WITH {ANCHORS}, navs AS (
  SELECT page_id, titles[1] AS title, hrefs[1] AS href,
    array_to_string(list_transform(titles, lambda x: trim(x)), '') AS listed
  FROM found WHERE len(hrefs) > 0)
SELECT page_id, {clean('title')} AS job_title, 'N/A' AS company, 'nowhere' AS location,
  'https://jobs.example.com' || href AS posting_url,
  CASE WHEN length({clean('listed')}) > 500 THEN substring({clean('listed')}, 1, 497) || '...' ELSE {clean('listed')} END
    AS description_snippet, '2024-02-01 00:00:00' AS posted_date
FROM navs WHERE {clean('title')} <> ''"""

ORACLE["payload_postings"] = f"""WITH fields AS ({ORACLE['payload_fields']})
SELECT event_id, {clean('raw_title')} AS job_title, {clean('raw_company')} AS company,
  {clean('raw_location')} AS location, raw_url AS posting_url, 'BrighterMonday' AS source,
  nullif({clean('raw_salary')}, '') AS salary_text, CAST(NULL AS VARCHAR) AS description_snippet,
  CAST(NULL AS VARCHAR) AS posted_date
FROM fields"""

ORACLE["union_fallback_overall"] = "SELECT event_id, event_type FROM events WHERE event_type = 'signup'"

ORACLE["keyword_match_cased"] = f"SELECT doc_id, unnest({keyword_list('text', CASED)}) AS keyword FROM documents"

OTHER_FAULTY = f"""{FAULTY}, other AS (SELECT * REPLACE (CASE WHEN source IS NOT NULL THEN 'Other' END AS source) FROM faulty), checked AS (
  SELECT *, list_filter([
    CASE WHEN coalesce(job_title, '') = '' THEN 'Missing required field: job_title' END,
    CASE WHEN coalesce(posting_url, '') = '' THEN 'Missing required field: posting_url' END,
    CASE WHEN source IS NULL THEN 'Missing required field: source' END,
    CASE WHEN coalesce(posting_url, '') <> '' AND NOT regexp_matches(posting_url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+')
      THEN 'Invalid posting URL' END,
    CASE WHEN source IS NULL THEN 'Invalid source: None' END
  ], lambda e: e IS NOT NULL) AS errors FROM other)"""

ORACLE["cycle_run_log"] = f"""WITH {OTHER_FAULTY}, latest AS (
  SELECT * FROM checked WHERE len(errors) = 0 QUALIFY row_number() OVER (PARTITION BY posting_url ORDER BY seq DESC) = 1
), rows AS (
  SELECT id % 2 AS odd, 1 AS found, 0 AS new, CAST(len(errors) > 0 AS INTEGER) AS failed FROM checked
  UNION ALL SELECT id % 2, 0, CAST(length(job_title) <= 500 AS INTEGER), CAST(length(job_title) > 500 AS INTEGER) FROM latest)
SELECT CASE odd WHEN 1 THEN 'odd' ELSE 'even' END AS source, 'success' AS status, sum(found)::BIGINT AS jobs_found, sum(new)::BIGINT AS jobs_new,
  sum(failed)::BIGINT AS jobs_failed, false AS has_error FROM rows GROUP BY odd
UNION ALL SELECT 'empty', 'success', 0, 0, 0, false
UNION ALL SELECT 'broken', 'failed', 0, 0, 0, true"""

ORACLE["cycle_rejected"] = f"""WITH {OTHER_FAULTY}
SELECT id, array_to_string(errors, '|') AS errors, md5(full_description) AS text_md5 FROM checked WHERE len(errors) > 0"""

for _view in ("daily_stats", "trending_keywords", "company_stats", "global_stats"):
    ORACLE[f"summarised_{_view}"] = ORACLE[_view]
