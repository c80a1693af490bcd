"""Oracle SQL, part 2: templates, sources and sinks, joins, ordered, aggregates, outcomes."""

from quarry import params as P
from quarry import sqlrender as R
from quarry.operators.rules import REASON_LABELS
from quarry.plans import queries as Q
from quarry.sources.specs import TEMPLATE_FIELDS, TEMPLATE_WIDTH

AS_OF = f"DATE '{Q.FIXTURE.as_of_str}'"
FL = "split_part(text, chr(10), 1)"


def _ctes():
    import oracle_queries as O
    return O.ARTICLES, O.AGENCIES, O.TARGET_PR


def templates_cte():
    rows = ", ".join(f"({i}, {R.lit(k)}, {R.lit(line)})" for i, (k, line) in enumerate(Q.fixture_templates()))
    return f"tpl(prio, keyword, template) AS (VALUES {rows})"


def labels_cte():
    rows = ", ".join(f"({R.lit(k)}, {R.lit(v)})" for k, v in sorted(REASON_LABELS.items()))
    return f"labels(reason, label) AS (VALUES {rows})"


def x2_cte():
    import oracle_queries as O
    return f"x2 AS ({O.press_release_sql(Q.FIXTURE.keyword_skips)})"


def comment_pages_cte():
    return """comment_pages AS (
  SELECT '/comment/AG-' || CAST(user_id AS VARCHAR) || '-' || CAST(event_id AS VARCHAR) AS url, doc_id AS pdf_id, event_id AS for_event,
         CASE WHEN doc_id % 9 = 0 THEN NULL ELSE split_part(text, chr(10), 1) END AS pdf_title,
         CASE WHEN doc_id % 10 = 0 THEN NULL ELSE 'https://downloads.example.gov/' || CAST(doc_id AS VARCHAR) || '.pdf' END AS download
  FROM events JOIN documents ON event_id % (SELECT max(doc_id) + 1 FROM documents) = doc_id)"""


def cards_cte(from_pages=False):
    """``from_pages``: cards as read from the list pages, where every seventh has no link and so no title."""
    some = "CASE WHEN event_id % 7 <> 0 THEN " if from_pages else "("
    end = " END" if from_pages else ")"
    rej = R.first_contained("title", Q.FIXTURE.title_reject, case_sensitive=False)
    return f"""cards AS (
  SELECT ts, event_id, user_id, 'AG-' || CAST(user_id AS VARCHAR) || '-' || CAST(event_id AS VARCHAR) AS id,
         {some}event_type{end} AS title, {some}'/comment/AG-' || CAST(user_id AS VARCHAR) || '-' || CAST(event_id AS VARCHAR){end} AS link,
         strftime(ts, '%b %-d, %Y') AS posted FROM events),
rules AS (
  SELECT *, {rej} AS phrase, CAST(try_strptime(posted, '%b %d, %Y') AS DATE) AS posted_date FROM cards)"""


def sql():
    A, G, TP = _ctes()
    q = {}
    kw = ", ".join(f"({i}, {R.lit(k)})" for i, (k, _) in enumerate(Q.fixture_templates()))
    match = "(SELECT keyword FROM tpl WHERE contains(url, keyword) ORDER BY prio LIMIT 1)"
    q["J3_template_match"] = f"WITH {templates_cte()} SELECT page_id, {match} AS keyword FROM pages"
    q["F2_has_template"] = f"WITH {templates_cte()} SELECT page_id, CASE WHEN {match} IS NULL THEN 'no_template' ELSE 'ok' END AS reason FROM pages"
    tmatch = "(SELECT template FROM tpl WHERE contains(url, keyword) ORDER BY prio LIMIT 1)"
    fields = ", ".join(f"parts[{i + 4}] AS {f}" for i, f in enumerate(TEMPLATE_FIELDS))
    q["P2_template_fields"] = f"""WITH {templates_cte()},
m AS (SELECT page_id, string_split({tmatch}, ',') AS parts FROM pages WHERE {tmatch} IS NOT NULL)
SELECT page_id, {fields},
       CAST(coalesce(parts[{TEMPLATE_FIELDS.index('landing_page_gathering') + 4}] = 'True', FALSE) AS INTEGER) AS landing_flag,
       CAST(coalesce(parts[{TEMPLATE_FIELDS.index('bypass') + 4}] <> '', FALSE) AS INTEGER) AS bypass_flag,
       CAST(coalesce(contains(parts[{TEMPLATE_FIELDS.index('journal_containers') + 4}], 'find_all'), FALSE) AS INTEGER) AS multi_issue,
       CASE WHEN len(parts) < {TEMPLATE_WIDTH} THEN 'csv_line' ELSE 'ok' END AS reason FROM m"""
    names = "[" + ", ".join(R.lit(f) for f in Q.SPEC_FIELDS) + "]"
    vals = "[" + ", ".join(f"parts[{TEMPLATE_FIELDS.index(f) + 4}]" for f in Q.SPEC_FIELDS) + "]"

    def num(i):
        return f"CASE WHEN contains(p[{i}], 'None') THEN NULL ELSE try_cast(p[{i}] AS INTEGER) END"

    bad = " OR ".join(f"(p[{i}] IS NOT NULL AND NOT contains(p[{i}], 'None') AND try_cast(p[{i}] AS INTEGER) IS NULL)" for i in (4, 5, 6))
    q["S3_parse_specs"] = f"""WITH {templates_cte()},
m AS (SELECT page_id, string_split({tmatch}, ',') AS parts FROM pages WHERE {tmatch} IS NOT NULL),
lng AS (SELECT page_id, unnest({names}) AS field, unnest({vals}) AS spec FROM m),
a AS (SELECT page_id, field, unnest(string_split(spec, '<>')) AS alt_text, generate_subscripts(string_split(spec, '<>'), 1) - 1 AS alt FROM lng WHERE spec <> ''),
s AS (SELECT page_id, field, alt, unnest(string_split(alt_text, '~')) AS step_text, generate_subscripts(string_split(alt_text, '~'), 1) - 1 AS step FROM a),
pp AS (SELECT *, string_split(step_text, '|') AS p FROM s)
SELECT page_id, field, alt, step, p[1] AS mode, p[2] AS kind, p[3] AS name, {num(4)} AS i1, {num(5)} AS i2, {num(6)} AS i3,
       CASE WHEN len(p) < 3 OR len(p) > 6 OR {bad} THEN 'csv_line' WHEN len(p) > 3 AND p[1] <> 'find_all' THEN 'csv_line' END AS reason
FROM pp"""
    q["S1_read_site_config"] = """
SELECT page_id AS id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS name,
       CASE WHEN page_id % 3 <> 0 THEN url || '|' || regexp_extract(url, '^(https?://[^/?#]+)', 1) ELSE url END AS url_field
FROM pages"""
    from quarry.functions.text import LATIN1_KEEP
    latin = R.lit(LATIN1_KEEP)
    q["S4_read_agencies"] = f"""
SELECT CAST(c_custkey AS VARCHAR) AS a_id, c_name AS filename, regexp_replace(c_mktsegment || ' DATE', {latin}, '?', 'g') AS lede, n_name AS uname
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name LIKE 'NATION_1%'"""
    q["S5_to_latin1"] = f"SELECT doc_id, regexp_replace(text, {latin}, '?', 'g') AS text FROM documents"
    q["S6_read_pages"] = """
SELECT page_id, url, CASE WHEN html IS NULL OR length(html) = 0 THEN 'landing_page_html_is_none' ELSE 'ok' END AS reason,
       CAST(coalesce(length(html), 0) AS BIGINT) AS n_chars FROM pages"""
    q["S7_read_pdf_pages"] = """
SELECT doc_id AS id, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS BIGINT) AS page_no, unnest(string_split(text, chr(10))) AS text FROM documents"""
    q["S8_existing_keys"] = f"WITH {A}, {G}, {TP} SELECT DISTINCT filename FROM target_press_release"
    q["S9_append_press_release"] = f"""WITH {x2_cte()}
SELECT filename, headline, content_date, CAST(a_id AS BIGINT) AS a_id, box, story_txt, '' AS uname, '{Q.FIXTURE.as_of_str}' AS date_sent
FROM x2 WHERE reason = 'loaded'"""
    q["S11_write_text"] = f"""WITH {x2_cte()}
SELECT filename, story_txt AS article_body, content_date FROM x2 WHERE reason = 'loaded'"""
    q["J1_agency_group_join"] = """
SELECT CAST(c_custkey AS VARCHAR) AS a_id, c_name AS filename, n_name AS uname
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name LIKE 'NATION_1%'"""
    q["J2_lookup"] = """
WITH dim AS (SELECT CAST(c_custkey AS VARCHAR) AS a_id, max(c_name) AS filename FROM customer GROUP BY 1)
SELECT o_orderkey, filename, CASE WHEN filename IS NULL THEN 'no_lede' ELSE 'ok' END AS reason
FROM orders LEFT JOIN dim ON CAST(o_custkey AS VARCHAR) = dim.a_id"""
    q["J4_not_already_stored"] = f"""WITH {A}, {G}, {TP},
f AS (SELECT a.id, '$H ' || g.filename || strftime(a.date, '%y%m%d') || right(a.head, 10) AS filename
      FROM articles a LEFT JOIN agencies g ON a.a_id = g.a_id)
SELECT id, filename FROM f WHERE filename IS NOT NULL AND filename NOT IN (SELECT filename FROM target_press_release)"""
    q["J5_insert_if_absent"] = "SELECT doc_id, CAST(doc_id <> min(doc_id) OVER (PARTITION BY text) AS INTEGER) AS is_duplicate FROM documents"
    q["J6_follow_links"] = f"""WITH {comment_pages_cte()}
SELECT event_id, CAST(p.pdf_id IS NOT NULL AS INTEGER) AS has_page, p.pdf_id
FROM events e LEFT JOIN comment_pages p ON '/comment/AG-' || CAST(e.user_id AS VARCHAR) || '-' || CAST(e.event_id AS VARCHAR) = p.url"""
    q["J7_reply_join"] = """
SELECT u.conv_id, u.turn, r.text AS reply
FROM (SELECT * FROM conversations WHERE role = 'user') u
LEFT JOIN (SELECT * FROM conversations WHERE role = 'assistant') r ON u.conv_id = r.conv_id AND u.turn = r.turn - 1"""
    q["O1_newest_first"] = "SELECT event_id, row_number() OVER (ORDER BY ts DESC, event_id DESC) AS pos FROM events"
    q["O2_doc_limit"] = "SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 100"
    stop = f"link IS NOT NULL AND phrase IS NULL AND NOT coalesce(date_diff('day', posted_date, {AS_OF}) BETWEEN 0 AND {Q.FIXTURE.days_back}, FALSE)"
    q["O3_stop_at_first_old"] = f"""WITH {cards_cte()},
cut AS (SELECT ts, event_id FROM rules WHERE {stop} ORDER BY ts DESC, event_id DESC LIMIT 1)
SELECT event_id FROM rules WHERE NOT EXISTS (SELECT 1 FROM cut)
   OR (SELECT (rules.ts > cut.ts) OR (rules.ts = cut.ts AND rules.event_id > cut.event_id) FROM cut)"""
    q["O4_stop_after_n_invalid"] = f"""
WITH d AS (SELECT user_id AS journal, event_id, event_type = 'error' AS invalid,
                  coalesce(sum(CAST(event_type = 'error' AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM events)
SELECT journal, event_id, CAST(before < {Q.FIXTURE.invalid_limit} AS INTEGER) AS looked_at,
       CAST(before < {Q.FIXTURE.invalid_limit} AND NOT invalid AS INTEGER) AS accepted FROM d"""
    phr = ", ".join(R.lit(x) for x in Q.FIXTURE.abstract_phrases)
    q["O5_first_k_per_issue"] = f"""
SELECT user_id, event_id, rank FROM (
  SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank
  FROM events WHERE lower(trim(event_type)) IN ({phr})) WHERE rank <= {Q.FIXTURE.abstracts_per_issue}"""
    q["O7_paginate"] = f"""WITH {cards_cte()},
pg AS (SELECT *, date_diff('day', CAST(ts AS DATE), {AS_OF}) + 1 AS page_no FROM rules),
capped AS (SELECT * FROM pg WHERE page_no <= {P.PAGE_CAP}),
cut AS (SELECT page_no, ts, event_id FROM capped WHERE {stop} ORDER BY page_no, ts DESC, event_id DESC LIMIT 1)
SELECT event_id, CAST(page_no AS BIGINT) AS page_no FROM capped c WHERE NOT EXISTS (SELECT 1 FROM cut)
   OR (SELECT (c.page_no < cut.page_no) OR (c.page_no = cut.page_no AND ((c.ts > cut.ts) OR (c.ts = cut.ts AND c.event_id > cut.event_id))) FROM cut)"""
    q["A1_join_texts"] = "SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS text FROM conversations GROUP BY conv_id"
    q["A2_concat_pages"] = """
SELECT doc_id AS id, string_agg(line || chr(10), '' ORDER BY page_no) AS text
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS page_no FROM documents)
WHERE length(line) > 0 GROUP BY doc_id"""
    q["A4_reason_counts"] = f"WITH {x2_cte()} SELECT reason, count(*) AS n FROM x2 GROUP BY reason"
    q["A5_reason_details"] = f"WITH {x2_cte()}, {labels_cte()} SELECT x2.reason, detail, label FROM x2 LEFT JOIN labels ON x2.reason = labels.reason"
    q["A6_run_metrics"] = f"""WITH {x2_cte()}
SELECT count(*) FILTER (WHERE reason = 'loaded') AS loaded, count(*) FILTER (WHERE reason <> 'not_reached') AS looked_at,
       count(*) FILTER (WHERE reason = 'duplicate') AS duplicates, count(*) FILTER (WHERE reason = 'no_lede') AS no_lede,
       count(*) AS records FROM x2"""
    acc = R.lit("[a-zA-Z0-9\\t\\n\\x0B\\f\\r\\x1C-\\x1F `~!@#$%^&*()_+\\-={}|:;<>?,./\\\\\"'\\[\\]]")
    q["A8_bad_characters"] = f"SELECT doc_id, regexp_replace({R.fold('text', 'T1')}, {acc}, '', 'g') AS bad FROM documents"
    kwl = R.first_contained("text", Q.FIXTURE.keyword_skips)
    q["E1_first_failing_rule"] = f"""
SELECT doc_id, CASE WHEN NOT (string_split(text, chr(10))[-1] IS NOT NULL AND length(string_split(text, chr(10))[-1]) > 0) THEN 'description_is_none'
  WHEN {kwl} IS NOT NULL THEN 'keyword' WHEN NOT length(text) > 100 THEN 'too_short' ELSE 'loaded' END AS reason FROM documents"""
    q["E2_reason_labels"] = f"WITH {x2_cte()}, {labels_cte()} SELECT c.reason, label, n FROM (SELECT reason, count(*) AS n FROM x2 GROUP BY reason) c LEFT JOIN labels l ON c.reason = l.reason"
    q["E3_write_outcome"] = f"""WITH {A}
SELECT id, CASE WHEN try_cast(CASE WHEN id % 50 = 0 THEN 'x' || a_id ELSE a_id END AS INTEGER) IS NULL THEN 'rejected'
  ELSE 'loaded' END AS outcome FROM articles"""
    return q
