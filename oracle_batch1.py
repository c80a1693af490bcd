"""Oracle SQL, part 1: projections, text, dates, filters."""

from quarry import params as P
from quarry import sqlrender as R
from quarry.plans.queries import FIXTURE

AS_OF = f"DATE '{FIXTURE.as_of_str}'"
FL = "split_part(text, chr(10), 1)"
HOST = "regexp_extract(url, '^(https?://[^/?#]+)', 1)"


def _articles():
    from oracle_queries import ARTICLES
    return ARTICLES


def _agencies():
    from oracle_queries import AGENCIES
    return AGENCIES


def date_texts_cte():
    mon = "CASE WHEN month(d) = 9 THEN 'Sept' ELSE strftime(d, '%b') END"
    return f"""date_texts AS (
  SELECT o_orderkey, CASE o_orderkey % 6
    WHEN 0 THEN '(' || lower(strftime(d, '%b')) || ') ' || CAST(year(d) AS VARCHAR)
    WHEN 1 THEN {mon} || ' ' || CAST(day(d) AS VARCHAR) || ',  ' || CAST(year(d) AS VARCHAR)
    WHEN 2 THEN 'Volume 3, ' || strftime(d, '%B %Y') || ', Issue 2'
    WHEN 3 THEN CAST(day(d) AS VARCHAR) || ' ' || strftime(d, '%B') || ' ' || CAST(year(d) AS VARCHAR)
    WHEN 4 THEN strftime(d, '%Y-%m-%d')
    ELSE 'no date here' END AS date_text
  FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders))"""


def replies_cte():
    return "replies AS (SELECT conv_id, turn, text AS reply FROM conversations WHERE role = 'assistant')"


def prompt_sql():
    from quarry.operators.model_io import COMMENT_PROMPT
    return f"replace({R.lit(COMMENT_PROMPT)}, '%s', strftime({AS_OF}, '%B, %-d'))"


def split_reply(expr):
    # Spark split(r, '\n', 2): first piece and the rest (null without newline)
    head = f"CASE WHEN strpos({expr}, chr(10)) > 0 THEN substr({expr}, 1, strpos({expr}, chr(10)) - 1) ELSE {expr} END"
    rest = f"CASE WHEN strpos({expr}, chr(10)) > 0 THEN substr({expr}, strpos({expr}, chr(10)) + 1) END"
    return head, rest


def story_body(rest, link):
    from quarry.functions.text import WS
    return (f"regexp_replace({rest}, {R.lit('^' + WS + '+')}, '', 'g') || chr(10) || chr(10) || '***' || chr(10) || chr(10) "
            f"|| 'Read full text of letter here: ' || {link}")


def sql():
    q = {}
    q["P1_split_url_field"] = f"""
SELECT page_id, string_split(f, '|')[1] AS full_url, coalesce(string_split(f, '|')[2], '') AS prefix
FROM (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url || '|' || {HOST} ELSE url END AS f FROM pages)"""
    q["P5_resolve_link"] = f"""
SELECT page_id, n, prefix || {R.strip_py('href')} AS link, CASE WHEN contains(href, 'lww') THEN href ELSE prefix || href END AS abstract_link
FROM (SELECT page_id, {HOST} AS prefix, unnest(l) AS href, generate_subscripts(l, 1) - 1 AS n
      FROM (SELECT page_id, url, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages))"""
    q["P6_truncate_columns"] = f"""
SELECT doc_id, left({FL}, {P.HEADLINE_MAX}) AS headline, left(text, {P.PDF_TITLE_MAX}) AS pdf_title,
       CAST(length(left(text, {P.ORIG_TEXT_MAX})) AS BIGINT) AS orig_len, left(text, {P.POST_SIGNER_MAX}) AS post_signer
FROM documents"""
    q["P7_article_filename"] = f"""
WITH {_articles()}, {_agencies()}
SELECT a.id, '$H ' || g.filename || strftime(a.date, '%y%m%d') || right(a.head, 10) AS filename
FROM articles a LEFT JOIN agencies g ON a.a_id = g.a_id"""
    q["P8_comment_filename"] = """
SELECT event_id, '$H-PUBCOM-' || split_part('AG-' || CAST(user_id AS VARCHAR) || '-' || CAST(event_id AS VARCHAR), '-', 1)
       || left(event_type, 85) AS filename FROM events"""
    q["P9_post_headline"] = f"""
WITH {_articles()}
SELECT id, 'The ' || journal_name || ' posted research article in ''' || head || '''' AS post_headline FROM articles"""
    q["P10_article_body"] = f"""
WITH {_articles()}
SELECT id, chr(10) || 'WASHINGTON, ' || strftime({AS_OF}, '%b. %d') || ' -- '
       || 'The ' || journal_name || ' posted research article in ''' || head || '''' || ':' || chr(10) || '*' || chr(10)
       || array_to_string(abstract_texts, ' ') || chr(10) || chr(10) || '***' || chr(10) || chr(10)
       || 'Original text here: ' || url AS body FROM articles"""
    head, rest = split_reply("reply")
    link = f"'{P.COMMENT_HOST}/comment/CV' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR)"
    q["P11_story_body"] = f"WITH {replies_cte()} SELECT conv_id, turn, {story_body(f'({rest})', link)} AS body FROM replies"
    q["P12_orig_text"] = f"""
SELECT doc_id, left(text, {P.ORIG_TEXT_MAX}) || chr(10) || chr(10) || ' *** Prompt Below *** ' || chr(10) || chr(10) || {prompt_sql()} AS orig_txt
FROM documents"""
    months = "[" + ", ".join(R.lit(m) for m in __import__("quarry.functions.text", fromlist=["AP_MONTHS"]).AP_MONTHS) + "]"
    q["P13_ap_dateline"] = f"""
SELECT o_orderkey, replace(c_mktsegment || ' DATE', 'DATE', {months}[month(CAST(o_orderdate AS DATE))] || ' ' || CAST(day(CAST(o_orderdate AS DATE)) AS VARCHAR)) AS lede
FROM orders JOIN customer ON o_custkey = c_custkey"""
    q["T1_ascii_fold"] = f"SELECT doc_id, {R.fold('text', 'T1')} AS text FROM documents"
    q["T2_transliterate"] = f"SELECT doc_id, {R.fold('text', 'T2')} AS text FROM documents"
    q["T3_strip_boilerplate"] = f"SELECT doc_id, {R.strip_boilerplate('text')} AS text FROM documents"
    q["T4_drop_headline"] = f"SELECT doc_id, CASE WHEN length({FL}) > 0 THEN replace(text, {FL}, '') ELSE text END AS text FROM documents"
    q["T5_normalise_whitespace"] = f"SELECT doc_id, {R.normalise_whitespace('text')} AS text FROM documents"
    post, phrase = R.signer_split("text", FIXTURE.signers)
    q["T6_signer_split"] = f"SELECT doc_id, {post} AS post_signer, {phrase} AS signer FROM documents"
    q["T7_route_box"] = f"SELECT doc_id, CASE WHEN {post} IS NOT NULL OR contains(text, 'coalition') THEN 'E' ELSE 'D' END AS box FROM documents"
    q["T8_split_reply"] = f"WITH {replies_cte()} SELECT conv_id, turn, {head} AS headline, {rest} AS rest FROM replies"
    q["T9_signer_comment"] = f"""SELECT doc_id, CASE WHEN {post} IS NOT NULL THEN 'Signer phrase found: ' || {phrase} || chr(10)
       || 'Post Signer Text:' || chr(10) || chr(10) || {post} ELSE '' END AS comment FROM documents"""
    q["D1_clean_date_text"] = f"WITH {date_texts_cte()} SELECT o_orderkey, {R.clean_date_text('date_text')} AS cleaned FROM date_texts"
    q["D2_comma_field_date"] = f"WITH {date_texts_cte()} SELECT o_orderkey, string_split({R.clean_date_text('date_text')}, ',')[2] AS field FROM date_texts"
    q["D3_comma_pp_title"] = f"""SELECT doc_id, split_part(CASE WHEN doc_id % 2 = 0 THEN {FL} || ', pp 12-14' ELSE {FL} END, ', pp', 1) AS title FROM documents"""
    cleaned = R.clean_date_text("date_text")
    stepped = f"replace(replace({cleaned}, 'volume 3', ''), 'issue 2', '')"
    q["D4_formatting_steps"] = f"WITH {date_texts_cte()} SELECT o_orderkey, strftime({R.parse_date(stepped)}, '%Y-%m-%d') AS date FROM date_texts"
    q["D5_parse_date"] = f"WITH {date_texts_cte()} SELECT o_orderkey, strftime({R.parse_date(cleaned)}, '%Y-%m-%d') AS date FROM date_texts"
    q["D6_parse_posted"] = """
SELECT event_id, strftime(CAST(try_strptime(trim(CASE WHEN event_id % 13 = 0 THEN strftime(ts, '%B %-d, %Y') ELSE strftime(ts, '%b %-d, %Y') END), '%b %d, %Y') AS DATE), '%Y-%m-%d') AS posted_date
FROM events"""
    q["D7_format_dates"] = """
SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS iso, strftime(d, '%B %Y') AS month_year,
       strftime(d, '%b. %d') AS dateline, strftime(d, '%B, %-d') AS prompt_date
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)"""
    q["F3_title_reject"] = f"SELECT doc_id, {R.first_contained(FL, ('anonymous', 'THE', 'W-', 'ére'), case_sensitive=False)} AS phrase FROM documents"
    q["F4_keyword_skip"] = f"SELECT doc_id, {R.first_contained('text', FIXTURE.keyword_skips)} AS word FROM documents"
    phr = ", ".join(R.lit(x) for x in FIXTURE.abstract_phrases)
    q["F5_phrase_allow"] = f"SELECT event_id, CAST(lower(trim('  ' || upper(event_type) || ' ')) IN ({phr}) AS INTEGER) AS allowed FROM events"
    q["F6_nonempty_description"] = f"""WITH {_articles()}
SELECT id, CAST(array_to_string(abstract_texts, ' ') IS NOT NULL AND length(array_to_string(abstract_texts, ' ')) > 0 AS INTEGER) AS ok FROM articles"""
    q["F7_min_length_article"] = "SELECT doc_id, CAST(length(text) AS BIGINT) AS n, CAST(length(text) > 100 AS INTEGER) AS ok FROM documents"
    q["F8_min_length_pdf"] = """
WITH p AS (SELECT doc_id AS id, string_agg(line || chr(10), '' ORDER BY page_no) AS text
           FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS page_no FROM documents)
           WHERE length(line) > 0 GROUP BY doc_id)
SELECT id, CAST(length(text) AS BIGINT) AS n, CAST(length(text) >= 100 AS INTEGER) AS ok FROM p"""
    q["F9_all_fields_present"] = f"""WITH {_articles()}, {_agencies()}
SELECT a.id, CASE WHEN a.a_id IS NULL THEN 'a_id' WHEN head IS NULL THEN 'head' WHEN date IS NULL THEN 'date'
  WHEN url IS NULL THEN 'url' WHEN g.filename IS NULL THEN 'filename' WHEN lede IS NULL THEN 'lede'
  WHEN uname IS NULL THEN 'uname' END AS missing
FROM articles a LEFT JOIN agencies g ON a.a_id = g.a_id"""
    q["F11_in_day_window"] = f"SELECT event_id, CAST(date_diff('day', CAST(ts AS DATE), {AS_OF}) BETWEEN 0 AND {FIXTURE.days_back} AS INTEGER) AS ok FROM events"
    q["F12_in_month_window"] = """
SELECT o_orderkey, CAST(month(CAST(o_orderdate AS DATE)) <= 6 - 1 AS INTEGER) AS ok_month,
       CAST((1998 * 12 + 6) - (year(CAST(o_orderdate AS DATE)) * 12 + month(CAST(o_orderdate AS DATE))) >= 1 AS INTEGER) AS ok_year
FROM orders"""
    q["F13_page_cap"] = f"""
SELECT page_id, CAST(CASE WHEN n > 0 THEN n <= {P.PAGE_CAP} ELSE TRUE END AS INTEGER) AS ok FROM (
  SELECT page_id, coalesce(try_cast(nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') AS INTEGER), 0) + page_id % 60 AS n FROM pages)"""
    from quarry.operators.rules import EMAIL_RX
    rx = R.lit(EMAIL_RX)
    addr = ("CASE WHEN c_custkey % 2 = 0 THEN lower(replace(c_name, '#', '.')) || '@example.com' "
            "ELSE c_name || '@example.com' END")
    to = f"replace({addr} || '; ' || 'desk@example.org', ' ', '')"
    cc = "replace(CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'a@example.com,b@example.com' END, ' ', '')"
    q["F15_recipients_valid"] = f"""
SELECT c_custkey, CAST(list_bool_and(list_transform(string_split_regex({to}, '[,;]'), lambda x: regexp_matches(x, {rx}))) AS INTEGER) AS to_ok,
       CAST(({cc}) = '' OR list_bool_and(list_transform(string_split_regex({cc}, '[,;]'), lambda x: regexp_matches(x, {rx}))) AS INTEGER) AS cc_ok
FROM customer"""
    return q
