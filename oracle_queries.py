"""DuckDB oracle SQL for every query in ``__spark_entry__.queries()``.

Written against the driver's pre-registered views.  Derived inputs
(FIXTURES §2) are CTEs here, with the same definitions as
``quarry.sources.tables``.
"""

from __future__ import annotations

from quarry import params as P
from quarry import sqlrender as R

AS_OF = P.RunParams().as_of_str
NL = "chr(10)"

ARTICLES = f"""articles AS (
  SELECT doc_id AS id, CAST(doc_id * 2 AS VARCHAR) AS a_id,
         {R.fold(f"split_part(text, {NL}, 1)", "T2")} AS head,
         string_split(text, {NL})[2:] AS abstract_texts,
         source AS journal_name,
         DATE '2024-01-01' + CAST(doc_id % 28 AS INTEGER) AS date,
         'https://journals.example.org/' || source || '/issue/' || CAST(doc_id AS VARCHAR) AS url
  FROM documents)"""

AGENCIES = """agencies AS (
  SELECT CAST(c_custkey AS VARCHAR) AS a_id, c_name AS filename,
         c_mktsegment || ' DATE' AS lede, n_name AS uname
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

TARGET_PR = """target_press_release AS (
  SELECT '$H ' || g.filename || strftime(a.date, '%y%m%d') || right(a.head, 10) AS filename
  FROM articles a JOIN agencies g ON a.a_id = g.a_id WHERE a.id % 2 = 0)"""


def press_release_sql(keywords=P.KEYWORD_SKIPS, articles=ARTICLES, as_of=AS_OF, target=True, replies=None) -> str:
    """``replies``: SQL of (id, told), a model's replies that take the place of the descriptions."""
    stored = "x5.filename IN (SELECT filename FROM target_press_release) OR " if target else ""
    desc = R.strip_boilerplate(R.fold("told", "T2"))
    told, join = ("told", f"LEFT JOIN ({replies}) t USING (id)") if replies else ("array_to_string(abstract_texts, ' ') AS told", "")
    kw = R.first_contained("dtext", keywords)
    body_raw = ("chr(10) || 'WASHINGTON, ' || strftime(DATE '" + as_of + "', '%b. %d') || ' -- ' || post_head || ':' || chr(10) || '*' || chr(10) "
                "|| (CASE WHEN length(head) > 0 THEN replace(dtext, head, '') ELSE dtext END) "
                "|| chr(10) || chr(10) || '***' || chr(10) || chr(10) || 'Original text here: ' || url")
    body = R.normalise_whitespace(body_raw)
    return f"""
WITH {articles}, {AGENCIES}, {TARGET_PR if target else "none AS (SELECT 1)"},
x0 AS (SELECT id, a_id, head, journal_name, date, url, array_to_string(abstract_texts, ' ') AS desc0, {told} FROM articles {join}),
x1 AS (SELECT *, {desc} AS dtext FROM x0),
x2 AS (SELECT *, {kw} AS kw, length(dtext) AS desc_len,
              'The ' || journal_name || ' posted research article in ''' || head || '''' AS post_head FROM x1),
x3 AS (SELECT x2.*, g.filename AS agency_filename FROM x2 LEFT JOIN agencies g ON x2.a_id = g.a_id),
x4 AS (SELECT id, a_id, head, date, kw, desc_len, desc0, told, url,
              left(post_head, {P.HEADLINE_MAX}) AS headline,
              {body} AS story_txt,
              '$H ' || agency_filename || strftime(date, '%y%m%d') || right(head, 10) AS filename
       FROM x3),
x5 AS (SELECT *, CASE WHEN desc0 IS NULL OR length(desc0) = 0 THEN 'description_is_none'
                      WHEN told IS NULL THEN 'no_reply'
                      WHEN kw IS NOT NULL THEN 'keyword'
                      WHEN desc_len <= {P.ARTICLE_MIN_CHARS} THEN 'too_short'
                      WHEN filename IS NULL THEN 'filename_is_none' END AS pre_reason FROM x4),
firsts AS (SELECT filename, min(id) AS first_id FROM x5 WHERE pre_reason IS NULL GROUP BY filename),
x6 AS (SELECT x5.*, CASE WHEN pre_reason IS NOT NULL THEN pre_reason
                         WHEN {stored}x5.id <> f.first_id THEN 'duplicate'
                         WHEN try_cast(a_id AS INTEGER) IS NULL OR length(headline) > {P.HEADLINE_MAX} THEN 'rejected'
                         ELSE 'loaded' END AS reason
       FROM x5 LEFT JOIN firsts f ON x5.filename = f.filename)
SELECT id, a_id, reason,
       CASE WHEN reason = 'keyword' THEN a_id || ': ' || url || ' Word: ' || kw
            WHEN reason = 'too_short' THEN a_id || ': ' || url || ' Description Length: ' || CAST(desc_len AS VARCHAR)
            WHEN reason = 'filename_is_none' THEN a_id
            ELSE a_id || ': ' || head END AS detail,
       filename,
       CASE WHEN reason = 'loaded' THEN headline END AS headline,
       CASE WHEN reason = 'loaded' THEN strftime(date, '%Y-%m-%d') END AS content_date,
       CASE WHEN reason = 'loaded' THEN story_txt END AS story_txt,
       CASE WHEN reason = 'loaded' THEN 'D' END AS box
FROM x6"""


def all_sql() -> dict[str, str]:
    import oracle_batch1
    from quarry.plans.queries import FIXTURE
    q = {"X2_press_release": press_release_sql(FIXTURE.keyword_skips)}
    q.update(oracle_batch1.sql())
    import oracle_batch2
    q.update(oracle_batch2.sql())
    import oracle_batch3
    q.update(oracle_batch3.sql())
    import oracle_batch4
    q.update(oracle_batch4.sql())
    import oracle_batch5
    q.update(oracle_batch5.sql())
    import oracle_batch6
    q.update(oracle_batch6.sql())
    import oracle_batch7
    q.update(oracle_batch7.sql())
    return q
