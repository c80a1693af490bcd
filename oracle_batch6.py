"""Oracle SQL, part 6: X1 issues and records, and X2 on them, straight from orders, lineitem and documents."""

from quarry import sqlrender as R
from quarry.plans import queries as Q
from oracle_batch1 import date_texts_cte

P = Q.FIXTURE_ISSUES


def issues_cte():
    """listed: the issues of the pages that have some, with their reason."""
    okv = "CAST(o_orderkey AS VARCHAR)"
    label = f"'Issue ' || {okv} || ', pp 1-' || CAST(o_orderkey % 90 + 10 AS VARCHAR)"
    cleaned = R.clean_date_text("date_text")
    d = R.parse_date(cleaned)
    as_m = P.as_of.month
    lost = " OR ".join(f"o_custkey % {n} = 0" for n in (Q.NO_TEMPLATE, Q.SHORT_TEMPLATE, Q.NO_HTML, Q.NO_CONTAINER))
    return f"""{date_texts_cte()},
i AS (SELECT o_custkey AS journal, o_orderkey, date_text,
             CASE WHEN o_orderkey % 11 = 0 THEN 'Issue ' || {okv} ELSE {label} END || t.date_text AS issue,
             CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE '{Q.ISSUE_HOST}' || '/issue/' || {okv} END AS link,
             CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE {R.strip_py("replace(" + label + ", 'Issue ', '')")} END AS head,
             {d} AS date
      FROM (SELECT o_custkey, o_orderkey FROM orders WHERE NOT ({lost})) o JOIN date_texts t USING (o_orderkey)),
v AS (SELECT *, link IS NOT NULL AND head IS NOT NULL AND date IS NOT NULL AND NOT (month(date) <= {as_m} - {P.months_back}) AS invalid FROM i),
w AS (SELECT *, coalesce(sum(CAST(invalid AS INTEGER)) OVER (PARTITION BY journal ORDER BY o_orderkey
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM v),
listed AS (SELECT *, {R.strip_py('issue')} AS whole,
  CASE WHEN before >= {P.invalid_limit} THEN 'not_reached' WHEN link IS NULL THEN 'link_is_none'
       WHEN head IS NULL THEN 'title_is_none' WHEN date IS NULL THEN 'date_is_none'
       WHEN invalid THEN 'date_not_recent' ELSE 'ok' END AS reason
  FROM w)"""


def records_cte():
    ok = "CAST(o_orderkey AS VARCHAR)"
    blank = R.lit("[ \\t\\n\\x0B\\f\\r]+")
    return f"""{issues_cte()},
art AS (SELECT l_orderkey AS o_orderkey, l_linenumber AS n, l_partkey % {Q.ABSTRACT_DOCS} AS doc, l_linenumber % 5 <> 4 AS linked,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS r
        FROM lineitem WHERE l_returnflag IN ('A', 'R')),
abstracts AS (
  SELECT o_orderkey, bool_or(linked AND doc_id IS NULL) AS lost,
         list({R.strip_py("coalesce(text, '')")} ORDER BY r) FILTER (linked AND doc_id IS NOT NULL AND doc_id % 9 <> 0) AS texts
  FROM art LEFT JOIN documents ON doc = doc_id WHERE r <= {P.abstracts_per_issue} GROUP BY o_orderkey),
body AS (
  SELECT l_orderkey AS o_orderkey, string_agg(
    CASE l_returnflag WHEN 'A' THEN 'Articles' WHEN 'R' THEN 'Research' ELSE 'News' END || ' item ' || l_linenumber || ' of part' || chr(10)
    || l_partkey || CASE WHEN l_linenumber % 5 = 4 THEN ' no link' ELSE ' abstract' END, chr(10) || chr(10) ORDER BY l_linenumber, l_partkey) AS ps
  FROM lineitem GROUP BY l_orderkey),
records AS (
  SELECT o_orderkey, journal, CAST(journal AS VARCHAR) AS a_id, link AS url, head, date,
         CASE WHEN o_orderkey % 13 <> 0 THEN '## Issue & list ' || {ok} || chr(10) || chr(10) || ps END AS jdata0, ps,
         coalesce(lost, false) AS lost, coalesce(texts, []) AS texts
  FROM listed LEFT JOIN (SELECT * FROM body WHERE o_orderkey % 7 <> 0) b USING (o_orderkey) LEFT JOIN abstracts USING (o_orderkey)
  WHERE reason = 'ok'),
recs AS (
  SELECT *, CASE WHEN ps IS NOT NULL THEN jdata0 END AS jdata,
         CASE WHEN ps IS NULL THEN 'issue_page_html_is_none' WHEN jdata0 IS NULL THEN 'description_is_none'
              WHEN lost THEN 'abstract_missing' ELSE 'ok' END AS reason
  FROM records)"""


def sql():
    import oracle_queries as O
    q = {}
    bucket = f"o_orderkey // {Q.ISSUE_BUCKET}"
    q["X1_journal_issues"] = f"""
WITH {issues_cte()}
SELECT journal, whole AS issue, link, head, strftime(date, '%Y-%m-%d') AS date, reason FROM listed
UNION ALL
SELECT DISTINCT ON (journal, bucket) journal, NULL, NULL, NULL, NULL,
  CASE WHEN journal % {Q.NO_TEMPLATE} = 0 THEN 'no_template' WHEN journal % {Q.SHORT_TEMPLATE} = 0 THEN 'csv_line'
       WHEN journal % {Q.NO_HTML} = 0 THEN 'landing_page_html_is_none' ELSE 'landing_page_containers_html_is_none' END
FROM (SELECT o_custkey AS journal, {bucket} AS bucket FROM orders) o
WHERE journal % {Q.NO_TEMPLATE} = 0 OR journal % {Q.SHORT_TEMPLATE} = 0 OR journal % {Q.NO_HTML} = 0 OR journal % {Q.NO_CONTAINER} = 0"""
    q["X1_issue_records"] = f"""
WITH {records_cte()}
SELECT a_id, url, head, strftime(date, '%Y-%m-%d') AS date, jdata,
       CASE WHEN reason = 'ok' THEN array_to_string(texts, chr(10) || '--' || chr(10)) END AS abstracts, reason FROM recs"""
    articles = f"""{records_cte()},
articles AS (SELECT journal * CAST(4294967296 AS BIGINT) + o_orderkey AS id, a_id, head, texts AS abstract_texts, 'Journal ' || a_id AS journal_name, date, url
             FROM recs WHERE reason = 'ok')"""
    x2 = O.press_release_sql(P.keyword_skips, articles, P.as_of_str, target=False)
    q["X2_from_issues"] = f"SELECT * EXCLUDE (id) FROM ({x2}) x"
    return q
