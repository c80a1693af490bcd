"""Oracle SQL, part 7: requests and replies between runs, story runs, the journal report."""

from quarry import params as P
from quarry import sqlrender as R
from quarry.functions.fold import build_map
from quarry.operators.model_io import JOURNAL_PROMPT, MODEL_NAME
from quarry.plans import queries as Q
from oracle_batch1 import prompt_sql, split_reply, story_body
from oracle_batch2 import comment_pages_cte, labels_cte
from oracle_batch4 import HOST, x4_select
from oracle_batch6 import issues_cte, records_cte, sql as issue_sql


def digest(prompt, said):
    part = lambda e: f"CAST(strlen({e}) AS VARCHAR) || ':' || {e}"
    return "sha256(" + " || ".join(part(e) for e in (R.lit(MODEL_NAME), "'system'", prompt, "'user'", said)) + ")"


def replied(rows, key, first):
    """a1, a2: the reply of each ``key`` by the run in which it came; ``first``: whose come with the first."""
    return f"""a1 AS (SELECT {key} AS k, min(reply) AS reply FROM {rows} WHERE {first} AND reply IS NOT NULL GROUP BY {key}),
a2 AS (SELECT {key} AS k, min(reply) AS reply FROM {rows} WHERE reply IS NOT NULL AND {key} NOT IN (SELECT k FROM a1) GROUP BY {key})"""


def story_runs():
    head, rest = split_reply("clean_reply")
    post, phrase = R.signer_split("clean_text", Q.FIXTURE.signers)
    return f"""
WITH x4 AS MATERIALIZED ({x4_select()}), {comment_pages_cte()},
t AS MATERIALIZED (SELECT x4.event_id, x4.filename, x4.clean_text, '{HOST}/comment/' || x4.id AS link, p.pdf_id, c.text AS reply
      FROM x4 JOIN comment_pages p ON p.for_event = x4.event_id
      LEFT JOIN conversations c ON c.conv_id = p.pdf_id AND c.turn = 1 AND c.role = 'assistant' WHERE x4.reason = 'added'),
{replied("t", "clean_text", "pdf_id % 2 = 0")},
j AS (SELECT t.event_id, t.filename, t.clean_text, t.link, a.run, {R.fold("a.reply", "T1")} AS clean_reply, {post} AS post, {phrase} AS phrase
      FROM t JOIN (SELECT k, reply, 'run-1' AS run FROM a1 UNION ALL SELECT k, reply, 'run-2' FROM a2) a ON t.clean_text = a.k),
k AS (SELECT *, {head} AS headline, {story_body("(" + rest + ")", "link")} AS body FROM j),
l AS (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY run, event_id) AS place FROM k WHERE body IS NOT NULL)
SELECT run AS batch, filename, '{P.STORY_UNAME}' AS uname, CAST({P.STORY_SOURCE_ID} AS BIGINT) AS source, headline, body AS story_txt,
       CASE WHEN post IS NOT NULL OR contains(body, 'coalition') THEN 'E' ELSE 'D' END AS status, '{Q.FIXTURE.as_of_str}' AS content_date,
       CASE WHEN post IS NOT NULL THEN 'Signer phrase found: ' || phrase || chr(10) || 'Post Signer Text:' || chr(10) || chr(10) || post ELSE '' END AS comments,
       left(clean_text, {P.ORIG_TEXT_MAX}) || chr(10) || chr(10) || ' *** Prompt Below *** ' || chr(10) || chr(10) || {prompt_sql()} AS orig_txt
FROM l WHERE place = 1 OR filename IS NULL"""


def sql():
    import oracle_queries as O
    q = {}
    journal = digest(R.lit(JOURNAL_PROMPT), "said")
    asked = f"""SELECT id, {journal} AS request_id
      FROM (SELECT id, array_to_string(abstract_texts, ' ') AS said FROM articles) WHERE length(said) > 0"""
    q["M1_journal_requests"] = f"""WITH {O.ARTICLES} SELECT id, '{MODEL_NAME}' AS model, request_id FROM ({asked})"""
    q["J7_request_ledger"] = f"""
WITH rec AS (SELECT CAST(u.conv_id AS VARCHAR) || '-' || CAST(u.turn AS VARCHAR) AS record_id, u.conv_id, {digest(prompt_sql(), "u.text")} AS request_id, r.text AS reply
  FROM (SELECT * FROM conversations WHERE role = 'user' AND text IS NOT NULL) u
  LEFT JOIN (SELECT * FROM conversations WHERE role = 'assistant') r ON u.conv_id = r.conv_id AND u.turn = r.turn - 1),
{replied("rec", "request_id", "conv_id % 4 = 0")}
SELECT record_id, request_id, CASE WHEN conv_id % 2 = 0 THEN 'run-1' ELSE 'run-2' END AS asked_in,
       CASE WHEN a1.k IS NOT NULL THEN 'run-1' WHEN a2.k IS NOT NULL THEN 'run-2' END AS answered_in,
       CASE WHEN a1.k IS NOT NULL THEN 'run-2' WHEN a2.k IS NOT NULL THEN 'run-3' END AS met_in, coalesce(a1.reply, a2.reply) AS reply
FROM rec LEFT JOIN a1 ON request_id = a1.k LEFT JOIN a2 ON request_id = a2.k"""
    told = f"""SELECT a.id, w.told FROM ({asked}) a
      JOIN (SELECT b.request_id, min(c.text) AS told FROM ({asked}) b
            JOIN conversations c ON c.conv_id = b.id AND c.turn = 1 AND c.role = 'assistant' GROUP BY b.request_id) w USING (request_id)"""
    q["X2_with_replies"] = O.press_release_sql(Q.FIXTURE.keyword_skips, replies=told)
    q["X5_story_runs"] = story_runs()
    x1, x2 = issue_sql()["X1_journal_issues"], issue_sql()["X2_from_issues"]
    _, chars = build_map("T2")
    said = f"translate(array_to_string(texts, ' '), {R.lit(''.join(chars))}, '')"
    q["X6_journal_report"] = f"""
WITH {records_cte()}, {labels_cte()},
x1 AS ({x1}), x2 AS ({x2}),
o AS (SELECT reason FROM x1 WHERE reason <> 'ok' UNION ALL SELECT reason FROM recs WHERE reason <> 'ok' UNION ALL SELECT reason FROM x2),
m AS (SELECT unnest([('loaded', count(*) FILTER (reason = 'loaded')), ('duplicates', count(*) FILTER (reason = 'duplicate')),
                     ('no_lede', count(*) FILTER (reason = 'no_lede')),
                     ('sites', (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey % {Q.NO_TEMPLATE} <> 0))]) AS v FROM o),
d AS (SELECT unicode(c) AS u, count(*) AS n FROM (SELECT unnest(regexp_extract_all({said}, '[^\\x00-\\x7F]')) AS c FROM recs WHERE reason = 'ok') GROUP BY u)
SELECT 'metric' AS part, v[1] AS name, NULL AS label, v[2] AS n FROM m
UNION ALL SELECT 'reason', o.reason, l.label, count(*) FROM o LEFT JOIN labels l ON o.reason = l.reason GROUP BY o.reason, l.label
UNION ALL SELECT 'dropped', 'U+' || printf('%04X', u), NULL, n FROM d"""
    return q
