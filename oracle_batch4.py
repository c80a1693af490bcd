"""Oracle SQL, part 4: the comment walk (X3, X4), stories (X5, S10), run report."""

from quarry import params as P
from quarry import sqlrender as R
from quarry.plans import queries as Q
from oracle_batch1 import prompt_sql, split_reply, story_body
from oracle_batch2 import cards_cte, comment_pages_cte, labels_cte

AS_OF = f"DATE '{Q.FIXTURE.as_of_str}'"
HOST = P.COMMENT_HOST


def x3_select():
    lim = Q.FIXTURE_WALK.doc_limit
    win = f"coalesce(date_diff('day', posted_date, {AS_OF}) BETWEEN 0 AND {Q.FIXTURE_WALK.days_back}, FALSE)"
    return f"""
WITH {cards_cte(from_pages=True)},
ranked AS (SELECT *, {lim} = 0 OR row_number() OVER (ORDER BY ts DESC, event_id DESC) <= {lim} AS in_limit FROM rules),
stops AS (SELECT ts, event_id FROM ranked
          WHERE in_limit AND link IS NOT NULL AND phrase IS NULL AND posted_date IS NOT NULL AND NOT {win}
          ORDER BY ts DESC, event_id DESC LIMIT 1),
f AS (SELECT r.*,
        (s.ts IS NULL) OR (r.ts > s.ts) OR (r.ts = s.ts AND r.event_id > s.event_id) AS before_stop,
        (s.ts IS NOT NULL AND r.ts = s.ts AND r.event_id = s.event_id) AS is_stop_row
      FROM ranked r LEFT JOIN stops s ON TRUE)
SELECT event_id, id, title, link, strftime(posted_date, '%Y-%m-%d') AS posted_date,
  CASE WHEN NOT in_limit THEN 'not_reached' WHEN NOT before_stop AND NOT is_stop_row THEN 'not_reached'
       WHEN link IS NULL THEN 'link_is_none' WHEN phrase IS NOT NULL THEN 'title_rejected'
       WHEN posted_date IS NULL THEN 'date_is_none' WHEN is_stop_row THEN 'date_not_recent' ELSE 'accepted' END AS reason,
  CASE WHEN phrase IS NOT NULL THEN title || ': phrase: ' || phrase ELSE '{HOST}' || link END AS detail
FROM f"""


def x4_select():
    return f"""
WITH x3 AS ({x3_select()}), {comment_pages_cte()},
tgt AS (SELECT DISTINCT '$H-PUBCOM-' || split_part(x.id, '-', 1) || left(p.pdf_title, 85) AS filename
        FROM (SELECT 'AG-' || CAST(user_id AS VARCHAR) || '-' || CAST(event_id AS VARCHAR) AS id,
                     '/comment/AG-' || CAST(user_id AS VARCHAR) || '-' || CAST(event_id AS VARCHAR) AS link FROM events) x
        JOIN comment_pages p ON x.link = p.url WHERE p.pdf_id % 4 = 0),
pdf AS MATERIALIZED (SELECT id, length(pdf_text) AS n, {R.fold('pdf_text', 'T1')} AS clean FROM (SELECT doc_id AS id, string_agg(line || chr(10), '' ORDER BY page_no) AS pdf_text
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS page_no FROM documents)
        WHERE length(line) > 0 GROUP BY doc_id)),
j AS (SELECT a.event_id, a.id, a.link, p.url AS page_url, p.pdf_id, nullif(p.pdf_title, '') AS pdf_title, p.download,
             '$H-PUBCOM-' || split_part(a.id, '-', 1) || left(nullif(p.pdf_title, ''), 85) AS filename
      FROM (SELECT * FROM x3 WHERE reason = 'accepted') a LEFT JOIN comment_pages p ON a.link = p.url),
k AS (SELECT j.*, CASE WHEN page_url IS NULL THEN 'no_comment_page' WHEN pdf_title IS NULL THEN 'no_pdf_found'
                       WHEN filename IN (SELECT filename FROM tgt) THEN 'duplicate' WHEN download IS NULL THEN 'no_pdf_found' END AS pre,
             pdf.n, pdf.clean FROM j LEFT JOIN pdf ON j.pdf_id = pdf.id),
m AS (SELECT *, coalesce(pre, CASE WHEN coalesce(n, 0) < {P.PDF_MIN_CHARS} THEN 'no_pdf_text' END, 'added') AS reason FROM k)
SELECT event_id, id, filename, reason,
       CASE WHEN reason = 'duplicate' THEN filename || ' ' || '{HOST}' || link ELSE '{HOST}' || link END AS detail,
       CASE WHEN reason = 'added' THEN clean END AS clean_text
FROM m"""


def story_select():
    clean = R.fold("r.text", "T1")
    head, rest = split_reply("clean")
    post, phrase = R.signer_split("u.text", Q.FIXTURE.signers)
    return f"""
WITH j AS (
  SELECT u.conv_id, u.turn, u.text AS pdf_text, r.text AS reply, {clean} AS clean,
         '{HOST}/comment/CV' || CAST(u.conv_id AS VARCHAR) || '-' || CAST(u.turn AS VARCHAR) AS link,
         '$H-PUBCOM-' || split_part('CV' || CAST(u.conv_id AS VARCHAR) || '-' || CAST(u.turn AS VARCHAR), '-', 1)
            || left(split_part(u.text, chr(10), 1), 85) AS filename,
         (u.conv_id, u.turn) AS req_order, {post} AS post, {phrase} AS phrase
  FROM (SELECT * FROM conversations WHERE role = 'user') u
  LEFT JOIN (SELECT * FROM conversations WHERE role = 'assistant') r ON u.conv_id = r.conv_id AND u.turn = r.turn - 1),
k AS (SELECT *, {head} AS headline, {story_body('(' + rest + ')', 'link')} AS body FROM j),
l AS (SELECT *, CASE WHEN reply IS NULL THEN 'no_reply' WHEN body IS NULL THEN 'reply_without_newline' END AS rr FROM k),
firsts AS (SELECT filename, min(req_order) AS first_order FROM l WHERE rr IS NULL AND filename IS NOT NULL GROUP BY filename)
SELECT l.conv_id, l.turn, coalesce(rr, CASE WHEN l.req_order <> f.first_order THEN 'duplicate' END, 'added') AS reason,
       l.filename, headline, body AS story_txt,
       CASE WHEN post IS NOT NULL OR contains(body, 'coalition') THEN 'E' ELSE 'D' END AS status,
       CASE WHEN post IS NOT NULL THEN 'Signer phrase found: ' || phrase || chr(10) || 'Post Signer Text:' || chr(10) || chr(10) || post ELSE '' END AS comments,
       left(pdf_text, {P.ORIG_TEXT_MAX}) || chr(10) || chr(10) || ' *** Prompt Below *** ' || chr(10) || chr(10) || {prompt_sql()} AS orig_txt
FROM l LEFT JOIN firsts f ON l.filename = f.filename"""


def sql():
    q = {}
    q["X3_comment_cards"] = x3_select()
    q["X4_comment_text"] = x4_select()
    q["X5_story"] = story_select()
    q["S10_append_story"] = f"""WITH s AS ({story_select()})
SELECT filename, '{P.STORY_UNAME}' AS uname, CAST({P.STORY_SOURCE_ID} AS BIGINT) AS source, headline, story_txt, status,
       '{Q.FIXTURE.as_of_str}' AS content_date, comments FROM s WHERE reason = 'added'"""
    q["X6_run_report"] = f"""WITH x3 AS ({x3_select()}), x4 AS ({x4_select()}), {labels_cte()},
o AS (SELECT reason FROM x3 WHERE reason <> 'accepted' UNION ALL SELECT reason FROM x4)
SELECT c.reason, l.label, c.n FROM (SELECT reason, count(*) AS n FROM o GROUP BY reason) c LEFT JOIN labels l ON c.reason = l.reason"""
    return q
