"""Oracle SQL, part 5: streaming results equal the batch results."""

from quarry import sqlrender as R
from quarry.plans import queries as Q

AS_OF = f"DATE '{Q.FIXTURE.as_of_str}'"
KEY = "'AG-' || CAST(user_id AS VARCHAR) || '-' || strftime(CAST(ts AS DATE), '%Y-%m-%d')"


def sql():
    q = {}
    q["W1_incremental_ingest"] = f"""
SELECT key, event_id FROM (SELECT {KEY} AS key, event_id, row_number() OVER (PARTITION BY {KEY} ORDER BY ts, event_id) AS r FROM events) WHERE r = 1"""
    q["W2_stream_dedupe"] = f"SELECT DISTINCT {KEY} AS key FROM events"
    q["W3_late_rows"] = f"SELECT event_id FROM events WHERE date_diff('day', CAST(ts AS DATE), {AS_OF}) BETWEEN 0 AND {Q.FIXTURE.days_back}"
    rej = R.first_contained("event_type", Q.FIXTURE.title_reject, case_sensitive=False)
    q["W4_daily_outcomes"] = f"""
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, CASE WHEN {rej} IS NOT NULL THEN 'title_rejected' ELSE 'added' END AS reason,
       count(*) AS n FROM events GROUP BY 1, 2"""
    return q
