"""Rules with a recorded reason (F*, E1-E3).

A rule never drops a row: it yields a reason, and ``first_failing`` picks the
first one in the order the reference checks them.  Accepted rows carry the
success reason ('loaded', 'added', ...).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Reason vocabulary and report labels.
REASON_LABELS = {
    "csv_line": "CSV Line Has Improper Setup:",
    "no_template": "Unable to Assign Row, Invalid Domain:",
    "landing_page_html_is_none": "Landing Page HTML is None:",
    "landing_page_containers_html_is_none": "Landing Page Containers HTML is None:",
    "issue_page_html_is_none": "Issue Page HTML is None:",
    "link_is_none": "Link Found NoneType:",
    "title_is_none": "Title Found NoneType:",
    "date_is_none": "Date Found NoneType:",
    "date_not_recent": "Date Not Recent:",
    "unequal_counts": "Landing Page Counts for Titles, Dates, Links Do Not Equal:",
    "abstract_missing": "Abstract Missing:",
    "description_is_none": "Article Description is None:",
    "keyword": "Article Skipped Due to Keyword:",
    "too_short": "Article Description Too Short:",
    "no_lede": "No Lede Found:",
    "no_uname": "No UNAME Found:",
    "filename_is_none": "Filename Is None:",
    "duplicate": "Duplicates:",
    "rejected": "Rejected Docs:",
    "loaded": "Loaded:",
    "title_rejected": "Doc Titles Rejected:",
    "no_comment_page": "No Comment Page:",
    "no_pdf_found": "No PDF Found:",
    "no_pdf_text": "No PDF Text:",
    "pdf_failure": "Error Processing Comment For PDF:",
    "duplicate_check_error": "Duplication Checking Error:",
    "insert_error": "Error Inserting into Database:",
    "added": "Docs added:",
    "not_reached": "Not Reached (walk stopped):",
    "no_reply": "No Model Reply:",
    "reply_without_newline": "Model Reply Has No Headline Line:",
}
SUCCESS_REASONS = ("loaded", "added")


def first_failing(*rules: tuple[Column, str], success: str | None = None) -> Column:
    """``coalesce(when(rule1, r1), when(rule2, r2), ..)``; accepted = success."""
    parts = [F.when(cond, F.lit(name)) for cond, name in rules]
    if success is not None:
        parts.append(F.lit(success))
    return F.coalesce(*parts)


def reason_labels(spark) -> DataFrame:
    """Reason -> report text, a small fixed table (broadcast by size)."""
    return spark.createDataFrame(sorted(REASON_LABELS.items()), "reason string, label string")


# ------------------------------------------------------------------ filters

def by_id(df: DataFrame, col: str, value) -> DataFrame:
    """keep one id, compared as strings."""
    return df.where(F.col(col).cast("string") == F.lit(str(value)))


def parse_flag(c: Column) -> Column:
    """The text 'True' is true, anything else false."""
    return F.coalesce(c == F.lit("True"), F.lit(False))


def nonblank_flag(c: Column) -> Column:
    """A field that is tested for truth (BYPASS): non-empty is true."""
    return F.coalesce(c != F.lit(""), F.lit(False))


def multi_issue_flag(containers: Column) -> Column:
    """The container spec finds several issues."""
    return F.coalesce(F.contains(containers, F.lit("find_all")), F.lit(False))


def nonempty(c: Column) -> Column:
    """F6."""
    return c.isNotNull() & (F.length(c) > 0)


def min_length_article(c: Column, limit: int = 100) -> Column:
    """passes when length > limit."""
    return F.length(c) > limit


def min_length_pdf(c: Column, limit: int = 100) -> Column:
    """F8: passes when length >= limit."""
    return F.length(c) >= limit


def first_null_field(*cols: str) -> Column:
    """name of the first null field, else null."""
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])


def equal_counts(a: Column, b: Column, c: Column) -> Column:
    """F10."""
    return (F.size(a) == F.size(b)) & (F.size(b) == F.size(c))


def page_cap(url: Column, cap: int = 40) -> Column:
    """page number from the query string, compared as a number."""
    n = F.regexp_extract(url, "[?&]pageNumber=([0-9]+)", 1).try_cast("int")
    return F.coalesce(n, F.lit(1)) <= cap


def phrase_allow(tag_text: Column, phrases) -> Column:
    """trimmed, lower-cased tag text is one of the phrases."""
    return F.lower(F.trim(tag_text)).isin(list(phrases))


EMAIL_RX = "^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)*\\.[A-Za-z]{2,}$"


def recipients_valid(addrs: Column, allow_empty: bool = False) -> Column:
    """split on ',' or ';' after removing blanks; every part an address."""
    s = F.replace(addrs, F.lit(" "), F.lit(""))
    parts = F.split(s, "[,;]")
    ok = F.forall(parts, lambda x: x.rlike(EMAIL_RX))
    if allow_empty:
        return (s == "") | ok
    return ok


def write_outcome(a_id: Column, headline: Column, max_headline: int = 254) -> Column:
    """Checks the target would make at insert time, as a reason or null."""
    return F.when(a_id.try_cast("int").isNull(), F.lit("rejected")) \
            .when(F.length(headline) > max_headline, F.lit("rejected"))
