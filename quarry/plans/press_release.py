"""X2 press_release: issue records -> press_release rows plus outcomes.

Order of the rules follows the reference's insert routine: description
present (F6) -> transliterate (T2) -> boilerplate (T3) -> keyword (F4) ->
length (F7) -> drop headline (T4) -> headline and body (P9, P10) ->
whitespace (T5) -> filename (J2 + P7) -> insert-if-absent (J4 + J5) ->
write checks (E3).  The description is cleaned once, into a table; lookup, J5
and checks run on slim rows, and a body is built for loaded rows only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry import params as P
from quarry.functions import text as T
from quarry.functions.fold import transliterate
from quarry.operators.dedupe import insert_if_absent
from quarry.operators.joins import beside, lookup
from quarry.operators.rules import first_failing, write_outcome
from quarry.session import written


def press_release(issues: DataFrame, agencies: DataFrame, target: DataFrame | None,
                  params: P.RunParams = P.RunParams(), replies: DataFrame | None = None) -> DataFrame:
    """One row per issue record: ``reason`` ('loaded' or why not), ``detail``
    and the columns the press_release target takes.  With ``replies`` (id, reply;
    one per id at most) a model's reply takes the place of the description, and
    a described record without one has the reason ``no_reply``."""
    as_of = F.lit(params.as_of_str).cast("date")
    head = F.col("head")
    link = F.concat_ws(": ", F.col("a_id"), F.col("url"))
    who = F.concat_ws(": ", F.col("a_id"), head)

    # the text chain runs once, into a table; the rules below read its slim columns only
    x = issues.select(
        "id", "a_id", "head", "journal_name", "date", "url",
        F.array_join(F.col("abstract_texts"), " ").alias("desc0"))
    told = F.col("desc0")
    if replies is not None:
        x = x.join(beside(replies.select("id", F.col("reply").alias("told"))), "id", "left")
        told = F.col("told")
    x = x.withColumn("desc_t", transliterate(told))
    x = x.withColumn("desc", T.strip_boilerplate(F.col("desc_t"))).drop("desc_t")
    x = written(x.select(
        F.monotonically_increasing_id().alias("row"), "id", "a_id", "head", "journal_name", "date", "url", "desc",
        (F.length("desc0") > 0).alias("described"), told.isNotNull().alias("answered"),
        T.first_contained(F.col("desc"), params.keyword_skips).alias("kw"), F.length("desc").alias("desc_len")), "descriptions")

    slim = lookup(x.drop("desc"), agencies.select("a_id", F.col("filename").alias("agency_filename")),
                  "a_id", ["agency_filename"])
    slim = slim.withColumn("headline", T.truncate(T.post_headline(F.col("journal_name"), head), P.HEADLINE_MAX))
    slim = slim.withColumn("filename", T.article_filename(F.col("agency_filename"), F.col("date"), head))
    pre = first_failing(
        (~F.coalesce("described", F.lit(False)), "description_is_none"),
        (~F.col("answered"), "no_reply"),
        (F.col("kw").isNotNull(), "keyword"),
        (F.col("desc_len") <= P.ARTICLE_MIN_CHARS, "too_short"),
        (F.col("filename").isNull(), "filename_is_none"),
    )
    slim = written(slim.withColumn("pre_reason", pre).drop("agency_filename", "described", "answered"), "article-rows")
    y = insert_if_absent(slim, target, "filename", "id", eligible=F.col("pre_reason").isNull())
    reason = F.coalesce(F.col("pre_reason"),
                        F.when(F.col("is_duplicate"), F.lit("duplicate")),
                        write_outcome(F.col("a_id"), F.col("headline")),
                        F.lit("loaded"))
    y = y.withColumn("reason", reason)
    detail = (F.when(F.col("reason") == "keyword", F.concat(link, F.lit(" Word: "), F.col("kw")))
               .when(F.col("reason") == "too_short",
                     F.concat(link, F.lit(" Description Length: "), F.col("desc_len").cast("string")))
               .when(F.col("reason") == "filename_is_none", F.col("a_id"))
               .otherwise(who))
    # only loaded rows meet their text again
    ok = F.col("reason") == "loaded"
    y = y.withColumn("detail", detail).withColumn("text_row", F.when(ok, F.col("row")))
    y = y.join(beside(x.select(F.col("row").alias("text_row"), "desc")), "text_row", "left")
    post_head = T.post_headline(F.col("journal_name"), head)
    body = T.normalise_whitespace(
        T.article_body(as_of, post_head, T.drop_headline(F.col("desc"), head), F.col("url")))
    return y.select(
        "id", "a_id", "reason", "detail", "filename",
        F.when(ok, F.col("headline")).alias("headline"),
        F.when(ok, F.date_format("date", "yyyy-MM-dd")).alias("content_date"),
        F.when(ok, body).alias("story_txt"),
        F.when(ok, F.lit("D")).alias("box"))


def press_release_rows(outcomes: DataFrame, as_of: str) -> DataFrame:
    """S9 shape: the 8 bound values plus the two clock columns (= as_of)."""
    ts = F.lit(as_of).cast("timestamp")
    return (outcomes.where(F.col("reason") == "loaded")
                    .select(F.col("headline"), F.col("content_date").cast("date").alias("content_date"),
                            F.col("story_txt"), F.col("a_id").cast("int").alias("a_id"),
                            F.col("box"), F.col("filename"), F.lit("").alias("uname"),
                            F.lit("").alias("orig_txt"), ts.alias("date_sent"), ts.alias("last_action")))
