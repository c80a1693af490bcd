"""X5 story: cleaned comment text + model replies -> story rows (S10 shape)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry import params as P
from quarry.functions import text as T
from quarry.operators.dedupe import insert_if_absent
from quarry.operators.ledger import RequestLedger
from quarry.operators.model_io import build_requests, consume_replies, prompt_dateline
from quarry.session import written
from quarry.sources.sinks import commit_batch, read_committed

STORY_SCHEMA = ("filename string, uname string, source long, by_line string, headline string, story_txt string, editor string, "
                "invoice_tag string, date_sent timestamp, sent_to string, wire_to string, nexis_sent timestamp, "
                "factiva_sent timestamp, status string, content_date string, last_action timestamp, orig_txt string, comments string")
RECORD_SCHEMA = "position long, id string, title string, link string"


def story(requests: DataFrame, replies: DataFrame, keys, target: DataFrame | None,
          params: P.RunParams, order_col: str, by_line: str = "") -> DataFrame:
    """``requests``: keys, id, title, link, pdf_text; ``replies``: keys, reply.
    Returns one row per request with ``reason`` ('added' or why not) and the
    story columns."""
    as_of = F.lit(params.as_of_str).cast("date")
    prompt = prompt_dateline(as_of)
    x = consume_replies(requests, replies, keys, "pdf_text", "link", signers=params.signers)
    x = x.withColumn("filename", T.comment_filename(F.col("id"), F.col("title")))
    x = insert_if_absent(x, target, "filename", order_col, eligible=F.col("reply_reason").isNull())
    reason = F.coalesce(F.col("reply_reason"), F.when(F.col("is_duplicate"), F.lit("duplicate")), F.lit("added"))
    ts = F.lit(params.as_of_str).cast("timestamp")
    return x.select(
        *keys, reason.alias("reason"), "filename",
        F.lit(P.STORY_UNAME).alias("uname"), F.lit(P.STORY_SOURCE_ID).cast("long").alias("source"),
        F.lit(by_line).alias("by_line"), "headline", F.col("body").alias("story_txt"),
        F.lit("").alias("editor"), F.lit("").alias("invoice_tag"), ts.alias("date_sent"),
        F.lit("").alias("sent_to"), F.lit("").alias("wire_to"),
        F.lit(None).cast("timestamp").alias("nexis_sent"), F.lit(None).cast("timestamp").alias("factiva_sent"),
        F.col("box").alias("status"), F.date_format(as_of, "yyyy-MM-dd").alias("content_date"), ts.alias("last_action"),
        T.orig_text(F.col("pdf_text"), prompt).alias("orig_txt"), F.col("signer_comment").alias("comments"))


def open_ledger(spark, path: str) -> RequestLedger:
    return RequestLedger(spark, path, RECORD_SCHEMA)


def ask_stories(texts: DataFrame, ledger: RequestLedger, params: P.RunParams, run: str) -> None:
    """Enter the requests for ``texts``: position (the smallest wins a filename), id, title, link and
    pdf_text, the cleaned text of an accepted comment.  A record is a card: its link."""
    prompt = prompt_dateline(F.lit(params.as_of_str).cast("date"))
    t = texts.withColumn("record_id", F.col("link"))
    cols = ["record_id", "position", "id", "title", "link"]
    ledger.ask(build_requests(t, cols, "pdf_text", prompt), run)


def publish_stories(ledger: RequestLedger, target_path: str, params: P.RunParams, run: str) -> DataFrame:
    """One run of X5 against a stored target: replies that are there now, and that no run has met,
    become stories; of one filename the first by position, if none is stored; the batch is appended
    whole.  Returns record_id, reason and the story columns of this run's records.

    Repeated under its name, a run that was killed takes the same replies and checks them against the
    batches of other runs only, so it leaves what one run would have left."""
    spark = ledger.spark
    met = written(ledger.take(run).withColumn("pdf_text", F.col("messages")[1]["content"]).drop("messages"), "met-replies")
    stored = read_committed(spark, target_path, STORY_SCHEMA).where(F.col("batch") != run)
    x = written(story(met.drop("reply"), met.select("record_id", "reply"), ["record_id"], stored, params, "position"), "stories")
    rows = x.where(F.col("reason") == "added").drop("record_id", "reason")
    commit_batch(rows, target_path, run, "content_date")
    return x
