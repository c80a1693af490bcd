"""X3 comment_cards and X4 comment_text: the public-comment walk as joins.

X3: list pages -> cards (H13, H14) newest first -> doc limit (O2, counted before any rule) -> link
(F14) -> title (F3) -> posted date (D6, F11) -> stop at the first card that
reaches the date check out of the window (O3, a one-row broadcast cut-off).
X4: accepted cards -> comment page (J6, parsed only if an accepted card leads there) -> PDF title (P8 filename) ->
stored already (J4) -> download link (H15) -> PDF text (A2) -> length (F8)
-> clean-up (T1).  Existence is checked before the costly text steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry import params as P
from quarry.functions import dates as D
from quarry.functions import text as T
from quarry.functions.fold import ascii_fold
from quarry.operators.aggregates import concat_pages
from quarry.operators import selectors as H
from quarry.operators.ordered import newest_first_key, paginate, stop_at_first
from quarry.operators.rules import first_failing
from quarry.session import written
from quarry.sources.pages import document_context, elements, parsed_nodes, texts
from quarry.sources.specs import parse_step


CONTAINER = "find|class|results-container~find_all|class|card card-type-comment ember-view"


def card_contexts(pages: DataFrame):
    """(cards, elements, texts) of list pages: one context per card, keyed by (page_id, card_lo)."""
    nodes = parsed_nodes(pages)
    els, tx = elements(nodes), texts(nodes)
    cards = H.select(document_context(nodes), els, CONTAINER, ["page_id"])
    return cards.select("page_id", F.col("c_lo").alias("card_lo"), "c_lo", "c_hi", "c_nc"), els, tx


def cards_from_pages(pages: DataFrame) -> DataFrame:
    """One row per card of the list pages: page_id, card_lo, n (place on the page), link, title,
    id, posted; missing parts are null.  ``page_id`` is the page's number in the walk."""
    cards, els, tx = card_contexts(pages)
    keys = ["page_id", "card_lo"]
    cards = written(cards, "card-contexts")
    first = H.first_fields(cards, els, tx, keys, {"a": parse_step("find|elem|a")})
    meta = H.apply_step(cards, els, parse_step("find|class|card-metadata"), keys)
    lab = H.labelled_items(meta, els, tx, keys)
    place = F.row_number().over(Window.partitionBy("page_id").orderBy("card_lo")) - 1
    return (cards.select(*keys, place.alias("n"))
            .join(H.beside(first.select(*keys, F.col("a_attr").alias("link"), F.col("a_text").alias("title"))), keys, "left")
            .join(H.beside(lab), keys, "left"))


def read_comment_pages(pages: DataFrame, links: DataFrame) -> DataFrame:
    """Comment pages that ``links`` (link) lead to: url, pdf_title, download.  The others are not parsed."""
    met = written(pages.join(H.beside(links.select(F.col("link").alias("url")).distinct()), "url", "left_semi"), "comment-pages")
    nodes = parsed_nodes(met)
    els, tx = elements(nodes), texts(nodes)
    ctx = document_context(nodes)
    title = H.element_text(H.select(ctx, els, "find|class|h5 mt-0 mb-1", ["page_id"]), tx, ["page_id"], strip=False)
    got = H.download_link(ctx, els, ["page_id"]).join(H.beside(title.select("page_id", F.col("text").alias("pdf_title"))), "page_id", "left")
    return met.select("page_id", "url").join(H.beside(got), "page_id").select("url", "pdf_title", "download")


def comment_cards(cards: DataFrame, params: P.RunParams) -> DataFrame:
    """Every card with its reason.  ``cards``: event_id, id, title, link, posted, and the place in the
    walk, (page_id, card_lo) as read from list pages, or ts (newest first)."""
    as_of = F.lit(params.as_of_str).cast("date")
    c = cards.withColumn("k", paginate("page_id", "card_lo") if "card_lo" in cards.columns else newest_first_key())
    if params.doc_limit:
        # the n-th key of the walk: a top-n, then one row broadcast back
        nth = c.select("k").orderBy("k").limit(params.doc_limit).agg(F.max("k").alias("_lim"))
        c = c.crossJoin(F.broadcast(nth)).withColumn("in_limit", F.col("k") <= F.col("_lim")).drop("_lim")
    else:
        c = c.withColumn("in_limit", F.lit(True))
    c = c.withColumn("phrase", T.first_contained(F.col("title"), params.title_reject, case_sensitive=False))
    c = c.withColumn("posted_date", D.parse_posted(F.col("posted")))
    reached = F.col("in_limit") & F.col("link").isNotNull() & F.col("phrase").isNull() & F.col("posted_date").isNotNull()
    out = ~D.in_day_window(F.col("posted_date"), as_of, params.days_back)
    c = stop_at_first(c, "k", reached & out)
    reason = first_failing(
        (~F.col("in_limit"), "not_reached"),
        (~F.col("before_stop") & ~F.col("is_stop_row"), "not_reached"),
        (F.col("link").isNull(), "link_is_none"),
        (F.col("phrase").isNotNull(), "title_rejected"),
        (F.col("posted_date").isNull(), "date_is_none"),
        (F.col("is_stop_row"), "date_not_recent"),
        success="accepted")
    full_link = F.concat(F.lit(P.COMMENT_HOST), F.col("link"))
    detail = F.when(F.col("phrase").isNotNull(), F.concat(F.col("title"), F.lit(": phrase: "), F.col("phrase"))) \
              .otherwise(full_link)
    return c.select("event_id", "id", "title", "link", F.date_format("posted_date", "yyyy-MM-dd").alias("posted_date"),
                    reason.alias("reason"), detail.alias("detail"))


def comment_text(cards: DataFrame, comment_pages: DataFrame, pdf_pages: DataFrame,
                 target: DataFrame | None) -> DataFrame:
    """Accepted cards only; ``reason`` is 'added' when the cleaned text is
    ready for the model."""
    acc = cards.where(F.col("reason") == "accepted").select("event_id", "id", "title", "link")
    cp = comment_pages.withColumnRenamed("url", "_page_url")
    j = acc.join(H.beside(cp), acc.link == cp._page_url, "left")
    j = j.withColumn("filename", T.comment_filename(F.col("id"), F.col("pdf_title")))
    if target is not None:
        stored = target.select(F.col("filename").alias("_stored")).distinct()
        j = j.join(H.beside(stored), j.filename == stored._stored, "left").withColumn("is_stored", F.col("_stored").isNotNull()).drop("_stored")
    else:
        j = j.withColumn("is_stored", F.lit(False))
    pre = first_failing(
        (F.col("_page_url").isNull(), "no_comment_page"),
        (F.col("pdf_title").isNull(), "no_pdf_found"),
        (F.col("is_stored"), "duplicate"),
        (F.col("download").isNull(), "no_pdf_found"))
    j = j.withColumn("pre_reason", pre)
    # only rows that still need their text join the page texts
    need = j.where(F.col("pre_reason").isNull()).select("event_id", "pdf_id")
    txt = concat_pages(pdf_pages.join(H.beside(need.select(F.col("pdf_id").alias("id")).distinct()), "id", "left_semi"),
                       "id", "page_no", "text", "pdf_text")
    # cleaned once per document, however many cards lead to it
    txt = txt.select("id", F.length("pdf_text").alias("pdf_len"), ascii_fold(F.col("pdf_text")).alias("clean"))
    j = j.join(H.beside(txt.withColumnRenamed("id", "pdf_id")), "pdf_id", "left")
    reason = F.coalesce(F.col("pre_reason"),
                        F.when(F.coalesce(F.col("pdf_len"), F.lit(0)) < P.PDF_MIN_CHARS, F.lit("no_pdf_text")),
                        F.lit("added"))
    full_link = F.concat(F.lit(P.COMMENT_HOST), F.col("link"))
    return j.select("event_id", "id", "filename", reason.alias("reason"),
                    F.when(reason == "duplicate", F.concat(F.col("filename"), F.lit(" "), full_link)).otherwise(full_link).alias("detail"),
                    F.when(reason == "added", F.col("clean")).alias("clean_text"))
