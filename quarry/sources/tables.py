"""Driver tables and the derived inputs of FIXTURES §2 (same views in DuckDB).

Only column expressions and equi joins: every view keeps the partitioning
of its base table and is read with column pruning.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.fold import transliterate

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

ARTICLE_EPOCH = "2024-01-01"
ARTICLE_DAYS = 28
ARTICLE_HOST = "https://journals.example.org/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def first_line(c):
    return F.substring_index(c, "\n", 1)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issue records as X1 would hand them to X2 (FIXTURES §2).

    Headlines come folded; ``abstract_texts`` are the lines after the first; a quarter of the
    agency keys (2 x doc_id) find no agency on purpose."""
    d = table(spark, sf_dir, "documents")
    lines = F.split(F.col("text"), "\n")
    return d.select(
        F.col("doc_id").alias("id"),
        (F.col("doc_id") * 2).cast("string").alias("a_id"),
        transliterate(first_line(F.col("text"))).alias("head"),
        F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))).alias("abstract_texts"),
        F.col("source").alias("journal_name"),
        F.date_add(F.lit(ARTICLE_EPOCH).cast("date"), (F.col("doc_id") % ARTICLE_DAYS).cast("int")).alias("date"),
        F.concat(F.lit(ARTICLE_HOST), F.col("source"), F.lit("/issue/"), F.col("doc_id").cast("string")).alias("url"),
    )


def agencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agency dimension = customer joined with its group (nation)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return (c.join(n, c.c_nationkey == n.n_nationkey, "inner")
             .select(F.col("c_custkey").cast("string").alias("a_id"),
                     F.col("c_name").alias("filename"),
                     F.concat(F.col("c_mktsegment"), F.lit(" DATE")).alias("lede"),
                     F.col("n_name").alias("uname")))


def target_press_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filenames already stored: the articles with an even id, as a previous run wrote them."""
    from quarry.functions.text import article_filename
    a = articles(spark, sf_dir).where(F.col("id") % 2 == 0)
    g = agencies(spark, sf_dir)
    return (a.join(g, "a_id", "inner")
             .select(article_filename(F.col("filename"), F.col("date"), F.col("head")).alias("filename"),
                     F.col("date").alias("content_date")))


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment cards, newest first by (ts, event_id).  The order key is kept
    as columns instead of a global rank (a global rank is one task)."""
    e = table(spark, sf_dir, "events")
    cid = F.concat(F.lit("AG-"), F.col("user_id").cast("string"), F.lit("-"), F.col("event_id").cast("string"))
    return e.select(
        F.col("ts"), F.col("event_id"),
        cid.alias("id"),
        F.col("event_type").alias("title"),
        F.concat(F.lit("/comment/"), cid).alias("link"),
        F.date_format(F.col("ts"), "MMM d, yyyy").alias("posted"),
        F.col("user_id"),
    )


def issue_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("journal"), F.col("ts"), F.col("event_id"),
                    (F.col("event_type") == "error").alias("invalid"),
                    F.to_date(F.col("ts")).alias("issue_date"), F.col("event_type").alias("tag_text"))


def pdf_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted page texts: one row per line of a document, line number = page."""
    d = table(spark, sf_dir, "documents")
    return (d.select(F.col("doc_id").alias("id"), F.posexplode(F.split(F.col("text"), "\n")))
             .select("id", (F.col("pos") + 1).alias("page_no"), F.col("col").alias("text")))


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.where(F.col("role") == "assistant").select(F.col("conv_id"), F.col("turn"), F.col("text").alias("reply"))


def issue_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url", "html")
