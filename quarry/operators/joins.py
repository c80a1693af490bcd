"""Joins (J1-J3, J6, J7).

No broadcast hints on tables whose size grows with the data: AQE converts a
sort-merge join to a broadcast at run time when a side turns out small, and
splits skewed partitions otherwise.  Fixed small tables (templates, reason
labels) are broadcast, or become an expression, because their size is bounded
by construction.  Where a side is read from files, or its columns compress well,
its size says little of its rows: see ``beside``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def beside(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is merged, never broadcast.

    Columnar files hold many small rows, or long texts, in few bytes a row: by the size of its files, and
    the width guessed for its columns, a table of millions of rows passes for a small one, and would be
    sent whole through the driver to every task.  A node table's sides share their buckets, so there the
    merge needs no shuffle either."""
    return df.hint("merge")


def agency_group_join(agencies: DataFrame, groups: DataFrame, key: str = "ug_id",
                      descrip_like: str | None = None) -> DataFrame:
    """Inner equi join with an optional LIKE filter on the group."""
    g = groups if descrip_like is None else groups.where(F.col("descrip").like(descrip_like))
    return agencies.join(g, key, "inner")


def dedupe_dimension(dim: DataFrame, key: str, cols, order: str | None = None) -> DataFrame:
    """One row per key: of rows that share a key the last in ``order`` counts, as in a lookup table
    filled row by row.  Without ``order`` (a dimension with one row per key) the greatest values do,
    so the pick doesn't change between runs.  Partial aggregation keeps this skew-safe."""
    row = F.struct(*[F.col(c) for c in cols])
    agg = (F.max(row) if order is None else F.max_by(row, F.struct(F.col(order), row))).alias("_v")
    return dim.groupBy(key).agg(agg).select(key, *[F.col("_v." + c).alias(c) for c in cols])


def lookup(df: DataFrame, dim: DataFrame, key: str, cols, order: str | None = None) -> DataFrame:
    """Left join on the deduplicated dimension; a miss leaves nulls
    (turned into a reason by the caller)."""
    return df.join(dedupe_dimension(dim, key, cols, order), key, "left")


def template_match(rows: DataFrame, field: str, templates: DataFrame) -> DataFrame:
    """``rows`` with keyword and template of the first template (lowest prio) whose keyword the
    field contains; null when none does.

    The templates are configuration, a handful of rows: they become one expression over the field,
    decided where a row is read, without a join."""
    known = sorted(templates.select("prio", "keyword", "template").collect())
    found = F.lit(None).cast("struct<keyword:string,template:string>")
    for t in reversed(known):
        found = F.when(F.contains(F.col(field), F.lit(t["keyword"])),
                       F.struct(F.lit(t["keyword"]).alias("keyword"), F.lit(t["template"]).alias("template"))).otherwise(found)
    return (rows.withColumn("_m", found)
                .select(*rows.columns, F.col("_m.keyword").alias("keyword"), F.col("_m.template").alias("template")))


def follow_links(links: DataFrame, pages: DataFrame, link_col: str = "link", url_col: str = "url") -> DataFrame:
    """Link rows joined to the pages they lead to; a miss keeps the row
    with null html (reason ``no_comment_page`` / ``landing_page_html_is_none``)."""
    p = pages.withColumnRenamed(url_col, "_target_url")
    return links.join(p, links[link_col] == p["_target_url"], "left").drop("_target_url")


def reply_join(requests: DataFrame, replies: DataFrame, keys) -> DataFrame:
    """Model replies joined back to requests on the request id."""
    return requests.join(replies, list(keys), "left")
