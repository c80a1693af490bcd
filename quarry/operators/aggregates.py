"""Aggregations.

Counts and metrics are partial aggregations (combined map-side, so a hot
reason costs nothing extra).  The per-reason details (A5) stay rows, sorted,
never one list per reason.  A1/A2 build one text per group: the group is
one record's pieces (at most k abstracts after O5, one document's pages),
so the list is the size of the output value itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.fold import dropped_chars


def join_texts(df: DataFrame, group, order: str, text: str, sep: str = " ", out: str = "text") -> DataFrame:
    """A1: texts of a group joined by ``sep`` in order."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return df.groupBy(*([group] if isinstance(group, str) else group)).agg(
        F.array_join(F.transform(parts, lambda x: x["t"]), sep).alias(out))


def concat_pages(df: DataFrame, group: str, order: str, text: str, out: str = "text") -> DataFrame:
    """A2: non-empty page texts, each followed by a newline."""
    nonempty = df.where(F.col(text).isNotNull() & (F.length(text) > 0))
    j = join_texts(nonempty.withColumn("_t", F.concat(F.col(text), F.lit("\n"))), group, order, "_t", "", out)
    return j


def reason_counts(outcomes: DataFrame, reason: str = "reason") -> DataFrame:
    """A4: number per reason (only reasons that occur)."""
    return outcomes.groupBy(reason).agg(F.count(F.lit(1)).alias("n"))


def reason_details(outcomes: DataFrame, labels: DataFrame, reason: str = "reason", detail: str = "detail") -> DataFrame:
    """A5: one row per detail with its label, sorted by reason then detail."""
    return (outcomes.select(reason, detail).join(F.broadcast(labels), reason, "left")
                    .orderBy(reason, detail))


def run_metrics(outcomes: DataFrame, success: str, reason: str = "reason", sites: DataFrame | None = None) -> DataFrame:
    """Loaded, looked at, duplicates, missing lede in one aggregate; with ``sites``, the rows of the
    site list that the run went through, also ``sites``, their number."""
    r = F.col(reason)
    m = outcomes.agg(
        F.count_if(r == success).alias("loaded"),
        F.count_if(r != "not_reached").alias("looked_at"),
        F.count_if(r == "duplicate").alias("duplicates"),
        F.count_if(r == "no_lede").alias("no_lede"),
        F.count(F.lit(1)).alias("records"))
    # one row beside one row
    return m if sites is None else m.join(F.broadcast(sites.agg(F.count(F.lit(1)).alias("sites"))), F.lit(True))


def drop_report(df: DataFrame, text: str) -> DataFrame:
    """A row per character that no rule covers: code_point, how often it was dropped (n) and in how
    many rows (n_rows).  Counted per row first, so a text of one alphabet moves a row per letter."""
    c = df.select(dropped_chars(F.col(text)).alias("_c")).where(F.size("_c") > 0).withColumn("_s", F.array_join("_c", ""))
    # how often a character occurs is what the text loses without it: no comparison of each character with each
    per = c.select(F.explode(F.transform(F.array_distinct("_c"), lambda ch: F.struct(
        F.ascii(ch).alias("code_point"), (F.length("_s") - F.length(F.replace("_s", ch, F.lit("")))).alias("n")))).alias("_d"))
    return per.groupBy(F.col("_d.code_point").alias("code_point")).agg(
        F.sum("_d.n").alias("n"), F.count(F.lit(1)).alias("n_rows"))
