"""X6 run_report: counts per reason with labels, details, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.aggregates import drop_report, reason_counts, reason_details, run_metrics
from quarry.operators.rules import reason_labels
from quarry.session import written


def run_report(outcomes: DataFrame, success: str):
    """(counts, details, metrics).  ``outcomes`` needs ``reason`` and ``detail``."""
    spark = outcomes.sparkSession
    labels = reason_labels(spark)
    counts = reason_counts(outcomes).join(F.broadcast(labels), "reason", "left")
    return counts, reason_details(outcomes, labels), run_metrics(outcomes, success)


def render_summary(counts: DataFrame, metrics: DataFrame) -> DataFrame:
    """One text line per reason, as the report mail lists them (small: one
    row per reason)."""
    return counts.select(F.concat_ws(" ", F.coalesce("label", "reason"), F.col("n").cast("string")).alias("line"))


def journal_report(outcomes: DataFrame, sites: DataFrame, described: DataFrame) -> DataFrame:
    """X6 for journals, one row per line of the report: part, name, label, n.

    ``outcomes`` (reason) are all records the run met, ``sites`` the rows of the site list it went
    through, ``described`` (text) the texts that were transliterated.  Part ``metric``: loaded, sites, duplicates,
    no_lede; part ``reason``: each reason that occurs, with its label; part ``dropped``: each character that
    was dropped (name U+XXXX) and how often."""
    m = written(run_metrics(outcomes, "loaded", sites=sites), "metrics")          # one row
    names = ("loaded", "sites", "duplicates", "no_lede")
    metrics = m.select(F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.col(k).alias("n")) for k in names])).alias("_m"))
    metrics = metrics.select(F.lit("metric").alias("part"), "_m.name", F.lit(None).cast("string").alias("label"), "_m.n")
    counts = reason_counts(outcomes).join(F.broadcast(reason_labels(outcomes.sparkSession)), "reason", "left")
    hexed = F.hex("code_point")
    dropped = drop_report(described, "text").select(
        F.lit("dropped"), F.concat(F.lit("U+"), F.lpad(hexed, F.greatest(F.length(hexed), F.lit(4)), F.lit("0"))),
        F.lit(None).cast("string"), "n")
    return metrics.union(counts.select(F.lit("reason"), "reason", "label", "n")).union(dropped)
