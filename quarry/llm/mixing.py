"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quarry.llm.common import drop_clashing, n_words, written

ADDED = ("size", "source_size", "target", "taken")
SEED = "mix-1"
MAX_EPOCHS = 3
#: hex digits of a document's seeded rank that name its slice; a source has 16**SLICE_HEX slices
SLICE_HEX = 3


def targets(sized: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, source_size, target.

    Sources by code point, null last, weigh 1, 2, 3, repeating, and share all words.  A source's
    target stops at ``max_epochs`` times its size.  Clamping and sharing the excess by weight until
    none is above ends at one water level L with target = min(cap, L * weight).  With the sources
    sorted by cap / weight, L is what is left for a source and all after it, divided by their
    weights, at the first source whose cap that level does not pass.  The windows run over the
    source table (a row per source), never over documents.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1)
    per = per.withColumn("cap", F.col("source_size") * max_epochs)
    everything = W.partitionBy()
    by_level = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    below = by_level.rowsBetween(W.unboundedPreceding, -1)
    here_on = by_level.rowsBetween(W.currentRow, W.unboundedFollowing)
    per = (per
           .withColumn("total", F.sum("source_size").over(everything))
           .withColumn("spent", F.coalesce(F.sum("cap").over(below), F.lit(0)))
           .withColumn("level", (F.col("total") - F.col("spent")) / F.sum("weight").over(here_on)))
    # exact in integers: level * weight <= cap
    per = per.withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
    per = per.withColumn("water", F.min(F.when(F.col("open"), F.struct(F.col("spent"), F.col("level")))).over(everything))
    return per.select(
        "source", "source_size",
        F.when(F.col("water").isNull() | (F.col("spent") < F.col("water.spent")), F.col("cap").cast("double"))
        .otherwise(F.least(F.col("cap").cast("double"), F.col("water.level") * F.col("weight"))).alias("target"))


def plan(sized: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source_size, target, whole passes, and where the fraction ends.

    ``sized`` has source, size and rank.  Slice totals are summed map-side; running sums go over
    a source's slices (4,096 at most), so no task gets the rows of a whole source.  The fraction
    ends inside slice ``edge``, ``edge_left`` words after its begin.
    """
    per = (targets(sized, max_epochs)
           .withColumn("_words", F.floor("target").cast("long"))
           .withColumn("_whole", F.when(F.col("source_size") > 0, F.expr("_words div source_size")).otherwise(F.lit(0).cast("long")))
           .withColumn("left", F.col("_words") - F.col("_whole") * F.col("source_size")))
    earlier = W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    slices = (sized.groupBy("source", _slice(F.col("rank")).alias("slice")).agg(F.sum("size").alias("slice_size"))
              .withColumn("before", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0).cast("long")))
              .withColumnRenamed("source", "of"))
    inside = (F.col("source").eqNullSafe(F.col("of")) & (F.col("before") <= F.col("left"))
              & (F.col("left") < F.col("before") + F.col("slice_size")))
    return (per.join(slices, inside, "left")
            .select("source", "source_size", "target", "_whole", F.col("slice").alias("_edge"),
                    (F.col("left") - F.col("before")).alias("_edge_left")))


def _slice(rank):
    return F.substring(rank, 1, SLICE_HEX)


def _rank(seed: str):
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))


def mix(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """Every row of ``docs`` with size, source_size, target and taken.

    A document is taken whole as often as its source's target holds the source.  The rest of the
    target is a fraction of one more pass: documents in an order seeded by ``seed`` and doc_id are
    taken once more until the fraction is used up, the last one in part, so a source's taken words
    are its target rounded down and no document exceeds ``max_epochs`` times its size.  Only rows
    of the one slice in which a source's fraction ends are shuffled; all others are decided where
    they are read, against the table of sources, which Spark broadcasts if its files are small.

    Null, empty and blank texts have size 0 and taken 0.  A null source is a source of its own.  A
    null doc_id is ranked like any other value.  Equal rows count as separate documents; a tie in
    rank is broken by size.  An empty table gives no rows.  Columns named like the added ones are
    replaced; all others are kept.
    """
    base = drop_clashing(docs, *ADDED)
    rank, size = _rank(seed), n_words(F.col("text"))
    sized = written(base.select("source", size.alias("size"), rank.alias("rank")), "mix-sizes")
    per = written(plan(sized, max_epochs).withColumnRenamed("source", "_of"), "mix-plan")
    rows = (base.withColumn("_rank", rank)
            .join(per, F.col("source").eqNullSafe(F.col("_of")), "left").drop("_of")
            .withColumn("size", size))
    at = F.when(F.col("_edge").isNull(), F.lit(1)).otherwise(
        F.when(_slice(F.col("_rank")) < F.col("_edge"), F.lit(-1)).when(_slice(F.col("_rank")) > F.col("_edge"), F.lit(1)).otherwise(F.lit(0)))
    rows = rows.withColumn("_at", at)
    easy = rows.where(F.col("_at") != 0).withColumn("_extra", F.when(F.col("_at") < 0, F.col("size")).otherwise(F.lit(0).cast("long")))
    seen = W.partitionBy("source").orderBy("_rank", "size").rowsBetween(W.unboundedPreceding, -1)
    edge = (rows.where(F.col("_at") == 0)
            .withColumn("_seen", F.coalesce(F.sum("size").over(seen), F.lit(0).cast("long")))
            .withColumn("_extra", F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("_edge_left") - F.col("_seen"))))
            .drop("_seen"))
    return (easy.unionByName(edge)
            .withColumn("taken", F.col("_whole") * F.col("size") + F.col("_extra"))
            .drop("_rank", "_at", "_extra", "_whole", "_edge", "_edge_left"))


def op5_mix_sources(spark, sf_dir: str) -> DataFrame:
    from quarry.llm.common import table
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


OP5_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS rank
  FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source),
lev AS (
  SELECT *, source_size * 3 AS cap,
         (CAST(sum(source_size) OVER () AS BIGINT)
          - coalesce(CAST(sum(source_size * 3) OVER w1 AS BIGINT), 0)) / CAST(sum(weight) OVER w2 AS DOUBLE) AS level,
         coalesce(CAST(sum(source_size * 3) OVER w1 AS BIGINT), 0) AS spent
  FROM per
  WINDOW w1 AS (ORDER BY source_size * 3 / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         w2 AS (ORDER BY source_size * 3 / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
water AS (
  SELECT spent, level FROM lev WHERE level * weight <= cap ORDER BY spent, level LIMIT 1),
tgt AS (
  SELECT l.source, l.source_size,
         CASE WHEN w.spent IS NULL OR l.spent < w.spent THEN CAST(l.cap AS DOUBLE)
              ELSE least(CAST(l.cap AS DOUBLE), w.level * l.weight) END AS target
  FROM lev l LEFT JOIN water w ON true),
run AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CAST(floor(t.target) AS BIGINT) AS words,
         coalesce(CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.rank, s.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS seen
  FROM sized s JOIN tgt t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0
            ELSE (words // source_size) * size + greatest(0, least(size, words % source_size - seen)) END AS BIGINT) AS taken
FROM run
"""
