"""Ordered and limiting operators.

A walk order is a sortable key column: ascending key = walk order.  No
operator here uses a window without a partition (that is one task), and no
per-group window runs over a whole group that may be hot: per-group
cut-offs come from a salted two-phase top-k, which is exact because the
global first k are among the first k of every salt bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALT_BUCKETS = 64


def newest_first_key(ts: str = "ts", tie: str = "event_id") -> Column:
    """O1: newest first, id as tie-break, as one ascending struct key."""
    return F.struct((-F.unix_micros(F.col(ts).cast("timestamp"))).alias("t"), (-F.col(tie)).alias("i"))


def newest_first(df: DataFrame, ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """O1: a total order (range-partitioned sort)."""
    return df.orderBy(F.desc(ts), F.desc(tie))


def global_position(df: DataFrame, key: str, checkpoint: bool = True) -> DataFrame:
    """1-based position in key order without a single-task window:
    range-sort, (reliably) checkpoint so both passes see the same rows,
    count rows per partition, prefix-sum the counts (one row per partition,
    a proven bound) and add the offset to the row index inside the
    partition."""
    from quarry.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    s = df.orderBy(key)
    s = s.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    if checkpoint:
        s = s.checkpoint(eager=True)
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_pid", "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = s.join(F.broadcast(offs), "_pid")
    return out.withColumn("pos", F.col("_off") + (F.col("_mid") - F.col("_first")) + 1).drop("_pid", "_mid", "_first", "_off")


def doc_limit(df: DataFrame, n: int, ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """O2: the first n in walk order, counted before any filter; 0 = all.
    A top-n (TakeOrdered) keeps n rows per task, never the whole input."""
    if not n:
        return df
    return df.orderBy(F.desc(ts), F.desc(tie)).limit(n)


def first_stop_cutoff(df: DataFrame, key: str, is_stop: Column) -> DataFrame:
    """O3 helper: one row, the walk key of the first stopping row (or null)."""
    return df.where(is_stop).agg(F.min(F.col(key)).alias("_cut"))


def stop_at_first(df: DataFrame, key: str, is_stop: Column) -> DataFrame:
    """O3: keep rows strictly before the first stopping row and flag it.
    The cut-off is a one-row aggregate (partial per task), broadcast back."""
    cut = F.broadcast(first_stop_cutoff(df, key, is_stop))
    j = df.crossJoin(cut)
    return (j.withColumn("before_stop", F.col("_cut").isNull() | (F.col(key) < F.col("_cut")))
             .withColumn("is_stop_row", F.col("_cut").isNotNull() & (F.col(key) == F.col("_cut")))
             .drop("_cut"))


def _salted_topk(df: DataFrame, group: str, key: str, k: int, salt_buckets: int = SALT_BUCKETS) -> DataFrame:
    """First k rows per group in key order; exact, and no task sees more
    than its salt bucket of a hot group in phase one, k x buckets in two."""
    salt = F.pmod(F.xxhash64(F.col(key)), F.lit(salt_buckets))
    w1 = Window.partitionBy(group, "_salt").orderBy(key)
    phase1 = (df.withColumn("_salt", salt).withColumn("_r1", F.row_number().over(w1))
                .where(F.col("_r1") <= k).drop("_r1"))
    w2 = Window.partitionBy(group).orderBy(key)
    return phase1.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k).drop("_salt")


def stop_after_n_invalid(df: DataFrame, group: str, key: str, invalid: str, n: int = 4) -> DataFrame:
    """Per group the walk stops once n dates were invalid.  A row is
    looked at when fewer than n invalid rows come before it; adds
    ``looked_at``.  The n-th invalid row of each group comes from a salted
    top-n over invalid rows only, then joins back (AQE: broadcast if small,
    skew split if not)."""
    nth = (_salted_topk(df.where(F.col(invalid)).select(group, key), group, key, n)
           .where(F.col("rank") == n).select(group, F.col(key).alias("_nth")))
    j = df.join(nth, group, "left")
    return j.withColumn("looked_at", F.col("_nth").isNull() | (F.col(key) <= F.col("_nth"))).drop("_nth")


def first_k_per_group(df: DataFrame, group: str, key: str, k: int) -> DataFrame:
    """First k accepted rows per group (filter first), adds ``rank``."""
    return _salted_topk(df, group, key, k)


def paginate(page_no: str, card_pos: str) -> Column:
    """Position across pages = (page number, position on the page)."""
    return F.struct(F.col(page_no), F.col(card_pos))
