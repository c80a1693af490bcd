"""De-duplication against a target and within a batch.

``insert_if_absent`` answers both questions with one keyed aggregation over
the union of stored keys and batch keys: partial aggregation combines
map-side, so a key holding a third of all rows is reduced before the
shuffle.  The per-key result is joined back; AQE turns that join into a
broadcast when the key table is small and splits skewed partitions when
it is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def existing_keys(target: DataFrame, key: str = "filename") -> DataFrame:
    """Keys already stored; read once per run, pruned to one column."""
    return target.select(key)


def not_already_stored(df: DataFrame, target: DataFrame, key: str = "filename") -> DataFrame:
    """Rows whose key is not in the target."""
    return df.join(existing_keys(target, key), key, "left_anti")


def insert_if_absent(df: DataFrame, target: DataFrame | None, key: str, order_col: str,
                     eligible=None) -> DataFrame:
    """Adds ``is_duplicate``: key already stored, or not the first row of
    its key in ``order_col`` order.  Rows that are not ``eligible`` (already
    rejected), and rows without a key, take no part and get null: they stay
    out of the join, so a missing key is no hot key."""
    elig = F.lit(True) if eligible is None else eligible
    takes_part = F.coalesce(elig & F.col(key).isNotNull(), F.lit(False))
    batch = df.where(takes_part).select(
        key, F.col(order_col).alias("_o"), F.lit(False).alias("_stored"))
    keys = batch
    if target is not None:
        stored = target.select(key, F.lit(None).cast(batch.schema["_o"].dataType).alias("_o"),
                               F.lit(True).alias("_stored"))
        # only stored keys that meet the batch matter: a semi join (and the
        # runtime bloom filter) before the aggregation
        stored = stored.join(batch.select(key).distinct(), key, "left_semi")
        keys = batch.unionByName(stored)
    stats = keys.groupBy(key).agg(F.min("_o").alias("_first"), F.max("_stored").alias("_in_target"))
    out = (df.where(takes_part).join(stats, key)
           .withColumn("is_duplicate", F.col("_in_target") | (F.col(order_col) != F.col("_first"))).drop("_first", "_in_target"))
    rest = df.where(~takes_part).withColumn("is_duplicate", F.lit(None).cast("boolean"))
    return out.select(*rest.columns).unionByName(rest)
