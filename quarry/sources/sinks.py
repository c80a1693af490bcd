"""Append-only targets (S9-S11) and the site config reader.

Targets are Parquet folders partitioned by ``content_date``; appends add
files, never rewrite.  Text bodies hold newlines, so bodies are stored as
Parquet columns; ``.text`` is an export only, never a file per row.

A run's rows can be appended as a batch that is seen whole or not at all
(``commit_batch``, ``read_committed``): a run that was cut off half way is
repeated under the same name and leaves the rows of one run.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructType

CONFIG_SCHEMA = "id long, name string, url_field string"
CONFIG_HEADER = "# id, name, url_field"


def read_site_config(spark: SparkSession, path: str) -> DataFrame:
    """Header line starts with '#', rows are (id, name, url|prefix)."""
    return (spark.read.schema(CONFIG_SCHEMA).option("comment", "#").option("encoding", "UTF-8")
                 .option("mode", "PERMISSIVE").csv(path))


def write_site_config(rows: DataFrame, path: str) -> None:
    spark = rows.sparkSession
    spark.createDataFrame([(CONFIG_HEADER,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    rows.select("id", "name", "url_field").write.mode("append").csv(path)


def append_partitioned(df: DataFrame, path: str, partition_col: str = "content_date") -> None:
    """Append, partitioned by content date (partition pruning for later key checks)."""
    df.write.mode("append").partitionBy(partition_col).parquet(path)


def append_press_release(rows: DataFrame, path: str) -> None:
    """S9."""
    append_partitioned(rows, path)


def append_story(rows: DataFrame, path: str) -> None:
    """S10."""
    append_partitioned(rows, path)


def write_text(df: DataFrame, path: str) -> None:
    """(filename, article_body) per article, partitioned by content_date."""
    df.select("filename", "article_body", "content_date").write.mode("append").partitionBy("content_date").parquet(path)


def read_target(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# ------------------------------------------------------------------ appends that are seen whole
_BATCH_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path


def committed_batches(spark: SparkSession, path: str) -> list[str]:
    """Names of the batches that belong to the target: one marker per run, so one entry per run."""
    fs, p, Path = _folder(spark, f"{path}/_committed")
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def commit_batch(df: DataFrame, path: str, batch: str, partition_col: str | None = None) -> bool:
    """Append ``df`` as ``batch``; False if that batch is already there, whose rows then stay as they are.

    The rows go to a folder of the batch's own, and an empty marker file, created last, makes them
    part of the target.  A folder without its marker is what a killed run left: nothing reads it, and
    the repeated run writes it anew.  Two runs must not write one batch at the same time."""
    if not _BATCH_NAME.fullmatch(batch):
        raise ValueError(f"batch name {batch!r}: letters, digits, dot, dash and underscore only")
    spark = df.sparkSession
    if batch in committed_batches(spark, path):
        return False
    w = df.write.mode("overwrite")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.parquet(f"{path}/batch={batch}")
    fs, marker, _ = _folder(spark, f"{path}/_committed/{batch}")
    fs.mkdirs(marker.getParent())
    fs.create(marker, False).close()
    return True


def read_committed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of all committed batches and ``batch``, the run that wrote each; none yet: no rows."""
    fields = spark.createDataFrame([], schema).schema
    full = StructType([f for f in fields if f.name != "batch"]).add("batch", StringType())
    names = committed_batches(spark, path)
    if not names:
        return spark.createDataFrame([], full)
    return (spark.read.schema(full).option("basePath", path)
            .parquet(*[f"{path}/batch={b}" for b in names]).select(*full.names))
