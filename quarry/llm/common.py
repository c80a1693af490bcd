"""Word rule, table access and shared scratch tables for the operators here."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quarry.session import scratch_dir

# a word is a run of anything but blank, tab, newline, vertical tab, form feed, return
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RE = r"[\x20\x09-\x0D]+"

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text as an array; null and blank texts have none."""
    body = F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, BLANK_RE))


def plain_words(text: Column) -> Column:
    """As ``words``, without a pattern: Java splits at one plain character much faster."""
    for blank in BLANKS[1:]:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def n_words(text: Column) -> Column:
    body = F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(body == "", F.lit(0)).otherwise(F.size(F.split(body, BLANK_RE))).cast("long")


_scope: list[str] | None = None     # folders made inside the scope that is open


@contextlib.contextmanager
def scratch_scope(made: list[str]):
    """Folders that ``scratch_path`` gives inside go to ``made``, for ``remove`` once nothing reads them."""
    global _scope
    before, _scope = _scope, made
    try:
        yield
    finally:
        _scope = before


def remove(spark: SparkSession, folders: list[str]) -> None:
    """Remove scratch folders from the shared store."""
    jvm = spark.sparkContext._jvm
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    path = scratch_dir(spark, f"{name}-{uuid.uuid4().hex}")
    if _scope is not None:
        _scope.append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: lineage ends here,
    and what reads it again after a lost executor does not compute it again.

    Nothing else reads the shuffles of the write, so Spark is told to drop their files with it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, *read: str) -> DataFrame:
    """``df`` as ``_row``, a struct of all its columns, beside the columns that are read: no name that an
    operator gives meets one of the table's."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *read)


def unpacked(df: DataFrame, columns: list[str], *added: str) -> DataFrame:
    """The columns of ``_row``, without those named like an added one, and the added ones."""
    return df.select(*[F.col(f"_row.`{c}`") for c in columns if c not in added], *added)


def drop_clashing(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that an operator is about to add."""
    return df.drop(*[c for c in df.columns if c in names])


_IN_PART = (1 << 33) - 1            # rows of a partition in monotonically_increasing_id


def in_order(df: DataFrame, order: list, name: str) -> DataFrame:
    """``df`` with ``position`` (0, 1, 2... in the given order) and ``_part``, the task that holds the row.

    A range sort, written, so parts and places are fixed; a part's first position is the number of
    rows in the parts before it (a row per part, sent to all).  No task sees more than its part.
    Rows equal in all of ``order`` take positions in any order.
    """
    placed = written(df.repartitionByRange(*order).sortWithinPartitions(*order)
                     .withColumn("_place", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    parts = (placed.groupBy("_part").agg(F.count("*").alias("_n"))
             .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")).alias("_before")))
    return (placed.join(F.broadcast(written(parts, f"{name}-parts")), "_part")
            .withColumn("position", F.col("_before") + F.col("_place").bitwiseAND(F.lit(_IN_PART)))
            .drop("_before", "_place"))
