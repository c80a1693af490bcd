"""Corpus preparation: stages over ``documents``, each written as Parquet and read again.

Every stage function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``docs``.  Near-duplicates, here and in the stages, are documents whose sets of
five-word shingles are 80 percent alike.

A stage's result is to be written before the next stage starts.  Then the tables that the stage kept
on the way are of no more use, and the next stage removes them first.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.common import remove, scratch_scope, table, written
from quarry.llm.decontaminate import without_leaks
from quarry.llm.linededup import dedup_lines
from quarry.llm.minhash import keep_one
from quarry.llm.mixing import mix
from quarry.llm.quality import keep


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat an earlier one; a document left without words goes."""
    return dedup_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with an item of ``benchmark``."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with size, source_size, target and taken: the words the mix takes of each."""
    return mix(docs)


_left: list[str] = []               # scratch folders of the stage before


def _tidy(stage):
    """``stage`` that first removes what the stage before it kept."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove(spark, _left)
        _left.clear()
        with scratch_scope(_left):
            return stage(spark, docs, sf_dir)
    return run_stage


STAGES = [(name, _tidy(stage)) for name, stage in (
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for k, (_, stage) in enumerate(STAGES):
        made: list[str] = []
        result = stage(spark, docs, sf_dir)
        with scratch_scope(made):
            docs = written(result, f"stage-{k + 1}")
        remove(spark, before)               # the stage's input; its result is written
        before = made
    return docs


# the overlaps of decontamination are ungapped extensions, which SQL does not express; see
# tests/llm for the brute-force version of all stages
ORACLE_SQL = None
