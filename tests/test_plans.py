"""t6 scale layer: properties of the physical plans that must hold at any size."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

# queries whose one-row partial aggregate (a cut-off, a global metric or one
# count per partition) legitimately meets in one partition
ONE_ROW_FINALS = {"A6_run_metrics", "J6_follow_links", "O1_newest_first", "O3_stop_at_first_old", "O7_paginate",
                  "X3_comment_cards", "X4_comment_text", "X6_run_report"}
PYTHON_STAGE = re.compile(r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas|PythonMapInArrow|MapInArrow")


def _plan(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = E.queries()[name](spark, SF_SMALL)
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


# the streams run as they are built; the training-data queries have their own tests
@pytest.mark.parametrize("name", sorted(n for n in E.queries() if not n.startswith(("W", "op", "pipeline"))))
def test_plan_scales(spark, name):
    plan = _plan(spark, name)
    # no window over the whole data set in one task
    assert not re.search(r"Window \[[^\]]*\], \[\]", plan) or name == "O1_newest_first", plan
    if name not in ONE_ROW_FINALS:
        assert "Exchange SinglePartition" not in plan, plan
    # the page parse is read from its checkpoint: no Python stage in any query plan
    assert not PYTHON_STAGE.search(plan), plan
    # nested-loop joins only against a broadcast side (fixed templates or one-row cut-offs)
    assert "CartesianProduct" not in plan


def test_o1_window_is_over_partition_counts(spark):
    plan = _plan(spark, "O1_newest_first")
    # the only unpartitioned window runs over one row per partition (the offsets)
    for m in re.finditer(r"Window \[[^\]]*\], \[\]", plan):
        assert "_pid" in plan[m.start():m.start() + 400]


def test_scans_prune_columns(spark):
    plan = _plan(spark, "T1_ascii_fold")
    assert re.search(r"ReadSchema: struct<doc_id:bigint,text:string>", plan)
    plan = _plan(spark, "F11_in_day_window")
    assert re.search(r"ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>", plan)
