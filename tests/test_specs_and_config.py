"""Config CSV, templates, selector grammar."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.functions.text import split_url_field
from quarry.operators.joins import template_match
from quarry.sources import sinks
from quarry.sources.specs import (TEMPLATE_WIDTH, TEMPLATES, SpecError, check_slices, parse_spec, spec_steps,
                                  templates_df)

HEADER = "# journal_id,  Journal Name,    url_field" + ",x" * 16


def test_config_csv(spark):
    d = tempfile.mkdtemp(prefix="quarry-cfg-")
    path = os.path.join(d, "WebsiteData.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write(HEADER + "\n")
        f.write("1,Journal A,https://journals.lww.com/a/issues|https://journals.lww.com\n")
        f.write("2,Journal B,https://journals.sagepub.com/loi/B\n")
        f.write("\n")
        f.write('3,"Journal, C",https://unknown.example.org/c|https://unknown.example.org\n')
    cfg = sinks.read_site_config(spark, path).orderBy("id")
    rows = cfg.collect()
    assert [r["id"] for r in rows] == [1, 2, 3]
    assert rows[2]["name"] == "Journal, C"
    full, prefix = split_url_field(F.col("url_field"))
    p = cfg.select("id", full.alias("full"), prefix.alias("prefix")).orderBy("id").collect()
    assert p[1]["prefix"] == "" and p[0]["prefix"] == "https://journals.lww.com"
    t = spark.createDataFrame([(i, k, line) for i, (k, line) in enumerate(TEMPLATES)],
                              "prio int, keyword string, template string")
    m = template_match(cfg.select(F.col("id").alias("row_id"), "url_field"), "url_field", t).orderBy("row_id").collect()
    assert [r["keyword"] for r in m] == ["lww", "sagepub", None]       # unknown domain: no_template


def test_template_widths(spark):
    t = templates_df(spark).select("keyword", "width").distinct().collect()
    widths = {r["keyword"]: r["width"] for r in t}
    assert widths["psycnet"] < TEMPLATE_WIDTH                            # rejected: csv_line
    assert widths["sagepub"] == TEMPLATE_WIDTH and widths["lww"] == TEMPLATE_WIDTH


def test_spec_grammar():
    alts = parse_spec("find|class|a~find_all|elem|li")
    assert len(alts) == 1 and [s.mode for s in alts[0]] == ["find", "find_all"]
    assert parse_spec("find_all|elem|span|1|2")[0][0].ints == (1, 2)
    assert parse_spec("find_all|elem|span|-1")[0][0].ints == (-1,)
    assert parse_spec("find_all|elem|span|None|2")[0][0].ints == (None, 2)
    assert len(parse_spec("find|elem|x<>find|elem|y")) == 2
    with pytest.raises(SpecError):
        parse_spec("find|elem")
    with pytest.raises(SpecError):
        check_slices(parse_spec("find|elem|a|1"))


def test_spec_steps_table(spark):
    specs = ["find|class|a~find_all|elem|li", "find_all|elem|span|1|2", "find_all|elem|span|-1",
             "find_all|elem|span|None|2", "find|elem|x<>find|elem|y", "find|elem", "find|elem|a|1"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(specs)], "n int, spec string")
    rows = spec_steps(df).orderBy("n", "alt", "step").collect()
    by = {}
    for r in rows:
        by.setdefault(r["n"], []).append(r)
    assert len(by[0]) == 2 and by[0][1]["name"] == "li"
    assert (by[1][0]["i1"], by[1][0]["i2"]) == (1, 2)
    assert by[3][0]["i1"] is None and by[3][0]["i2"] == 2
    assert [r["alt"] for r in by[4]] == [0, 1]
    assert by[5][0]["reason"] == "csv_line" and by[6][0]["reason"] == "csv_line"
    assert all(r["reason"] is None for n in range(5) for r in by[n])


def test_flags_and_by_id(spark):
    from quarry.operators.rules import by_id, multi_issue_flag, nonblank_flag, parse_flag
    df = spark.createDataFrame([(1, "True", "", "find|a|b~find_all|elem|li"), (2, "False", "x", "find|elem|a"),
                                (3, None, None, None)], "id long, lp string, bp string, cont string")
    r = df.select(parse_flag(F.col("lp")).alias("a"), nonblank_flag(F.col("bp")).alias("b"),
                  multi_issue_flag(F.col("cont")).alias("c")).collect()
    assert [(x["a"], x["b"], x["c"]) for x in r] == [(True, False, True), (False, True, False), (False, False, False)]
    assert [x["id"] for x in by_id(df, "id", "2").collect()] == [2]
