"""D1-D7, F11, F12."""

import datetime as dt

from pyspark.sql import functions as F

from quarry.functions import dates as D


def test_is_within_days_back_cases(spark):
    today = F.lit("2025-06-06").cast("date")
    rows = [("Jun 6, 2025", 0, True), ("Jun 5, 2025", 1, True), ("Jun 5, 2025", 0, False),
            ("Jun 7, 2025", 3, False)]
    df = spark.createDataFrame(rows, "d string, n int, want boolean")
    for r in df.collect():
        got = spark.createDataFrame([(r["d"],)], "d string").select(
            D.in_day_window(D.parse_posted(F.col("d")), today, r["n"]).alias("ok")).first()["ok"]
        assert got == r["want"], r


def test_parse_posted(spark):
    df = spark.createDataFrame([("Jun 6, 2025",), ("Jun 06, 2025",), ("June 6, 2025",), ("garbage",)], "d string")
    got = [r["x"] for r in df.select(D.parse_posted(F.col("d")).alias("x")).collect()]
    assert got == [dt.date(2025, 6, 6), dt.date(2025, 6, 6), None, None]


def test_clean_and_parse_dates(spark):
    cases = [("Jun 6, 2025", dt.date(2025, 6, 6)), ("June 2025", dt.date(2025, 6, 1)),
             ("Sept 2024", dt.date(2024, 9, 1)), ("(jan) 2024", dt.date(2024, 1, 1)),
             ("no date", None), ("6 March 2023", dt.date(2023, 3, 6)), ("2022-11-05", dt.date(2022, 11, 5)),
             ("Feb 30, 2024", None)]
    df = spark.createDataFrame([(c,) for c, _ in cases], "d string")
    t = df.select(D.clean_date_text(F.col("d")).alias("c"))
    got = [r["x"] for r in t.select(D.parse_date(F.col("c")).alias("x")).collect()]
    assert got == [w for _, w in cases]


def test_comma_field_for_lww(spark):
    df = spark.createDataFrame([("Volume 3, May 2024, Issue 2",), ("no comma",)], "d string")
    c = df.select(D.comma_field(D.clean_date_text(F.col("d"))).alias("c"))
    got = [r["x"] for r in c.select(D.parse_date(F.col("c")).alias("x")).collect()]
    assert got == [dt.date(2024, 5, 1), None]


def test_month_window_ignores_year_and_january(spark):
    df = spark.createDataFrame([(dt.date(2023, 12, 1),), (dt.date(2024, 1, 1),)], "d date")
    jan = F.lit("2024-01-15").cast("date")
    r = df.select(D.in_month_window(F.col("d"), jan, 1).alias("m"),
                  D.in_month_window(F.col("d"), jan, 1, "year_aware").alias("y")).collect()
    assert [x["m"] for x in r] == [False, False]      # January, one month back: nothing (as the reference)
    assert [x["y"] for x in r] == [True, False]


def test_format_dates(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 5),)], "d date")
    r = df.select(D.format_iso(F.col("d")).alias("a"), D.format_month_year(F.col("d")).alias("b"),
                  D.format_dateline(F.col("d")).alias("c"), D.format_prompt_date(F.col("d")).alias("e")).first()
    assert (r["a"], r["b"], r["c"], r["e"]) == ("2024-01-05", "January 2024", "Jan. 05", "January, 5")
