"""Site templates and selector specs as tables (S2, S3) and as plan input.

Selector grammar::

    spec := alt ("<>" alt)*       first alternative that finds something wins
    alt  := step ("~" step)*      each step searches inside the previous result
    step := mode "|" kind "|" name ("|" int-or-None){0,3}

The spec strings are configuration (a handful per site): they are parsed on
the driver into a small plan, and the same parse is available as a
DataFrame (``spec_steps``) for reporting malformed lines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Template field names (positions 3..18 of a template line).
TEMPLATE_FIELDS = (
    "journal_containers", "landing_page_gathering", "link_data", "headline_data",
    "headline_formatting_data", "date_data", "date_formatting_data", "journal_info_data",
    "journal_info_formatting", "journal_articles", "phrase_tag", "abstract_link",
    "abstract_text", "load_time", "bypass", "status",
)

# The shipped site templates (keyword, template line), in
# priority order.  The first has 15 fields and is rejected (csv_line).
TEMPLATES = (
    ("psycnet", ",,,find|class|volume-wrapper~find_all|elem|li,True,find|elem|a,find|elem|a,,"
                "find_all|elem|span|1|2,swap,find|class|list,,5,True,D"),
    ("sagepub", ",,,find|class|loi__issues~find_all|class|loi__issue,True,find|elem|a,find|elem|a,,"
                "find|class|loi__issue__cover-date,,find|class|table-of-content,,"
                "find_all|class|issue-item__container,find|class|issue-item__header~find_all|elem|span|2,"
                "find|elem|a,find_all|class|core-container|2~find|elem|div,5,True,D"),
    ("lww", ",,,find|class|AVList~find_all|class|AVIssueLink,True,find|elem|a,find|elem|a,,"
            "find|elem|a,,find|class|article-list,,find_all|class|content-box,find|elem|h3,"
            "find|elem|h4~find|elem|a,find|class|ejp-article-text-abstract,5,,D"),
)
TEMPLATE_WIDTH = 19


@dataclass(frozen=True)
class Step:
    mode: str            # find | find_all
    kind: str            # elem | class | id | any attribute name
    name: str
    ints: tuple          # up to 3 ints or None (slice or index)

    @property
    def find_all(self) -> bool:
        return self.mode == "find_all"


class SpecError(ValueError):
    pass


def parse_step(s: str) -> Step:
    parts = s.split("|")
    if len(parts) < 3 or len(parts) > 6:
        raise SpecError(f"step needs 3 to 6 fields: {s!r}")
    ints = []
    for p in parts[3:]:
        if "None" in p:
            ints.append(None)
        else:
            try:
                ints.append(int(p))
            except ValueError as e:
                raise SpecError(f"bad number in {s!r}") from e
    return Step(parts[0], parts[1], parts[2], tuple(ints))


def parse_spec(spec: str) -> list[list[Step]]:
    """spec -> alternatives -> steps; raises SpecError on a malformed step."""
    return [[parse_step(st) for st in alt.split("~")] for alt in spec.split("<>")]


def check_slices(alts: list[list[Step]]) -> None:
    """A slice needs find_all (the reference refuses slicing a single find)."""
    for alt in alts:
        for st in alt:
            if st.ints and not st.find_all:
                raise SpecError("cannot slice on a 'find' step")


def templates_df(spark: SparkSession) -> DataFrame:
    """Templates in long form (prio, keyword, field_no, field, spec) plus
    the line width; a template that is too short is flagged."""
    rows = [(i, k, line) for i, (k, line) in enumerate(TEMPLATES)]
    t = spark.createDataFrame(rows, "prio int, keyword string, template string")
    parts = F.split(F.col("template"), ",")
    return (t.select("prio", "keyword", "template", F.size(parts).alias("width"),
                     F.posexplode(parts).alias("field_no", "spec"))
             .where(F.col("field_no") >= 3)
             .withColumn("field", F.get(F.array(*[F.lit(f) for f in TEMPLATE_FIELDS]), F.col("field_no") - 3)))


def spec_steps(specs: DataFrame, spec_col: str = "spec") -> DataFrame:
    """S3: spec strings -> one row per (alt, step) with parsed parts.
    Malformed steps get ``reason = 'csv_line'``."""
    a = specs.select("*", F.posexplode(F.split(F.col(spec_col), "<>")).alias("alt", "alt_text"))
    s = a.select("*", F.posexplode(F.split(F.col("alt_text"), "~")).alias("step", "step_text"))
    p = F.split(F.col("step_text"), "\\|")
    n = F.size(p)

    def num(i):
        v = F.get(p, i)
        return F.when(F.contains(v, F.lit("None")), F.lit(None).cast("int")).otherwise(v.try_cast("int"))

    bad_num = F.lit(False)
    for i in (3, 4, 5):
        v = F.get(p, i)
        bad_num = bad_num | (v.isNotNull() & ~F.contains(v, F.lit("None")) & v.try_cast("int").isNull())
    reason = (F.when((n < 3) | (n > 6) | bad_num, F.lit("csv_line"))
               .when((n > 3) & (F.get(p, 0) != "find_all"), F.lit("csv_line")))
    return s.select(*specs.columns, "alt", "step",
                    F.get(p, 0).alias("mode"), F.get(p, 1).alias("kind"), F.get(p, 2).alias("name"),
                    num(3).alias("i1"), num(4).alias("i2"), num(5).alias("i3"),
                    reason.alias("reason"))
