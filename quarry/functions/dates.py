"""Date operators (D1-D7, F11, F12): Column -> Column.

``as_of`` is always a parameter, never the clock.  Free-form date finding is
re-aimed as the leftmost match of a fixed list of forms (month day year, day
month year, month year, ISO, m/d/y); a missing day becomes 1.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.text import WS

# Parenthesised month abbreviations spelled out.
PAREN_MONTHS = (
    ("(jan)", "january"), ("(feb)", "february"), ("(mar)", "march"), ("(apr)", "april"),
    ("(may)", "may"), ("(jun)", "june"), ("(jul)", "july"), ("(aug)", "august"),
    ("(sep)", "september"), ("(oct)", "october"), ("(nov)", "november"), ("(dec)", "december"),
)
MONTH3 = "janfebmaraprmayjunjulaugsepoctnovdec"
MON = "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\\.?"

# Forms of a date (D5):
# (regex, group of year, group of month, group of day or None, month is a name).
DATE_FORMS = (
    (MON + WS + "+([0-9]{1,2}),?" + WS + "*([0-9]{4})", 3, 1, 2, True),
    ("([0-9]{1,2})" + WS + "+" + MON + ",?" + WS + "+([0-9]{4})", 3, 2, 1, True),
    (MON + ",?" + WS + "+([0-9]{4})", 2, 1, None, True),
    ("([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})", 1, 2, 3, False),
    ("([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})", 3, 1, 2, False),
)


def clean_date_text(c: Column) -> Column:
    """Lower, blanks collapsed, 'sept' -> 'sep', '(jan)' -> 'january' ..."""
    d = F.regexp_replace(F.lower(c), WS + WS + "*", " ")
    d = F.when(F.contains(d, F.lit("sept")) & ~F.contains(d, F.lit("september")),
               F.replace(d, F.lit("sept"), F.lit("sep"))).otherwise(d)
    for a, b in PAREN_MONTHS:
        d = F.replace(d, F.lit(a), F.lit(b))
    return d


def comma_field(c: Column) -> Column:
    """Second comma-separated part; null when there is none."""
    return F.get(F.split(c, ","), 1)


def comma_pp_title(c: Column) -> Column:
    """D3."""
    return F.substring_index(c, ", pp", 1)


def _month_no(m: Column) -> Column:
    return ((F.instr(F.lit(MONTH3), m) - 1) / 3 + 1).cast("int")


def _form_template(gy, gm, gd, ref: str) -> str:
    """Replacement that rewrites a match of a form to ``year|month|day``."""
    day = f"{ref}{gd}" if gd else "1"
    return f"{ref}{gy}|{ref}{gm}|{day}"


# any form; at one place in the text the forms are tried in their order
ANY_DATE = "|".join("(?:" + rx.replace("(", "(?:") + ")" for rx, *_ in DATE_FORMS)


def parse_date(c: Column) -> Column:
    """The first date in the text, whatever its form; null when there is none.
    Expects lower-case text (D1 runs first).  All hits of any form are taken from left to right,
    each is rewritten to ``y|m|d`` by the first form it has, and the first that is a date counts:
    february 30 is passed over.  A missing day is 1."""
    def one(hit):
        cands = []
        for rx, gy, gm, gd, named in DATE_FORMS:
            parts = F.split(F.regexp_replace(hit, rx, _form_template(gy, gm, gd, "$")), "\\|")
            m = F.get(parts, 1)
            if named:
                m = _month_no(m).cast("string")
            s = F.concat_ws("-", F.get(parts, 0), F.lpad(m, 2, "0"), F.lpad(F.get(parts, 2), 2, "0"))
            cands.append(F.when(F.rlike(hit, F.lit("^(?:" + rx + ")$")), F.try_to_date(s, "yyyy-MM-dd")))
        return F.coalesce(*cands)
    hits = F.transform(F.regexp_extract_all(c, F.lit(ANY_DATE), 0), one)
    return F.get(F.filter(hits, lambda d: d.isNotNull()), 0)


def formatting_steps(text: Column, steps: str) -> Column:
    """``~`` list; 'swap' = lenient parse, other text = remove it, then parse."""
    d = text
    for s in steps.split("~"):
        if s not in ("", "swap"):
            d = F.replace(d, F.lit(s), F.lit(""))
    return parse_date(d)


def parse_posted(c: Column) -> Column:
    """``Jun 6, 2025``; unparsable -> null (a reason upstream)."""
    return F.try_to_date(F.trim(c), "MMM d, yyyy")


def format_iso(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def format_month_year(d: Column) -> Column:
    return F.date_format(d, "MMMM yyyy")


def format_dateline(d: Column) -> Column:
    return F.date_format(d, "MMM. dd")


def format_prompt_date(d: Column) -> Column:
    return F.date_format(d, "MMMM, d")


def in_day_window(d: Column, as_of: Column, days_back: int) -> Column:
    """0 <= as_of - d <= days_back; future dates are out."""
    return F.datediff(as_of, d).between(0, days_back)


def in_month_window(d: Column, as_of: Column, months_back: int, rule: str = "month_number") -> Column:
    """month number <= current month - n (year ignored, as the reference);
    ``year_aware`` compares whole months instead."""
    if rule == "year_aware":
        diff = (F.year(as_of) * 12 + F.month(as_of)) - (F.year(d) * 12 + F.month(d))
        return diff >= months_back
    return F.month(d) <= F.month(as_of) - months_back
