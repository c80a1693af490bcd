"""Render the shared fixed values (patterns, fold tables) as DuckDB SQL.

Used only by the oracle queries: the Spark side builds Column expressions
from the same constants, the oracle runs them on another engine.
"""

from __future__ import annotations

from quarry.functions.fold import fold_sql
from quarry.functions.text import BOILERPLATE_PATTERNS, WHITESPACE_RULES, py_ws


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def regex_chain(expr: str, rules) -> str:
    for pat, rep in rules:
        expr = f"regexp_replace({expr}, {lit(py_ws(pat))}, {lit(rep)}, 'g')"
    return expr


def strip_boilerplate(expr: str) -> str:
    return regex_chain(expr, [(p, "") for p in BOILERPLATE_PATTERNS])


def normalise_whitespace(expr: str) -> str:
    return regex_chain(expr, WHITESPACE_RULES)


def fold(expr: str, table: str) -> str:
    inner = fold_sql(expr, table)
    return f"(CASE WHEN regexp_matches({expr}, '[^\\x00-\\x7F]') THEN {inner} ELSE {expr} END)"


def first_contained(expr: str, words, case_sensitive: bool = True) -> str:
    arr = "[" + ", ".join(lit(w) for w in words) + "]"
    if case_sensitive:
        return f"list_filter({arr}, lambda w: contains({expr}, w))[1]"
    return f"list_filter({arr}, lambda w: contains(lower({expr}), lower(w)))[1]"


def clean_date_text(expr: str) -> str:
    from quarry.functions.dates import PAREN_MONTHS
    from quarry.functions.text import WS
    d = f"regexp_replace(lower({expr}), {lit(WS + WS + '*')}, ' ', 'g')"
    d = f"(CASE WHEN contains({d}, 'sept') AND NOT contains({d}, 'september') THEN replace({d}, 'sept', 'sep') ELSE {d} END)"
    for a, b in PAREN_MONTHS:
        d = f"replace({d}, {lit(a)}, {lit(b)})"
    return d


def parse_date(expr: str) -> str:
    from quarry.functions.dates import ANY_DATE, DATE_FORMS, MONTH3, _form_template
    cands = []
    for rx, gy, gm, gd, named in DATE_FORMS:
        parts = f"string_split(regexp_replace(hit, {lit(rx)}, {lit(_form_template(gy, gm, gd, chr(92)))}), '|')"
        m = f"{parts}[2]"
        if named:
            m = f"CAST((instr('{MONTH3}', {m}) - 1) // 3 + 1 AS VARCHAR)"
        s = f"concat_ws('-', {parts}[1], lpad({m}, 2, '0'), lpad({parts}[3], 2, '0'))"
        cands.append(f"CASE WHEN regexp_full_match(hit, {lit(rx)}) THEN CAST(try_strptime({s}, '%Y-%m-%d') AS DATE) END")
    hits = f"list_transform(regexp_extract_all({expr}, {lit(ANY_DATE)}), lambda hit: coalesce({', '.join(cands)}))"
    return f"list_filter({hits}, lambda d: d IS NOT NULL)[1]"


def signer_split(expr: str, signers):
    """(post, phrase) as SQL: first signer present, text after it up to the next."""
    post, phrase = "NULL", "NULL"
    for s in reversed(signers):
        piece = f"left(string_split({expr}, {lit(s)})[2], 100)"
        post = f"(CASE WHEN contains({expr}, {lit(s)}) THEN {piece} ELSE {post} END)"
        phrase = f"(CASE WHEN contains({expr}, {lit(s)}) THEN {lit(s)} ELSE {phrase} END)"
    return post, phrase


def strip_py(expr: str) -> str:
    from quarry.functions.text import WS
    return f"regexp_replace({expr}, {lit('^' + WS + '+|' + WS + '+$')}, '', 'g')"
