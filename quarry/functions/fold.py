"""Character folding tables (T1 ascii_fold, T2 transliterate).

* T1 is one fixed table.
* T2 is a rule plus fixed values: a Latin letter in U+00C0..U+017E folds to the ASCII letters of
  its compatibility decomposition with the combining marks removed (``é`` -> ``e``); the fixed
  values override the rule or add symbols.

Whatever is still outside ASCII afterwards is removed.  The tables are turned into one
``translate`` (single-character results and deletions) plus a short chain of ``replace`` (longer
results), all JVM-side expressions.  The same plan is rendered as DuckDB SQL for the oracle.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

NON_ASCII = "[^\\x00-\\x7F]"

# ---------------------------------------------------------------------------
# Fixed values (T1): the clean-up table, all of it, in its own order.
# ---------------------------------------------------------------------------
T1_TABLE = {
    "μ": "u", "\u009d": "", "\u00a0": " ", "¡": "i", "¢": "cents", "£": "pound sterling", "¤": "#", "¥": "Yen",
    "§§": "Sub Sec.", "§": "Sec.", "¨": "~", "©": " Copyright (c) ", "ª": "(a)", "«": "<<", "¬": " ", "–": "-",
    "—": "-", "\u00ad": "", "®": "(R)", "¯": "", "°": " degrees", "±": "+-", "²": "(2)", "³": "(3)", "´": "'",
    "µ": "u", "¶": "P", "·": ".", "¸": ",", "¹": "(1)", "º": "(o)", "»": "<<", "¼": "1/4", "½": "1/2", "¾": "3/4",
    "¿": "", "À": "A", "Á": "A", "Â": "A", "Ã": "A", "Ä": "A", "Å": "A", "Æ": "AE", "Ç": "C", "È": "E", "É": "E",
    "Ê": "E", "Ë": "E", "Ì": "I", "Í": "I", "Î": "I", "Ï": "I", "Ð": "D", "Ñ": "N", "Ò": "O", "Ó": "O", "Ô": "O",
    "Õ": "O", "Ö": "O", "×": "x", "Ø": "O", "Ù": "U", "Ú": "U", "Û": "U", "Ü": "U", "Ý": "Y", "Þ": "Th", "ß": "ss",
    "à": "a", "á": "a", "â": "a", "ã": "a", "ä": "a", "å": "a", "æ": "ae", "ç": "c", "è": "e", "é": "e", "ê": "e",
    "ë": "e", "ì": "i", "í": "i", "î": "i", "ï": "i", "ð": "d", "ñ": "n", "ò": "o", "ó": "o", "ô": "o", "õ": "o",
    "ö": "o", "÷": "/", "ø": "o", "ù": "u", "ú": "u", "û": "u", "ü": "u", "ý": "y", "þ": "p", "ÿ": "y", "Ā": "A",
    "ā": "a", "Ă": "A", "ă": "a", "Ą": "A", "ą": "a", "Ć": "C", "ć": "c", "Ĉ": "C", "ĉ": "c", "Ċ": "C", "ċ": "c",
    "Č": "C", "č": "c", "Ď": "D", "ď": "d", "Đ": "D", "đ": "d", "Ē": "E", "ē": "e", "Ĕ": "E", "ĕ": "e", "Ė": "E",
    "ė": "e", "Ę": "E", "ę": "e", "Ě": "G", "ě": "g", "Ĝ": "G", "ĝ": "g", "Ğ": "G", "ğ": "g", "Ġ": "G", "ġ": "g",
    "Ģ": "H", "ģ": "h", "Ĥ": "H", "ĥ": "h", "Ħ": "H", "ħ": "h", "Ĩ": "I", "ĩ": "i", "Ī": "I", "ī": "i", "Ĭ": "I",
    "ĭ": "i", "Į": "J", "į": "j", "İ": "J", "ı": "j", "Ĳ": "K", "ĳ": "k", "Ĵ": "k", "ĵ": "L", "Ķ": "l", "ķ": "L",
    "ĸ": "l", "Ĺ": "L", "ĺ": "l", "Ļ": "L", "ļ": "l", "Ľ": "l", "ľ": "L", "Ŀ": "l", "ŀ": "N", "Ł": "n", "ł": "N",
    "Ń": "n", "ń": "O", "Ņ": "o", "ņ": "O", "Ň": "o", "ň": "O", "ŉ": "o", "Ŋ": "R", "ŋ": "r", "Ō": "R", "ō": "r",
    "Ŏ": "R", "ŏ": "r", "Ő": "S", "ő": "s", "Œ": "S", "œ": "s", "Ŕ": "S", "ŕ": "s", "Ŗ": "T", "ŗ": "t", "Ř": "T",
    "ř": "t", "Ś": "Z", "ś": "z", "Ŝ": "Z", "ŝ": "z", "Ş": "Z", "ş": "z", "Š": "S", "š": "s", "Ţ": "T", "ţ": "t",
    "Ť": "T", "ť": "t", "Ŧ": "T", "ŧ": "t", "Ũ": "U", "ũ": "u", "Ū": "U", "ū": "u", "Ŭ": "U", "ŭ": "u", "Ů": "U",
    "ů": "u", "Ű": "u", "ű": "u", "Ų": "Z", "ų": "z", "Ŵ": "z", "ŵ": "Y", "Ŷ": "Z", "ŷ": "y", "Ÿ": "Y", "Ź": "Z",
    "ź": "z", "Ż": "Z", "ż": "z", "Ž": "Z", "ž": "z", "ʻ": "", "“": '"', "”": '"', "‘": "'", "’": "'", "‹": "<",
    "›": ">", "\u200b": " ", "\u2060": " ",
}

# ---------------------------------------------------------------------------
# Fixed values (T2): general transliteration of symbols and letters that have
# no decomposition, limited to Latin-1, Latin Extended-A and punctuation.
# ---------------------------------------------------------------------------
T2_FIXED = {
    " ": " ", "¡": "!", "¢": "C/", "£": "PS", "¤": "$?", "¥": "Y=",
    "¦": "|", "§": "SS", "¨": '"', "©": "(c)", "ª": "a", "«": "<<", "¬": "!",
    "­": "-", "®": "(r)", "¯": "-", "°": "deg", "±": "+-", "²": "2",
    "³": "3", "´": "'", "µ": "u", "¶": "P", "·": "*", "¸": ",", "¹": "1",
    "º": "o", "»": ">>", "¼": " 1/4", "½": " 1/2", "¾": " 3/4", "¿": "?",
    "Æ": "AE", "Ð": "D", "×": "x", "Ø": "O", "Þ": "Th", "ß": "ss",
    "æ": "ae", "ð": "d", "÷": "/", "ø": "o", "þ": "th",
    "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "ı": "i", "ĸ": "k", "Ŀ": "L",
    "ŀ": "l", "Ł": "L", "ł": "l", "ŉ": "'n", "Ŋ": "N", "ŋ": "n", "Œ": "OE",
    "œ": "oe", "Ŧ": "T", "ŧ": "t", "ſ": "s",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "--", "―": "--",
    "‘": "'", "’": "'", "‚": ",", "“": '"', "”": '"', "„": ",,", "†": "+",
    "‡": "++", "•": "*", "…": "...", "‹": "<", "›": ">", "€": "EUR", "™": "(tm)",
    "​": "", "⁠": "",
}

RULE_RANGE = (0x00C0, 0x017E)


def rule_fold(ch: str) -> str | None:
    """ASCII letters of the compatibility decomposition, or None."""
    base = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
    return base if base.isascii() and base.isalpha() else None


@lru_cache(maxsize=None)
def build_map(table: str) -> tuple[dict, dict]:
    """(sequence replacements, per-character map) for table 'T1' or 'T2'."""
    if table == "T1":
        return ({k: v for k, v in T1_TABLE.items() if len(k) > 1},
                dict(sorted((k, v) for k, v in T1_TABLE.items() if len(k) == 1)))
    chars = {}
    lo, hi = RULE_RANGE
    for cp in range(lo, hi + 1):
        r = rule_fold(chr(cp))
        if r is not None:
            chars[chr(cp)] = r
    chars.update(T2_FIXED)
    return {}, dict(sorted(chars.items()))


@lru_cache(maxsize=None)
def plan(table: str):
    """Split the map into: sequences, multi-character replaces, translate from/to."""
    seqs, chars = build_map(table)
    multi = [(k, v) for k, v in chars.items() if len(v) > 1]
    single = [(k, v) for k, v in chars.items() if len(v) == 1]
    drop = [k for k, v in chars.items() if v == ""]
    src = "".join(k for k, _ in single) + "".join(drop)
    dst = "".join(v for _, v in single)
    return list(seqs.items()), multi, src, dst


def fold_col(c: Column, table: str = "T1") -> Column:
    """T1 / T2 as one JVM expression; rows that are pure ASCII skip the work."""
    seqs, multi, src, dst = plan(table)
    out = c
    for k, v in seqs:
        out = F.replace(out, F.lit(k), F.lit(v))
    # one pass finds which of the characters with long results occur, each of those is replaced; the results are
    # ASCII, so their order is free
    rare = _class_escape("".join(k for k, _ in multi))
    found = F.array_distinct(F.regexp_extract_all(out, F.lit("(?=[^\\x00-\\x7F])([" + rare + "])"), 1))
    long = F.create_map(*[F.lit(x) for kv in multi for x in kv])
    out = F.aggregate(found, out, lambda text, ch: F.replace(text, ch, F.element_at(long, ch)))
    out = F.regexp_replace(F.translate(out, src, dst), NON_ASCII, "")
    return F.when(has_non_ascii(c), out).otherwise(c)


def has_non_ascii(c: Column) -> Column:
    """Characters vs bytes: no regex pass over the text."""
    return F.length(c) != F.octet_length(c)


def _class_escape(chars: str) -> str:
    return "".join("\\" + ch if ch in "\\^-[]" else ch for ch in chars)


def ascii_fold(c: Column) -> Column:
    """The comment pipeline's byte table, then non-ASCII dropped."""
    return fold_col(c, "T1")


def transliterate(c: Column) -> Column:
    """General transliteration (Latin-1, Latin Extended-A, punctuation)."""
    return fold_col(c, "T2")


def n_dropped(c: Column) -> Column:
    """Characters of ``c`` that no rule or value covers, and that are therefore dropped."""
    _, chars = build_map("T2")
    other = F.translate(c, "".join(chars), "")
    return F.when(has_non_ascii(c), F.length(F.regexp_replace(other, "[\\x00-\\x7F]+", ""))).otherwise(F.lit(0)).cast("long")


def dropped_chars(c: Column) -> Column:
    """The characters ``n_dropped`` counts, as an array in text order; null counts as empty."""
    _, chars = build_map("T2")
    left = F.when(has_non_ascii(c), F.translate(c, "".join(chars), "")).otherwise(F.lit(""))
    return F.regexp_extract_all(F.coalesce(left, F.lit("")), F.lit("([^\\x00-\\x7F])"), 1)


def fold_python(s: str, table: str = "T1") -> str:
    """Same plan in plain Python; used by tests as the brute-force side."""
    seqs, multi, src, dst = plan(table)
    for k, v in seqs + multi:
        s = s.replace(k, v)
    tr = {ord(a): b for a, b in zip(src, dst)}
    tr.update({ord(a): None for a in src[len(dst):]})
    s = s.translate(tr)
    return "".join(ch for ch in s if ord(ch) < 128)


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def fold_sql(expr: str, table: str = "T1") -> str:
    """The same plan as DuckDB SQL (oracle side)."""
    seqs, multi, src, dst = plan(table)
    out = expr
    for k, v in seqs + multi:
        out = f"replace({out}, {_sql_str(k)}, {_sql_str(v)})"
    out = f"translate({out}, {_sql_str(src)}, {_sql_str(dst)})"
    out = f"regexp_replace({out}, '[^\\x00-\\x7F]', '', 'g')"
    return out
