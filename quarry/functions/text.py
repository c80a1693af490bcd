"""Text clean-up and projections (T3-T10, P1-P13): Column -> Column.

All are built-in expressions, so they stay inside whole-stage codegen.
Regular expressions are written in the subset shared by Java, RE2 and
Python.  ``\\s`` is expanded to Python's ASCII whitespace set so the three
engines agree (Java and RE2 disagree on vertical tab and the 0x1C-0x1F
separators).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry import params as P

WS = "[\\t\\n\\x0B\\f\\r\\x1C-\\x1F ]"        # Python's \s restricted to ASCII
WS_NO_NL = "[\\t\\x0B\\f\\r\\x1C-\\x1F ]"     # [^\S\n]


def py_ws(pattern: str) -> str:
    """Rewrite ``\\s`` / ``[^\\S\\n]`` to explicit classes."""
    return pattern.replace("[^\\S\\n]", WS_NO_NL).replace("\\s", WS)


# Boilerplate removed from every article (T3), in order.  The
# two Washington patterns are one pattern in the reference (no comma between
# the two string literals), kept that way.
BOILERPLATE_PATTERNS = (
    r"#\s?#\s?#",
    r"\*\s?\*\s?\*\s",
    r"\s*Image\s*",
    r"FOR IMMEDIATE RELEASE(:)?",
    r"[wW][aA][sS][hH][iI][nN][gG][tT][oO][nN],?\s?[dD]\.?[cC]\s*\.?\s*--*\s?"
    r"\s?[dD]\.?[cC]\s*\.?\s*--*\s*",
    r"##\s\s",
    r">\s",
    r"\s~~~~\s",
)

# A literal every match of the boilerplate pattern at the same position
# contains (lower-cased text for the case-insensitive one): the regex runs
# only on rows that contain it, which gives the same result.
BOILERPLATE_GUARDS = ("#", "*", "Image", "FOR IMMEDIATE RELEASE", None, "##", "> ", "~~~~")

# Article body whitespace rules (T5), in order, as (pattern, replacement).
WHITESPACE_RULES = (
    (r"\n\s*\n", "\n\n"),
    (r"(\r\n|\r|\n)+", "\n\n"),
    (r"\.[^\S\n]+", ". "),
    (r"\s*\.", "."),
    (r"\s*,", ","),
    (r"  ", " "),
    (r'\."[^\S\n]+', '." '),
)

# The same rules in fewer passes.  A run of CR/LF is any mix of the three alternatives; the first rule only
# joins runs of them that blanks part, and what it leaves is rewritten by the second.  A zero-length run of
# blanks before '.' or ',' only rewrites the mark by itself, and blanks before one mark are none of the other's.
# The oracle runs the original patterns; tests compare both with Python's re.
WHITESPACE_PASSES = (
    (r"(?=[\r\n])(?:[\r\n]*\n\s*\n[\r\n]*|[\r\n]+)", "\n\n"),
    (r"\.[^\S\n]+", ". "),
    (r"\s+([.,])", "$1"),
    (r"  ", " "),
    (r'\."[^\S\n]+', '." '),
)

# AP style month names (index 1..12) used in ledes.
AP_MONTHS = ("Jan.", "Feb.", "March", "April", "May", "June", "July", "Aug.",
             "Sept.", "Oct.", "Nov.", "Dec.")


def regex_chain(c: Column, rules) -> Column:
    for pat, rep in rules:
        # without a blank to expand, a text of blanks is a literal
        c = F.regexp_replace(c, py_ws(pat), rep) if pat.strip() else F.replace(c, F.lit(pat), F.lit(rep))
    return c


def strip_boilerplate(c: Column) -> Column:
    """T3.  A pattern can only match where its required literal occurs, so the
    chain runs only on rows holding one of them (a byte search each); other
    rows pass through unchanged.  One guard around the whole chain keeps the
    expression linear."""
    hit = None
    for guard in BOILERPLATE_GUARDS:
        h = F.contains(F.lower(c), F.lit("washington")) if guard is None else F.contains(c, F.lit(guard.strip()))
        hit = h if hit is None else (hit | h)
    return F.when(hit, regex_chain(c, [(p, "") for p in BOILERPLATE_PATTERNS])).otherwise(c)


def normalise_whitespace(c: Column) -> Column:
    """T5."""
    return regex_chain(c, WHITESPACE_PASSES)


def drop_headline(text: Column, head: Column) -> Column:
    """T4: literal removal; an empty headline leaves the text alone."""
    return F.when(F.length(head) > 0, F.replace(text, head, F.lit(""))).otherwise(text)


def first_contained(text: Column, words, case_sensitive: bool = True) -> Column:
    """F3/F4 helper: first word of ``words`` (list order) contained in text, else null."""
    arr = F.array(*[F.lit(w) for w in words])
    if case_sensitive:
        hit = F.filter(arr, lambda w: F.contains(text, w))
    else:
        hit = F.filter(arr, lambda w: F.contains(F.lower(text), F.lower(w)))
    return F.get(hit, 0)


def signer_split(text: Column, signers=P.SIGNER_PHRASES):
    """(post-signer text up to the next signer, 100 chars; phrase) or nulls."""
    post = None
    phrase = None
    for s in reversed(signers):
        piece = F.left(F.get(F.split(text, _regex_quote(s)), 1), F.lit(P.POST_SIGNER_MAX))
        found = F.contains(text, F.lit(s))
        post = F.when(found, piece) if post is None else F.when(found, piece).otherwise(post)
        phrase = F.when(found, F.lit(s)) if phrase is None else F.when(found, F.lit(s)).otherwise(phrase)
    return post, phrase


def _regex_quote(s: str) -> str:
    out = []
    for ch in s:
        out.append("\\" + ch if ch in ".^$*+?()[]{}|\\-" else ch)
    return "".join(out)


def route_box(post_signer: Column, body: Column) -> Column:
    """T7: 'E' when a signer was found or the body mentions a coalition."""
    return F.when(post_signer.isNotNull() | F.contains(body, F.lit("coalition")), F.lit("E")).otherwise(F.lit("D"))


def split_reply(reply: Column):
    """(headline, rest).  No newline -> rest is null (reason upstream)."""
    parts = F.split(reply, "\n", 2)
    return F.get(parts, 0), F.get(parts, 1)


def signer_comment(post: Column, phrase: Column) -> Column:
    """T9."""
    return F.when(post.isNotNull(),
                  F.concat(F.lit("Signer phrase found: "), phrase,
                           F.lit("\nPost Signer Text:\n\n"), post)).otherwise(F.lit(""))


# ----------------------------------------------------------------- projections

def split_url_field(url_field: Column):
    """``full|prefix`` -> (full, prefix or '')."""
    parts = F.split(url_field, "\\|")
    return F.get(parts, 0), F.coalesce(F.get(parts, 1), F.lit(""))


def issue_link(href: Column, prefix: Column) -> Column:
    """P5, links of issues: prefix + href without the blanks around it."""
    return F.concat(prefix, F.regexp_replace(href, "^" + WS + "+|" + WS + "+$", ""))


def abstract_link(href: Column, prefix: Column) -> Column:
    """P5, links of abstracts: as they are; those on the lww host keep no prefix."""
    return F.when(F.contains(href, F.lit("lww")), href).otherwise(F.concat(prefix, href))


def truncate(c: Column, n: int) -> Column:
    """P6."""
    return F.left(c, F.lit(n))


def article_filename(agency_filename: Column, d: Column, head: Column) -> Column:
    """``$H `` + agency filename + yymmdd + last 10 chars of head."""
    return F.concat(F.lit("$H "), agency_filename, F.date_format(d, "yyMMdd"), F.right(head, F.lit(10)))


def comment_filename(comment_id: Column, pdf_title: Column) -> Column:
    """P8."""
    return F.concat(F.lit("$H-PUBCOM-"), F.substring_index(comment_id, "-", 1),
                    F.left(pdf_title, F.lit(P.PDF_TITLE_MAX)))


def post_headline(journal: Column, head: Column) -> Column:
    """P9."""
    return F.concat(F.lit("The "), journal, F.lit(" posted research article in '"), head, F.lit("'"))


def article_body(as_of: Column, post_head: Column, description: Column, url: Column) -> Column:
    """P10: dateline, headline, '*', description, '***', source link."""
    dateline = F.date_format(as_of, "MMM. dd")
    return F.concat(F.lit("\nWASHINGTON, "), dateline, F.lit(" -- "), post_head, F.lit(":\n*\n"),
                    description, F.lit("\n\n***\n\nOriginal text here: "), url)


def story_body(body: Column, link: Column) -> Column:
    """Body with leading blanks and newlines removed, then the link line."""
    return F.concat(F.regexp_replace(body, "^" + WS + "+", ""),
                    F.lit("\n\n***\n\nRead full text of letter here: "), link)


def orig_text(pdf_text: Column, prompt: Column) -> Column:
    """P12."""
    return F.concat(F.left(pdf_text, F.lit(P.ORIG_TEXT_MAX)), F.lit("\n\n *** Prompt Below *** \n\n"), prompt)


def ap_dateline(lede: Column, d: Column) -> Column:
    """Replace ``DATE`` in a lede with AP month and day."""
    months = F.array(*[F.lit(m) for m in AP_MONTHS])
    md = F.concat(F.element_at(months, F.month(d)), F.lit(" "), F.dayofmonth(d).cast("string"))
    return F.replace(lede, F.lit("DATE"), md)


# Windows-1252 characters MySQL's latin1 keeps besides U+0000-U+00FF.
CP1252_EXTRA = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
LATIN1_KEEP = "[^\\x00-\\x7F\\xA0-\\xFF\\x81\\x8D\\x8F\\x90\\x9D" + CP1252_EXTRA + "]"


def to_latin1(c: Column) -> Column:
    """CONVERT(x USING latin1): unmappable characters become '?'."""
    return F.regexp_replace(c, LATIN1_KEEP, "?")


def bad_characters(text: Column) -> Column:
    """Characters outside the accepted set, joined."""
    return F.regexp_replace(text, "[a-zA-Z0-9\\t\\n\\x0B\\f\\r\\x1C-\\x1F `~!@#$%^&*()_+\\-={}|:;<>?,./\\\\\"'\\[\\]]", "")
