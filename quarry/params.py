"""Run parameters: one frozen object instead of module-level globals.

``as_of`` stands in for the clock everywhere, so a rerun gives the same
answer.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

# Lists and limits the rules must share with the reference.
KEYWORD_SKIPS = (
    "PRNewswire", "Desarrollo Economico", "Asociacion Americana", "Gouvernement",
    "GLOBE NEWSWIRE", "Nueva", "Congreso", "BUSINESS WIRE", "sex", "Sex",
)
TITLE_REJECT_PHRASES = ("PrivateCitizen", "W-", "illegible", "anonymous")
SIGNER_PHRASES = ("Sincerely", "Respectfully")
ABSTRACT_PHRASES = ("research", "articles", "papers", "research article", "special article")
ARTICLE_MIN_CHARS = 100      # article dropped when length <= this
PDF_MIN_CHARS = 100          # pdf text dropped when length < this
MAX_INVALID_DATES = 4        # per journal, the walk stops after this many invalid dates
ABSTRACTS_PER_ISSUE = 3
PAGE_CAP = 40
HEADLINE_MAX = 254
PDF_TITLE_MAX = 85
ORIG_TEXT_MAX = 62000
POST_SIGNER_MAX = 100
STORY_SOURCE_ID = 98
STORY_UNAME = "C-PUBCOM"
COMMENT_HOST = "https://www.regulations.gov"


@dataclass(frozen=True)
class RunParams:
    as_of: _dt.date = _dt.date(2024, 1, 30)
    months_back: int = 0
    days_back: int = 7
    doc_limit: int = 0                      # 0 = all cards
    invalid_limit: int = MAX_INVALID_DATES
    abstracts_per_issue: int = ABSTRACTS_PER_ISSUE
    month_rule: str = "month_number"        # or "year_aware"
    keyword_skips: tuple = KEYWORD_SKIPS
    title_reject: tuple = TITLE_REJECT_PHRASES
    signers: tuple = SIGNER_PHRASES
    abstract_phrases: tuple = ABSTRACT_PHRASES
    extra: dict = field(default_factory=dict, compare=False)

    @property
    def as_of_str(self) -> str:
        return self.as_of.isoformat()
