"""Text expressions: cleaning, keyword extraction, list-literal parsing.

Every expression runs inside the JVM (regexp_replace, higher-order ``filter``),
so whole texts are processed in whole-stage-codegen'd projections, never in Python.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The health keyword list, in the order symptoms are reported.
HEALTH_KEYWORDS = [
    "fever", "cough", "flu", "sick", "illness", "outbreak", "epidemic",
    "pandemic", "symptoms", "headache", "fatigue", "sore throat",
    "nausea", "vomiting", "diarrhea", "respiratory", "covid", "virus",
]

# The characters Python's ``str.split()`` treats as whitespace,
# written as a character class both Java regex and RE2 accept.
WHITESPACE_CLASS = (r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}"
                    r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
NON_WHITESPACE_CLASS = "[^" + WHITESPACE_CLASS[1:]
# Unicode word character (letters, numbers, underscore), the meaning of ``\w`` on str.
WORD_CLASS = r"[\p{L}\p{N}_]"
# Every whitespace character except the plain space.
OTHER_WHITESPACE_CLASS = WHITESPACE_CLASS.replace(" ", "")

# Fixed patterns: web links, then @mentions / #hashtags.
URL_PATTERN = "(?:http|www)" + NON_WHITESPACE_CLASS + "+"
TAG_PATTERN = "[@#]" + WORD_CLASS + "+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """Drop links, drop @mentions and #hashtags, collapse whitespace, trim, lowercase."""
    t = F.regexp_replace(_c(c), URL_PATTERN, "")
    t = F.regexp_replace(t, TAG_PATTERN, "")
    # Same result as replacing runs of whitespace by one space, but a plain single
    # space (by far the most common match) is left alone instead of rewritten.
    t = F.regexp_replace(t, OTHER_WHITESPACE_CLASS, " ")
    t = F.regexp_replace(t, "  +", " ")
    return F.lower(F.trim(t))


def extract_keywords(c, keywords=None) -> Column:
    """Ordered list of the keywords that occur (as substrings) in lower(text).

    NULL text gives NULL, like the per-row function it replaces would fail.
    """
    kws = list(keywords or HEALTH_KEYWORDS)
    # The text is bound once to the lambda variable ``t``; referring to the text
    # expression once per keyword would evaluate it (cleaning included) per keyword.
    def hits(t):
        found = F.array_compact(F.array(*[F.when(F.instr(t, k) > 0, F.lit(k)) for k in kws]))
        return F.when(t.isNotNull(), found)
    return F.element_at(F.transform(F.array(F.lower(_c(c))), hits), 1)


def contains_any(cols, keywords=None) -> Column:
    """True when any keyword is a substring of any of the lowercased columns."""
    kws = list(keywords or HEALTH_KEYWORDS)
    cols = [cols] if isinstance(cols, (str, Column)) else list(cols)
    terms = [F.coalesce(F.lower(_c(col)).contains(k), F.lit(False)) for col in cols for k in kws]
    return reduce(lambda a, b: a | b, terms)


def engagement_score(*cols) -> Column:
    """Sum of engagement counters (likes + retweets for tweets, score for reddit)."""
    return reduce(lambda a, b: a + b, [F.coalesce(_c(x), F.lit(0)) for x in cols])


def parse_list_literal(c) -> Column:
    """``"['fever', 'cough']"`` -> array<string>; text that is not a list gives NULL.

    Replaces evaluating file content as Python.  Elements are quoted by either quote
    character; a backslash in them escapes the next character, and the other quote
    character is an ordinary one (``"don't"``).
    """
    item = r"""('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")"""
    text = _c(c)
    inner = F.transform(F.regexp_extract_all(text, F.lit(item), 1),
                        lambda x: F.regexp_replace(F.substring(x, F.lit(2), F.length(x) - 2), r"\\(.)", "$1"))
    return F.when(text.rlike(rf"^\s*\[\s*({item}\s*(,\s*{item}\s*)*)?\]\s*$"), inner)
