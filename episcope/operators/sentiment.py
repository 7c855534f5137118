"""Lexicon sentiment as a Spark job.

Polarity and subjectivity of a text are the means of the lexicon scores of its
words (0 / 0 when no word is known).  A small lexicon is inlined as a map literal
and evaluated with higher-order functions inside the projection: no explode, no
shuffle, whole texts.  A lexicon given as a DataFrame is joined instead
(broadcast when its size check passes).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episcope.functions.text import WORD_CLASS
from episcope.operators.joins import bounded_broadcast

# Our own small lexicon, word -> (polarity, subjectivity).
LEXICON = {
    "good": (0.6, 0.6), "great": (0.8, 0.75), "better": (0.5, 0.5), "best": (0.9, 0.3),
    "well": (0.3, 0.3), "happy": (0.8, 1.0), "safe": (0.5, 0.5), "recovered": (0.4, 0.4),
    "healthy": (0.5, 0.5), "hope": (0.3, 0.6), "relief": (0.4, 0.5), "fine": (0.4, 0.5),
    "bad": (-0.7, 0.65), "worse": (-0.5, 0.6), "worst": (-1.0, 1.0), "sick": (-0.7, 0.85),
    "ill": (-0.5, 0.8), "terrible": (-1.0, 1.0), "awful": (-1.0, 1.0), "pain": (-0.5, 0.7),
    "scared": (-0.6, 0.8), "afraid": (-0.6, 0.9), "dangerous": (-0.6, 0.9), "severe": (-0.4, 0.6),
    "tired": (-0.4, 0.7), "fever": (-0.2, 0.4), "cough": (-0.2, 0.4), "outbreak": (-0.3, 0.5),
    "bien": (0.5, 0.5), "bon": (0.6, 0.6), "mal": (-0.6, 0.6), "malade": (-0.7, 0.8),
    "gut": (0.6, 0.6), "schlecht": (-0.7, 0.65), "krank": (-0.7, 0.8),
    "bueno": (0.6, 0.6), "malo": (-0.7, 0.65), "enfermo": (-0.7, 0.8),
}

# Words that turn a following lexicon word around, and words that strengthen or weaken the next one.
NEGATORS = ("not", "no", "never", "nor", "without", "cannot", "isnt", "arent", "wasnt", "werent", "dont", "doesnt",
            "didnt", "wont", "cant", "couldnt", "shouldnt", "wouldnt", "hasnt", "havent", "hadnt", "nicht", "kein", "pas", "nunca")
INTENSIFIERS = {"very": 1.3, "really": 1.2, "extremely": 1.5, "so": 1.2, "too": 1.2, "quite": 1.1, "highly": 1.4,
                "somewhat": 0.7, "slightly": 0.5, "barely": 0.4, "sehr": 1.3, "muy": 1.3}
NEGATED = -0.5          # a negated word counts with half its polarity, turned around
NEGATION_REACH = 3      # tokens after a negator, the lexicon word included

TOKEN_SPLIT = "[^" + WORD_CLASS[1:]  # runs of non-word characters


def tokens(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.filter(F.split(F.lower(col), TOKEN_SPLIT + "+"), lambda t: F.length(t) > 0)


def _mean_of(arr: Column) -> Column:
    total = F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v)
    return F.when(F.size(arr) > 0, total / F.size(arr)).otherwise(F.lit(0.0))


def known_words(text, words) -> Column:
    """Lexicon words occurring as whole tokens, in text order (one regex pass).

    A word matches only between non-word characters (or the text ends), exactly
    the tokens a split on non-word runs would produce; only these few matches reach
    the per-word lookups.
    """
    col = F.col(text) if isinstance(text, str) else text
    alt = "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True))
    pattern = f"(?<!{WORD_CLASS})({alt})(?!{WORD_CLASS})"
    return F.regexp_extract_all(F.lower(col), F.lit(pattern), 1)


def sentiment_columns(text, lexicon: dict | None = None) -> tuple[Column, Column]:
    """(polarity, subjectivity) expressions for a text column using an inlined lexicon."""
    lex = lexicon or LEXICON
    pol = F.create_map(*[x for k, v in lex.items() for x in (F.lit(k), F.lit(float(v[0])))])
    sub = F.create_map(*[x for k, v in lex.items() for x in (F.lit(k), F.lit(float(v[1])))])
    known = known_words(text, list(lex))
    p = _mean_of(F.transform(known, lambda t: F.element_at(pol, t)))
    s = _mean_of(F.transform(known, lambda t: F.element_at(sub, t)))
    return (F.when(F.col(text).isNull() if isinstance(text, str) else text.isNull(), F.lit(0.0)).otherwise(p),
            F.when(F.col(text).isNull() if isinstance(text, str) else text.isNull(), F.lit(0.0)).otherwise(s))


def lexicon_sentiment(df: DataFrame, text: str = "text", lexicon=None,
                      key: str | None = None) -> DataFrame:
    """Add ``polarity`` and ``subjectivity``.

    ``lexicon`` may be a dict (inlined) or a DataFrame (word, polarity,
    subjectivity) for lexicons too large to inline; then the text is tokenised,
    joined with the lexicon, averaged per unique row ``key`` and joined back.
    """
    if lexicon is None or isinstance(lexicon, dict):
        p, s = sentiment_columns(text, lexicon)
        return df.withColumn("polarity", p).withColumn("subjectivity", s)
    if key is None:
        raise ValueError("a DataFrame lexicon needs a unique row key column")
    words = df.select(key, F.explode(tokens(text)).alias("word"))
    lex = bounded_broadcast(lexicon.select("word", "polarity", "subjectivity"))
    scored = (words.join(lex, "word").groupBy(key)
              .agg(F.avg("polarity").alias("_p"), F.avg("subjectivity").alias("_s")))
    out = df.join(scored, key, "left")
    return (out.withColumn("polarity", F.coalesce("_p", F.lit(0.0)))
            .withColumn("subjectivity", F.coalesce("_s", F.lit(0.0))).drop("_p", "_s"))


def modified_sentiment(df: DataFrame, text: str = "text", lexicon: dict | None = None, negators=NEGATORS,
                       intensifiers: dict | None = None) -> DataFrame:
    """Add ``polarity`` and ``subjectivity`` by the lexicon with negation and intensifiers.

    A lexicon word counts negated (times ``NEGATED``) if a negator is among the ``NEGATION_REACH`` tokens before it
    with no other lexicon word and no sentence end (``. ! ? ;`` or a line break) between; an intensifier
    right before it multiplies polarity and subjectivity, which are then clipped to [-1, 1] and [0, 1].  A text has the
    means of its words; 0 without any, and for a null text.  ``n't`` counts as part of its word (``isnt``).

    One regular expression finds each lexicon word with its context, so the work per text is one pass in
    the projection, and only words found reach the lookups.  A lexicon word is never a negator or an intensifier.
    """
    lex = lexicon or LEXICON
    boosts = INTENSIFIERS if intensifiers is None else intensifiers
    negators, boosts = [w for w in negators if w not in lex], {w: b for w, b in boosts.items() if w not in lex}

    def any_of(words):
        return "(?:" + "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True)) + f")(?!{WORD_CLASS})"

    gap = "[^" + WORD_CLASS[1:-1] + ".!?;\\n]+"
    known = any_of(lex)
    ahead = ([f"{any_of(negators)}{gap}(?:(?!{known}){WORD_CLASS}+{gap}){{0,{NEGATION_REACH - 1}}}"] if negators else []) \
        + ([any_of(boosts) + gap] if boosts else [])       # a negator's context holds the intensifier, if there is one
    before = f"(?:{'|'.join(ahead)})?" if ahead else ""
    pattern = f"(?<!{WORD_CLASS})({before}{known})"

    def lookup(values: dict):
        return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(float(v)))])
    pol, sub = lookup({k: v[0] for k, v in lex.items()}), lookup({k: v[1] for k, v in lex.items()})
    boost_of = lookup(boosts) if boosts else None

    def scores(hit):
        words = F.filter(F.split(hit, TOKEN_SPLIT + "+"), lambda t: F.length(t) > 0)
        word, last = F.element_at(words, -1), F.try_element_at(words, F.lit(-2))
        boost = F.coalesce(F.try_element_at(boost_of, F.coalesce(last, F.lit(""))), F.lit(1.0)) if boosts else F.lit(1.0)
        turned = F.when(F.arrays_overlap(words, F.array(*map(F.lit, negators))), NEGATED).otherwise(1.0) if negators else F.lit(1.0)
        return F.struct(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.element_at(pol, word) * boost * turned)).alias("p"),
                        F.least(F.lit(1.0), F.element_at(sub, word) * boost).alias("s"))

    plain = F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), "n['\u2019]t", "nt")
    found = F.transform(F.regexp_extract_all(plain, F.lit(pattern), 1), scores)
    # the list is bound once: a second mention would search the text a second time
    means = F.transform(F.array(found), lambda a: F.struct(
        _mean_of(F.transform(a, lambda x: x["p"])).alias("p"), _mean_of(F.transform(a, lambda x: x["s"])).alias("s")))
    both = F.element_at(means, 1)
    return df.withColumns({"polarity": both["p"], "subjectivity": both["s"]})
