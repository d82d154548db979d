"""Column-level text functions (T1–T3) and the fixed word lists they use.

Everything here is a pure ``Column -> Column`` expression that stays inside the JVM
(regex, split, higher-order ``filter``), so it runs inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------
# English stop words removed before conflation (NLTK English list, published order; its
# 26 entries with an apostrophe are left out because normalisation splits them anyway).
STOPWORDS: tuple[str, ...] = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his
    himself she her hers herself it its itself they them their theirs themselves what
    which who whom this that these those am is are was were be been being have has had
    having do does did doing a an the and but if or because as until while of at by for
    with about against between into through during before after above below to from up
    down in out on off over under again further then once here there when where why how
    all any both each few more most other some such no nor not only own same so than too
    very s t can will just don should now d ll m o re ve y ain aren couldn didn doesn
    hadn hasn haven isn ma mightn mustn needn shan shouldn wasn weren won wouldn
    """.split()
)

# Stop words of the index analyzer's second pass (Lucene's default English set).
ANALYZER_STOPWORDS: tuple[str, ...] = tuple(
    """
    a an and are as at be but by for if in into is it no not of on or such that the their
    then there these they this to was will with
    """.split()
)
# -----------------------------------------------------------------------------------------

NON_ALNUM = r"[^0-9a-zA-Z]+"


def normalize(c: Column | str) -> Column:
    """Every run of characters outside [0-9a-zA-Z] becomes one space, then lower-case.

    Non-ASCII letters are separators, exactly as the reference's regex treats them.
    """
    return F.lower(F.regexp_replace(_col(c), NON_ALNUM, " "))


def tokenize(c: Column | str) -> Column:
    """Split on spaces, no empty tokens -> array<string>."""
    return F.filter(F.split(F.trim(_col(c)), " "), lambda t: t != F.lit(""))


def remove_stopwords(tokens: Column | str, stop: tuple[str, ...] = STOPWORDS) -> Column:
    """T3 (array form): drop stop words, keeping order and duplicates."""
    words = list(stop)
    return F.filter(_col(tokens), lambda t: ~t.isin(words))


def is_stopword(term: Column | str, stop: tuple[str, ...] = STOPWORDS) -> Column:
    """T3 (row form): predicate, compiled to a hash-set lookup (InSet)."""
    return _col(term).isin(list(stop))


def raw_terms(c: Column | str) -> Column:
    """T1 + T2: the tokens a raw utterance is scored with by query likelihood."""
    return tokenize(normalize(c))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
