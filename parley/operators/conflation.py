"""T4: dictionary-checked suffix conflation, built as one set-based job over the vocabulary.

A stripped form is accepted only when it is attested: it must itself be a term of the
collection vocabulary with document frequency >= ``min_df`` (the set ``V``).  Only terms in
``V`` are conflated; every other term maps to itself.  Rules are tried in priority order
and the first attested candidate wins (``min_by(candidate, priority)``).

Everything is an equi-join: the 24-row rule table is joined on the term's last 1..4
characters, candidates are joined to ``V`` on the candidate string.  No theta join, no
per-row Python.
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------
# Suffix rules in priority order: (suffix, replacement).
SUFFIX_RULES: tuple[tuple[str, str], ...] = (
    ("ies", "y"), ("es", "e"), ("es", ""), ("s", ""), ("ied", "y"), ("ed", "e"),
    ("ed", ""), ("ing", "e"), ("ing", ""), ("ly", ""), ("ness", ""), ("tion", "te"),
    ("ion", "e"), ("ion", ""), ("ment", ""), ("er", "e"), ("er", ""), ("ble", ""),
    ("al", ""), ("ive", ""), ("ize", ""), ("ity", ""), ("ism", ""), ("ic", ""),
)
MIN_STEM_LENGTH = 3
MIN_DF = 2
# -----------------------------------------------------------------------------------------

MAX_SUFFIX = max(len(s) for s, _ in SUFFIX_RULES)


def rules_frame(spark: SparkSession) -> DataFrame:
    rows = [(i + 1, s, r) for i, (s, r) in enumerate(SUFFIX_RULES)]
    return spark.createDataFrame(rows, "pri int, suffix string, repl string")


def attested_terms(vocab: DataFrame, min_df: int = MIN_DF) -> DataFrame:
    """``V``: vocabulary terms (columns ``term, df``) with df >= min_df."""
    return vocab.where(F.col("df") >= min_df).select("term")


def build_conflation(vocab: DataFrame, min_df: int = MIN_DF) -> DataFrame:
    """T4: ``conflation(surface, stem)`` for every term of ``V``.

    ``vocab`` has columns ``term`` and ``df`` (document frequency).
    """
    spark = vocab.sparkSession
    v = attested_terms(vocab, min_df)
    rules = F.broadcast(rules_frame(spark))  # 24 rows, fixed size
    ends = v.select(
        F.col("term").alias("surface"),
        F.explode(F.array(*[F.substring(F.col("term"), -n, n) for n in range(1, MAX_SUFFIX + 1)])).alias("end"),
    )
    cand = (
        ends.join(rules, ends["end"] == rules["suffix"])
        .where(F.length("surface") - F.length("suffix") >= MIN_STEM_LENGTH)
        .select(
            "surface",
            "pri",
            F.concat(F.expr("substring(surface, 1, length(surface) - length(suffix))"), F.col("repl")).alias("cand"),
        )
    )
    attested = cand.join(v.withColumnRenamed("term", "cand"), "cand", "left_semi")
    best = attested.groupBy("surface").agg(F.min_by("cand", "pri").alias("best"))
    return (
        v.withColumnRenamed("term", "surface")
        .join(best, "surface", "left")
        .select("surface", F.coalesce("best", "surface").alias("stem"))
    )


_FITS: "weakref.WeakKeyDictionary[DataFrame, bool]" = weakref.WeakKeyDictionary()


def _map_fits(conflation_map: DataFrame) -> bool:
    """Whether a conflation map fits a broadcast; measured once per map object."""
    from parley.plans.sizing import fits_broadcast

    try:
        return _FITS[conflation_map]
    except KeyError:
        _FITS[conflation_map] = fits = fits_broadcast(conflation_map)
        return fits


def stems_of(conflation_map: DataFrame):
    """The map as a broadcast ``{surface: stem}`` for the tasks of a collection's analysis, or
    None if it is too large for that."""
    if not _map_fits(conflation_map):
        return None
    t = conflation_map.select("surface", "stem").toArrow()
    return conflation_map.sparkSession.sparkContext.broadcast(dict(zip(t.column(0).to_pylist(), t.column(1).to_pylist())))


def changed_entries(conflation: DataFrame) -> DataFrame:
    """The part of the table that changes a term (everything else maps to itself)."""
    return conflation.where(F.col("stem") != F.col("surface"))


def conflate(tokens: DataFrame, conflation_map: DataFrame, term_col: str = "term") -> DataFrame:
    """Apply a conflation map to a token-rows frame: replaces ``term_col`` by its stem.

    ``conflation_map`` is (a subset of) ``changed_entries``.  Meant for the small (query)
    side: the map streams through the broadcast distinct tokens, and the few matching
    entries are broadcast back.  Whole collections use ``analysis.conflate_arrays``.
    """
    from parley.plans.sizing import bounded_broadcast

    m = conflation_map.select(F.col("surface").alias("_surface"), F.col("stem").alias("_stem"))
    if _map_fits(conflation_map):
        m = F.broadcast(m)  # size checked once per map
    else:
        # a map too large to broadcast is never shuffled: it streams through the
        # broadcast distinct tokens, and only the matching entries are broadcast back
        keys = tokens.select(F.col(term_col).alias("_surface")).distinct()
        m = bounded_broadcast(m.join(bounded_broadcast(keys), "_surface"))
    j = tokens.join(m, tokens[term_col] == m["_surface"], "left")
    return j.select(
        *[F.coalesce(m["_stem"], tokens[c]).alias(c) if c == term_col else tokens[c] for c in tokens.columns]
    )
