"""Text analysis on token rows.

T5 ``preprocess``: normalise, split, drop stop words, conflate -> ordered stems; joined by
one space this is the stored passage text ``data`` (and the query text of pair scoring).
T6 ``analyze``: the index analyzer's second pass over ``data``: drop analyzer stop words,
conflate again -> index terms.

Documents become rows ``(key, pos, term)`` with ``posexplode``; order is rebuilt with
``array_sort(collect_list(struct(pos, term)))`` inside one group per document.  When the
input is bucketed by the key and the conflation map is broadcast, no step shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.text import ANALYZER_STOPWORDS, STOPWORDS, is_stopword, normalize
from parley.operators.blocks import Tokens, by_blocks, ddl
from parley.operators.conflation import conflate, stems_of


def token_rows(df: DataFrame, keys: list[str], text_col: str, stop: tuple[str, ...] | None = None) -> DataFrame:
    """T1–T3 in row form: ``(*keys, pos, term)``; stop words removed when ``stop`` is given."""
    ex = df.select(*keys, F.posexplode(F.split(F.trim(normalize(text_col)), " ")).alias("pos", "term"))
    cond = F.col("term") != ""
    if stop:
        cond = cond & ~is_stopword("term", stop)
    return ex.where(cond)


def space_tokens(df: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """Split an already analysed text (``data``) on spaces: ``(*keys, pos, term)``."""
    ex = df.select(*keys, F.posexplode(F.split(F.col(text_col), " ")).alias("pos", "term"))
    return ex.where(F.col("term") != "")


def ordered_join(rows: DataFrame, keys: list[str], term_col: str = "term", out: str = "data") -> DataFrame:
    """Rebuild the ordered text per key from ``(*keys, pos, term)`` rows."""
    return rows.groupBy(*keys).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("pos", term_col))), lambda x: x[term_col]), " "
        ).alias(out)
    )


def with_empty(base: DataFrame, texts: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Keep keys whose text produced no token, with an empty string."""
    return base.join(texts, keys, "left").withColumn(out, F.coalesce(F.col(out), F.lit("")))


def stem_rows(df: DataFrame, keys: list[str], text_col: str, conflation_map: DataFrame) -> DataFrame:
    """T1–T4 rows: ``(*keys, pos, term)`` with ``term`` conflated."""
    return conflate(token_rows(df, keys, text_col, STOPWORDS), conflation_map)


def clean_tokens(text: Column | str, stop: tuple[str, ...] = STOPWORDS) -> Column:
    """T1–T3 in array form: ordered tokens without stop words (duplicates kept)."""
    words = list(stop)
    return F.filter(F.split(F.trim(normalize(text)), " "), lambda t: (t != F.lit("")) & ~t.isin(words))


def conflate_arrays(df: DataFrame, keys: list[str], tokens_col: str, conflation_map: DataFrame) -> DataFrame:
    """Conflate an array-of-tokens column in place, keeping order and duplicates.

    Each row gets a small map of just the changed terms it contains (distinct terms joined
    to the broadcast conflation map, regrouped by key; rows that share a key share a map);
    ``transform`` then rewrites the array.  Rows are never exploded to one row per token; with ``df`` partitioned by the
    key (bucketed collection) the regroup and the join back need no exchange.
    """
    m = conflation_map.select(F.col("surface").alias("term"), F.col("stem").alias("_stem"))
    d = df.select(*keys, F.explode(F.array_distinct(tokens_col)).alias("term")).join(m, "term")
    per = d.groupBy(*keys).agg(F.map_from_entries(F.collect_set(F.struct("term", "_stem"))).alias("_m"))
    j = df.join(per, keys, "left")
    rewritten = F.transform(tokens_col, lambda t: F.coalesce(F.try_element_at(F.col("_m"), t), t))
    return j.withColumn(tokens_col, F.when(F.col("_m").isNull(), F.col(tokens_col)).otherwise(rewritten)).drop("_m")


def preprocess(df: DataFrame, keys: list[str], text_col: str, conflation_map: DataFrame, out: str = "data") -> DataFrame:
    """T5: ``(*keys, *other columns, out)``: ordered stems joined by a space ('' if none)."""
    t = df.withColumn("_tok", clean_tokens(text_col)).drop(text_col)
    t = conflate_arrays(t, keys, "_tok", conflation_map)
    return t.withColumn(out, F.array_join("_tok", " ")).drop("_tok")


def cleaned(df: DataFrame, text_col: str, out: str = "clean") -> DataFrame:
    """T1–T3 of a collection: every column but ``text_col``, and the tokens of that without
    stop words, joined by a space; in blocks, so that rows stay where they are."""
    keep, stop = [c for c in df.columns if c != text_col], frozenset(STOPWORDS)
    return by_blocks(df, text_col, ", ".join([*ddl(df, *keep), f"`{out}` string"]), lambda rows, texts: [
        *[rows.column(c) for c in keep], Tokens.split(texts, raw=True).without(stop).joined()])


def preprocess_clean(df: DataFrame, keys: list[str], clean_col: str, conflation_map: DataFrame, out: str = "data") -> DataFrame:
    """T4 (+ join) over an already cleaned text (T1–T3 tokens joined by a space).

    With a map that fits a broadcast the texts are rewritten in blocks, and no row moves;
    with a larger one the distinct terms of each row are joined to it.
    """
    stems = stems_of(conflation_map)
    if stems is not None:
        keep = [c for c in df.columns if c != clean_col]
        return by_blocks(df, clean_col, ", ".join([*ddl(df, *keep), f"`{out}` string"]), lambda rows, texts: [
            *[rows.column(c) for c in keep], Tokens.split(texts).conflated(stems.value).joined()])
    t = df.withColumn("_tok", F.array_remove(F.split(F.col(clean_col), " "), "")).drop(clean_col)
    t = conflate_arrays(t, keys, "_tok", conflation_map)
    return t.withColumn(out, F.array_join("_tok", " ")).drop("_tok")


def analyzed_rows(df: DataFrame, keys: list[str], data_col: str, conflation_map: DataFrame) -> DataFrame:
    """T6 rows over stored text: ``(*keys, pos, term)`` (analyzer stop words dropped, conflated)."""
    rows = space_tokens(df, keys, data_col).where(~is_stopword("term", ANALYZER_STOPWORDS))
    return conflate(rows, conflation_map)


def analyze(df: DataFrame, keys: list[str], data_col: str, conflation_map: DataFrame, out: str = "terms") -> DataFrame:
    """T6 as text: ``(*keys, out)`` with the index terms in order, joined by a space."""
    words = list(ANALYZER_STOPWORDS)
    terms = F.filter(F.split(F.col(data_col), " "), lambda t: (t != F.lit("")) & ~t.isin(words))
    toks = conflate_arrays(df.select(*keys, terms.alias("_tok")), keys, "_tok", conflation_map)
    return toks.select(*keys, F.array_join("_tok", " ").alias(out))


def n_tokens(text: Column | str) -> Column:
    """Number of space-separated tokens of an analysed text ('' -> 0)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.when(c == "", F.lit(0)).otherwise(F.size(F.split(c, " "))).cast("bigint")
