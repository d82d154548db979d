"""Second-stage scoring of BM25 candidates.

All built-in scorers are set-based DataFrame plans (joins, aggregates, higher-order
functions); Python workers run only inside the model hooks (``embed_with``,
``pair_scores_with``), which take Arrow batches through pandas UDFs.

Inputs share one shape: ``pairs(*keys, qid, doc_id, base_score, base_rank)``, the
candidates of a BM25 ranking.  Candidate-side work touches only the documents that are
candidates (semi-join on ``doc_id``), never the whole collection.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions.text import raw_terms
from parley.operators.index import bigrams_found, bm25_idf, hashed_vectors, sign, slot
from parley.plans.sizing import bounded_broadcast, fits_broadcast, lookup_small, materialize

# --- fixed values -----------------------------------------------------------------------
EMBED_DIM = 256  # hashed encoder slots
MAX_PAIR_TOKENS = 512  # pair scorer input budget (query + passage + 3 separators)
PAIR_SEPARATORS = 3
DIRICHLET_MU = 2000.0
# built-in pair scorer weights (our own, untuned)
PAIR_WEIGHTS = {"bm25": 0.1, "coverage": 2.0, "idf_coverage": 3.0, "bigrams": 0.25, "log_len": -0.05, "dot": 1.0}
SCORE_DIGITS = 4
# -----------------------------------------------------------------------------------------


def rerank_model(k: int, k_baseline: int) -> str:
    """Same depth -> bi-encoder (dot product); deeper baseline -> pair scorer."""
    if k > k_baseline:
        raise ValueError(f"k ({k}) cannot exceed k_baseline ({k_baseline})")
    return "bi_encoder" if k == k_baseline else "cross_encoder"


def candidates(ranking: DataFrame, keys: list[str]) -> DataFrame:
    """A BM25 ranking as re-rank input: ``(*keys, qid?, doc_id, base_score, base_rank)``."""
    return ranking.select(*keys, "doc_id", F.col("score").alias("base_score"), F.col("rank").alias("base_rank"))


def build_pairs(pairs: DataFrame, query_texts: DataFrame, collection: DataFrame, keys: list[str]) -> DataFrame:
    """R2: attach the (preprocessed) query text and the stored passage text to each pair."""
    docs = collection.select("doc_id", "data", "n_tokens").join(pairs.select("doc_id").distinct(), "doc_id", "left_semi")
    return pairs.join(bounded_broadcast(query_texts), keys).join(docs, "doc_id")


# ----------------------------------------------------------------------------- R3 / R4
def text_idf(corpus) -> DataFrame:
    """``(term, idf)`` over stored-text tokens (terms absent here get df = 0)."""
    return corpus.text_stats.select("term", "idf")


def embed(df: DataFrame, keys: list[str], text_col: str, corpus, dim: int = EMBED_DIM) -> DataFrame:
    """R3 built-in encoder: hashed ``(1 + ln tf) * idf`` weights, signed, L2-normalised.

    ``(*keys, text) -> (*keys, slots, weights)``, the non-zero slots only; texts without
    tokens get no row.  Meant for the query side: its terms (size-checked) are broadcast
    to the idf table.  Stored passages have their vectors in ``corpus.doc_vectors``.
    """
    toks = df.select(*keys, F.explode(F.split(F.col(text_col), " ")).alias("term")).where("term <> ''")
    tf = materialize(toks.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf")))
    tw = lookup_small(tf, text_idf(corpus), "term")
    idf = F.coalesce(F.col("idf"), bm25_idf(F.lit(0), corpus.n_all_docs))
    w = (F.lit(1.0) + F.log(F.col("tf").cast("double"))) * idf * sign(F.col("term"))
    return hashed_vectors(tw.select(*keys, slot(F.col("term"), dim).alias("slot"), w.alias("w")), keys)


def dot(a: Column | str, b: Column | str) -> Column:
    """Dot product of two equal-length double arrays, inside the JVM."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def dot_rerank(pairs: DataFrame, query_vecs: DataFrame, doc_vecs: DataFrame, keys: list[str]) -> DataFrame:
    """``score = q . d`` for every pair (0 when either side has no vector).

    The (bucketed) passage vectors stream through broadcast joins with the size-checked
    pair keys and query vectors, so no vector crosses a shuffle; only (pair, score) rows
    are joined back to the pairs.
    """
    pk = [*keys, "doc_id"]
    if "slots" in doc_vecs.columns:  # built-in vectors: the document's slots, looked up in the query's
        d = doc_vecs.select("doc_id", F.col("slots").alias("ds"), F.col("weights").alias("dw"))
        at = F.map_from_arrays("slots", "weights")
        dense = F.transform(F.sequence(F.lit(0), F.lit(EMBED_DIM - 1)), lambda i: F.coalesce(F.try_element_at(at, i + F.lit(0)), F.lit(0.0)))
        q = query_vecs.select(*keys, dense.alias("q"))
        prod = F.zip_with("ds", "dw", lambda i, w: w * F.get("q", i))
        product = F.aggregate(prod, F.lit(0.0), lambda acc, v: acc + v)
    else:
        d = doc_vecs.select("doc_id", F.col("vec").alias("dvec"))
        q = query_vecs.withColumnRenamed("vec", "q")
        product = dot("q", "dvec")
    j = d.join(bounded_broadcast(pairs.select(*pk)), "doc_id").join(bounded_broadcast(materialize(q)), keys)
    s = j.select(*pk, product.alias("_dot"))
    out = pairs.join(s, pk, "left")
    return out.select(*pairs.columns, F.round(F.coalesce(F.col("_dot"), F.lit(0.0)), SCORE_DIGITS).alias("score"))


def bi_encoder_scores(pairs: DataFrame, query_texts: DataFrame, corpus, keys: list[str], dim: int = EMBED_DIM) -> DataFrame:
    """R3 + R4 with the built-in encoder: query text vs stored passage vector (index side)."""
    qv = embed(query_texts, keys, "query_text", corpus, dim)
    return dot_rerank(pairs, qv, corpus.doc_vectors, keys)


# ----------------------------------------------------------------------------- R5
def _query_parts(query_texts: DataFrame, corpus, keys: list[str]):
    """Query-side tables for the pair scorer (all small): tokens, distinct terms, bigrams, sizes."""
    qt = materialize(query_texts.select(*keys, F.posexplode(F.split("query_text", " ")).alias("pos", "term")).where("term <> ''"))
    idf = text_idf(corpus)
    qd = lookup_small(qt.select(*keys, "term").distinct(), idf, "term")
    qd = qd.withColumn("idf", F.coalesce("idf", bm25_idf(F.lit(0), corpus.n_all_docs)))
    w = Window.partitionBy(*keys).orderBy("pos")
    qb = qt.select(*keys, F.col("term").alias("a"), F.lead("term").over(w).alias("b")).where(F.col("b").isNotNull()).distinct()
    qn = query_texts.select(*keys).join(
        qt.groupBy(*keys).agg(F.count(F.lit(1)).alias("nq")), keys, "left"
    ).join(qd.groupBy(*keys).agg(F.count(F.lit(1)).alias("nq_distinct"), F.sum("idf").alias("idf_total")), keys, "left")
    qn = qn.fillna(0, ["nq", "nq_distinct"]).fillna(0.0, ["idf_total"])
    qn = qn.withColumn("budget", F.greatest(F.lit(MAX_PAIR_TOKENS) - F.col("nq") - F.lit(PAIR_SEPARATORS), F.lit(0)))
    # each is measured and read several times: computed once
    return materialize(qd), materialize(qb), materialize(qn)


def pair_features(pairs: DataFrame, query_texts: DataFrame, corpus, keys: list[str], dim: int = EMBED_DIM) -> DataFrame:
    """R5 features per pair (passage cut to ``512 - |query| - 3`` tokens first):

    bm25 (base score), coverage (distinct query terms found / distinct query terms),
    idf_coverage (same, idf-weighted), bigrams (distinct adjacent query term pairs found
    adjacent in the passage), log_len = ln(1 + passage tokens kept), dot (bi-encoder score).
    What is materialised per pair is its query terms found, not the passage.
    """
    qd, qb, qn = _query_parts(query_texts, corpus, keys)
    pk = [*keys, "doc_id"]
    p = pairs.join(bounded_broadcast(qn.select(*keys, "budget", "nq_distinct", "idf_total")), keys)
    # query terms found in candidate passages within the budget, from the positional index,
    # which is cut to the candidates' documents first (by doc_id, its bucketing), then to
    # the query terms, then to the pairs; what is broadcast is size-checked, so the per-pair
    # aggregates run inside the doc_id buckets without an exchange
    pb = bounded_broadcast(materialize(p.select(*pk, "budget")))
    docs = bounded_broadcast(materialize(pairs.select("doc_id").distinct()))
    occ = corpus.text_postings.join(docs, "doc_id", "left_semi").join(bounded_broadcast(qd.select(*keys, "term", "idf")), "term")
    found = occ.join(pb, pk).where(F.col("first_pos") < F.col("budget"))
    cov = found.groupBy(*pk).agg(F.count(F.lit(1)).alias("n_found"), F.sum("idf").alias("idf_found"))
    wanted = qb.select("a", "b").distinct()
    if fits_broadcast(wanted):  # looked for in the candidates' texts; no index of all pairs is needed
        sent = qb.sparkSession.sparkContext.broadcast([(r["a"], r["b"]) for r in wanted.collect()])
        bocc = bigrams_found(corpus.collection.join(docs, "doc_id", "left_semi"), sent)
    else:
        bocc = corpus.text_bigrams.join(docs, "doc_id", "left_semi")
    bocc = bocc.join(bounded_broadcast(qb), ["a", "b"])
    bfound = bocc.join(pb, pk).where(F.col("first_pos") + 1 < F.col("budget"))
    big = bfound.groupBy(*pk).agg(F.count(F.lit(1)).alias("bigrams"))
    dots = bi_encoder_scores(pairs, query_texts, corpus, keys, dim).select(*pk, F.col("score").alias("dot"))
    lens = corpus.collection.select("doc_id", "n_tokens")
    f = (
        p.join(cov, pk, "left").join(big, pk, "left").join(dots, pk, "left").join(lens, "doc_id", "left")
    )
    kept = F.least(F.coalesce(F.col("n_tokens"), F.lit(0)), F.col("budget"))
    return f.select(
        *pairs.columns,
        F.col("base_score").alias("bm25"),
        F.when(F.col("nq_distinct") > 0, F.coalesce("n_found", F.lit(0)) / F.col("nq_distinct")).otherwise(0.0).alias("coverage"),
        F.when(F.col("idf_total") > 0, F.coalesce("idf_found", F.lit(0.0)) / F.col("idf_total")).otherwise(0.0).alias("idf_coverage"),
        F.coalesce("bigrams", F.lit(0)).cast("bigint").alias("bigrams"),
        F.log(F.lit(1.0) + kept.cast("double")).alias("log_len"),
        F.coalesce("dot", F.lit(0.0)).alias("dot"),
    )


FEATURES = ("bm25", "coverage", "idf_coverage", "bigrams", "log_len", "dot")


def pair_rerank(features: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """R5 built-in scorer: a weighted sum of the pair features."""
    wts = {**PAIR_WEIGHTS, **(weights or {})}
    s = F.lit(0.0)
    for name in FEATURES:
        s = s + F.lit(float(wts[name])) * F.col(name).cast("double")
    return features.withColumn("score", F.round(s, SCORE_DIGITS))


# ----------------------------------------------------------------------------- R6
def query_likelihood(pairs: DataFrame, turns: DataFrame, corpus, keys: list[str], mu: float = DIRICHLET_MU,
                     text_col: str = "utterance", query_tokens: str = "raw") -> DataFrame:
    """Dirichlet-smoothed query log-likelihood (base 10) of the utterance: its ``raw``
    tokens, or with ``query_tokens='analyzed'`` the tokens of its preprocessed text (T5),
    which ``text_col`` then names.

    ``sum_t qtf * log10((tf + mu*pc) / (dl + mu))`` with ``pc = (cf + 0.5) / (C + 0.5 (V + 1))``
    over stored-text tokens, evaluated as
    ``sum_{t in q and d} qtf * log10(1 + tf / (mu*pc)) + sum_{t in q} qtf * log10(mu*pc) - |q| log10(dl + mu)``
    so only matching (candidate, term) rows are joined; finite for every candidate.
    """
    c_tokens, v_terms = float(corpus.text_tokens), float(corpus.text_vocab)
    denom = c_tokens + 0.5 * (v_terms + 1.0)
    if query_tokens not in ("raw", "analyzed"):
        raise ValueError(f"query_tokens must be 'raw' or 'analyzed', got {query_tokens!r}")
    tokens = raw_terms(text_col) if query_tokens == "raw" else F.array_remove(F.split(F.col(text_col), " "), "")
    qt = materialize(turns.select(*keys, F.explode(tokens).alias("term")).groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("qtf")))
    cf = corpus.text_stats.select("term", "cf")
    qp = lookup_small(qt, cf, "term").withColumn(
        "mupc", F.lit(mu) * (F.coalesce(F.col("cf"), F.lit(0)).cast("double") + F.lit(0.5)) / F.lit(denom))
    qp = materialize(qp)
    qsum = materialize(qp.groupBy(*keys).agg(
        F.sum(F.col("qtf") * F.log10("mupc")).alias("background"), F.sum("qtf").alias("qlen")))
    pk = [*keys, "doc_id"]
    docs = bounded_broadcast(materialize(pairs.select("doc_id").distinct()))
    occ = corpus.text_postings.select("doc_id", "term", "tf").join(docs, "doc_id", "left_semi").join(
        bounded_broadcast(qp.select(*keys, "term", "qtf", "mupc")), "term")
    fg = occ.join(bounded_broadcast(pairs.select(*pk)), pk).groupBy(*pk).agg(
        F.sum(F.col("qtf") * F.log10(F.lit(1.0) + F.col("tf") / F.col("mupc"))).alias("foreground"))
    lens = corpus.collection.select("doc_id", "n_tokens")
    j = pairs.join(bounded_broadcast(qsum), keys, "left").join(fg, pk, "left").join(lens, "doc_id", "left")
    s = (
        F.coalesce("foreground", F.lit(0.0))
        + F.coalesce("background", F.lit(0.0))
        - F.coalesce("qlen", F.lit(0)).cast("double") * F.log10(F.coalesce("n_tokens", F.lit(0)).cast("double") + F.lit(mu))
    )
    return j.select(*pairs.columns, F.round(s, SCORE_DIGITS).alias("score"))


# ----------------------------------------------------------------------------- R7
def rank_by_score(scored: DataFrame, keys: list[str], k: int | None = None) -> DataFrame:
    """Stable descending order (equal scores keep the baseline order), cut to k."""
    w = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("base_rank").asc())
    r = scored.withColumn("rank", F.row_number().over(w).cast("bigint"))
    return r.where(F.col("rank") <= k) if k is not None else r


# ----------------------------------------------------------------------------- hooks
_MODELS: dict[str, Callable] = {}


def _model_key(factory: Callable) -> str:
    return hashlib.sha1(cloudpickle.dumps(factory)).hexdigest()


def _model(key: str, factory: Callable[[], Callable]) -> Callable:
    """What ``factory`` builds, built once per Python worker process and kept between its tasks."""
    if key not in _MODELS:
        _MODELS[key] = factory()
    return _MODELS[key]


def _one_of(fn: Callable | None, factory: Callable | None) -> tuple[str, Callable[[], Callable]]:
    if (fn is None) == (factory is None):
        raise ValueError("give either the function or a factory of it")
    factory = factory or (lambda: fn)
    return _model_key(factory), factory


def embed_with(df: DataFrame, text_col: str, encode: Callable[[list[str]], "object"] | None = None, out: str = "vec",
               factory: Callable[[], Callable[[list[str]], object]] | None = None) -> DataFrame:
    """R3 hook: encode a text column with any batch encoder (e.g. a sentence encoder).

    ``encode(list_of_texts) -> 2-D array-like``, or a ``factory`` of such a function for
    models that take time to load: it is called once per Python worker process.
    """
    key, make = _one_of(encode, factory)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def _enc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fn = _model(key, make)
        for s in batches:
            yield pd.Series(list(np.asarray(fn(s.fillna("").tolist()), dtype="float64")))

    return df.withColumn(out, _enc(F.col(text_col)))


def pair_scores_with(pairs: DataFrame, score: Callable[[list[str], list[str]], "object"] | None = None,
                     query_col: str = "query_text", passage_col: str = "data",
                     factory: Callable[[], Callable[[list[str], list[str]], object]] | None = None) -> DataFrame:
    """R5 hook: score (query, passage) pairs with any batch scorer (e.g. a cross-encoder),
    given as a function or as a ``factory`` of it, as in :func:`embed_with`."""
    key, make = _one_of(score, factory)
    schema = T.StructType(pairs.schema.fields + [T.StructField("score", T.DoubleType())])

    def _run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = _model(key, make)
        for b in batches:
            s = fn(b[query_col].fillna("").tolist(), b[passage_col].fillna("").tolist())
            yield b.assign(score=np.asarray(s, dtype="float64"))

    return pairs.mapInPandas(_run, schema)
