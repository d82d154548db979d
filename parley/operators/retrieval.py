"""Q1–Q9: BM25 retrieval for every turn of every topic in one distributed plan.

Shape of the plan (doc-sharded, like a search cluster's scatter/gather):

  query side  (small, size-checked broadcast): turns -> terms -> (qid, term, qtf, idf)
  index side  postings(doc_id, term, tf, dl), bucketed by doc_id, files sorted by term:
              only the pages that may hold a term of the batch are read
  match       broadcast hash join on term            (postings not shuffled)
  score       sum per (qid, doc_id)                   (bucket partitioning satisfies it)
  top-k       row_number per qid <= k                 (partial top-k per partition first,
                                                       so only k rows/qid/partition move)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.functions.text import ANALYZER_STOPWORDS, is_stopword
from parley.operators.analysis import ordered_join, stem_rows, with_empty
from parley.operators.conflation import conflate
from parley.operators.scoring import in_buckets, scored_buckets
from parley.plans.sizing import batches, bounded_broadcast, materialize

# --- fixed values -----------------------------------------------------------------------
UTTERANCE_KINDS = {"Manual": "manual", "Automatic": "automatic"}
BM25_K1 = 1.2
BM25_B = 0.75
EMPTY_QUERY_SCORE = 1.0
SCORE_DIGITS = 4
# -----------------------------------------------------------------------------------------

#: Ranges of sorted keys that a scan is cut to; each costs every row that is read.
KEY_RANGES = 8
#: Terms to a range from which the ranges skip too little to pay for their filter.
WIDE = 64


def select_utterance(turns: DataFrame, kind: str) -> DataFrame:
    """Q1: ``Manual``/``Automatic`` pick the utterance field; anything else is an error."""
    if kind not in UTTERANCE_KINDS:
        raise ValueError(f"utterance kind must be one of {sorted(UTTERANCE_KINDS)}, got {kind!r}")
    return turns.withColumn("utterance", F.col(UTTERANCE_KINDS[kind]))


def make_qid(turns: DataFrame) -> DataFrame:
    """Q2: ``qid = topic_turn``; a repeated qid keeps the turn that comes last in the input,
    by ``pos_topic`` and ``pos_turn``, then the larger texts; without those columns, the
    latter alone, so that the choice never depends on the partitioning."""
    t = turns.withColumn("qid", F.concat_ws("_", F.col("topic").cast("string"), F.col("turn").cast("string")))
    order = [c for c in ("pos_topic", "pos_turn", "manual", "automatic", "utterance") if c in t.columns]
    w = Window.partitionBy("qid").orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return t.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def turns_for(turns: DataFrame, kind: str) -> DataFrame:
    """Q1 + Q2: ``(qid, topic, turn, utterance)``."""
    return make_qid(select_utterance(turns, kind)).select("qid", "topic", "turn", "utterance")


def query_text(turns: DataFrame, stem_map: DataFrame, keys: list[str], text_col: str = "utterance") -> DataFrame:
    """T5 on the utterance: ``(*keys, query_text)`` (the text pair scorers see)."""
    rows = stem_rows(turns, keys, text_col, stem_map)
    return with_empty(turns.select(*keys), ordered_join(rows, keys, "term", "query_text"), keys, "query_text")


def query_terms(turns: DataFrame, stem_map: DataFrame, keys: list[str], text_col: str = "utterance") -> DataFrame:
    """Q3: ``(*keys, term, qtf)``; one clause per token, so a repeated token counts again."""
    return terms_of_rows(stem_rows(turns, keys, text_col, stem_map), stem_map, keys)


def terms_of_rows(rows: DataFrame, stem_map: DataFrame, keys: list[str]) -> DataFrame:
    """T6 on preprocessed query rows, then counted: ``(*keys, term, qtf)``."""
    rows = conflate(rows.where(~is_stopword("term", ANALYZER_STOPWORDS)), stem_map)
    return rows.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("qtf"))


def query_weights(qterms: DataFrame, term_stats: DataFrame) -> DataFrame:
    """Attach idf to query terms: ``(*keys, term, qtf, idf)``; terms absent from the index drop."""
    return term_stats.select("term", "idf").join(bounded_broadcast(qterms), "term")


def match_any(qweights: DataFrame, postings: DataFrame) -> DataFrame:
    """Q4: a document matches a turn if any of its terms does (inner equi-join on term)."""
    return postings.join(bounded_broadcast(qweights), "term")


def key_ranges(keys: DataFrame, col: str) -> Column:
    """A filter on ``col`` that every value in ``keys`` passes, as at most KEY_RANGES ranges.

    For a table whose files are sorted by ``col``: Parquet skips the row groups and pages
    outside the ranges.  A set of no more values than ranges passes alone; of a larger one
    each range covers neighbouring values.  Only the ranges' ends come to the driver.  They
    are nested as a search tree, so that a row costs a few comparisons.
    """
    dealt = keys.select(col).where(F.col(col).isNotNull()).distinct().repartitionByRange(KEY_RANGES, col)
    ends = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min(col).alias("lo"), F.max(col).alias("hi")).collect()
    ends = sorted((r["lo"], r["hi"]) for r in ends)

    def tree(part: list) -> Column:
        if len(part) == 1:
            lo, hi = part[0]
            return F.col(col) == lo if lo == hi else F.col(col).between(lo, hi)
        half = len(part) // 2
        return ((F.col(col) <= part[half - 1][1]) & tree(part[:half])) | ((F.col(col) >= part[half][0]) & tree(part[half:]))

    return tree(ends) if ends else F.lit(False)


def postings_of(postings: DataFrame, qweights: DataFrame) -> DataFrame:
    """The postings of a query batch's terms (and of what lies in a range between them); all
    postings where the terms are so many that the ranges would hold most of them anyway."""
    if qweights.select("term").distinct().count() > WIDE * KEY_RANGES:
        return postings
    return postings.where(key_ranges(qweights, "term"))


def bm25_score(matches: DataFrame, keys: list[str], avgdl: float, k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """Q5: ``sum qtf * (k1+1) * idf * tf / (tf + k1 * (1 - b + b * dl / avgdl))``."""
    tf = F.col("tf").cast("double")
    norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * F.col("dl").cast("double") / F.lit(float(avgdl)))
    w = F.col("qtf").cast("double") * F.lit(k1 + 1.0) * F.col("idf") * tf / (tf + norm)
    return matches.groupBy(*keys, "doc_id").agg(F.sum(w).alias("score"))


def top_k(scores: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Q6: best k per turn by score (4 digits), ties by ``doc_id`` ascending."""
    s = scores.withColumn("score", F.round("score", SCORE_DIGITS))
    w = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc())
    return s.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)


def first_doc_ids(collection: DataFrame, k: int) -> Column:
    """Scalar subquery: the k smallest doc ids, sorted (what match-all returns first)."""
    first = collection.select("doc_id").orderBy("doc_id").limit(k)
    return first.agg(F.array_sort(F.collect_list("doc_id"))).scalar()


def empty_query_fallback(turns: DataFrame, query_rows: DataFrame, collection: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Q7: a turn whose preprocessed query has no term at all sends an empty ``should``
    list, which matches everything with score 1.0: the first k ids in index order.

    (A turn whose terms merely miss the index gets no result, as a search would.)
    """
    empty = turns.select(*keys).join(query_rows.select(*keys), keys, "left_anti")
    return empty.select(*keys, F.posexplode(first_doc_ids(collection, k)).alias("pos", "doc_id")).select(
        *keys,
        "doc_id",
        F.lit(EMPTY_QUERY_SCORE).alias("score"),
        (F.col("pos") + 1).cast("bigint").alias("rank"),
    )


def segments(corpus) -> list[DataFrame]:
    """The postings tables of an index: those of its segments, or its only one."""
    return getattr(corpus, "segments", None) or [corpus.postings]


def bm25_retrieve(turns: DataFrame, corpus, k: int, keys: list[str] | None = None,
                  k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """Q8: ``ranking(*keys, doc_id, score, rank)`` for all turns at once.

    ``turns`` carries ``*keys`` and ``utterance``.
    """
    keys = keys or ["qid"]
    # the query side is written once and read several times (match, empty check)
    rows = materialize(stem_rows(turns, keys, "utterance", corpus.stem_map))
    terms = materialize(terms_of_rows(rows, corpus.stem_map, keys))
    qw = materialize(query_weights(terms, corpus.term_stats))
    ranked = empty_query_fallback(turns, rows, corpus.collection, keys, k)
    for part in batches(qw, keys, times=4):  # as many as it takes for each to be broadcast
        tables = [postings_of(postings, part) for postings in segments(corpus)]  # a document is in one of them
        if all(map(in_buckets, tables)):
            scores = scored_buckets(tables, part, keys, k, corpus.avgdl, k1, b)
        else:  # stored without buckets: the sums are exchanged
            scores = None
            for postings in tables:
                found = bm25_score(postings.join(F.broadcast(part), "term"), keys, corpus.avgdl, k1, b)
                scores = found if scores is None else scores.unionByName(found)
        ranked = ranked.unionByName(top_k(scores, keys, k).select(*keys, "doc_id", "score", "rank"))
    return ranked


def fetch_documents(ranking: DataFrame, collection: DataFrame, cols: tuple[str, ...] = ("data",)) -> DataFrame:
    """Q9: stored text of each candidate (one join instead of a lookup per document)."""
    return collection.select("doc_id", *cols).join(bounded_broadcast(ranking), "doc_id")
