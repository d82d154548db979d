"""Index tables derived from the stored collection ``(doc_id, data, ...)``.

postings    (doc_id, term, tf, dl)   I1 (+ the document length used by BM25)
term_vectors(doc_id, vector)          I2
doc_lengths (doc_id, dl)              I3
term_stats  (term, df, cf, idf)       I4
coll_stats  (n_docs, sum_dl, avgdl, n_terms)  I4

Postings are produced per document: with the collection bucketed by ``doc_id`` the
``(doc_id, term)`` aggregate and the length window run without an exchange, and the
postings are stored with the same bucketing so scoring aggregates stay shuffle-free.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.functions.text import ANALYZER_STOPWORDS
from parley.operators.analysis import conflate_arrays
from parley.operators.blocks import Tokens, by_blocks, ddl
from parley.operators.conflation import stems_of


def build_postings(collection: DataFrame, conflation_map: DataFrame, data_col: str = "data") -> DataFrame:
    """``(doc_id, term, tf, dl)`` from the T6 analysis of the stored text (one row per id)."""
    stems = stems_of(conflation_map)
    if stems is not None:
        stop = frozenset(ANALYZER_STOPWORDS)

        def block(rows: pa.RecordBatch, texts: pa.Array) -> list[pa.Array]:
            tokens = Tokens.split(texts).without(stop).conflated(stems.value)
            text, code, number, _ = tokens.counts()
            # by term, as the table is stored: its sort then merges a few runs
            by_term = np.argsort(tokens.ranks()[code], kind="stable")
            text, code, number = text[by_term], code[by_term], number[by_term]
            length = np.diff(tokens.starts())[text]
            return [rows.column(0).take(pa.array(text)), tokens.words(code), pa.array(number, pa.int64()), pa.array(length, pa.int64())]

        docs = collection.select("doc_id", data_col)
        return by_blocks(docs, data_col, ", ".join([*ddl(docs, "doc_id"), "term string", "tf bigint", "dl bigint"]), block)
    words = list(ANALYZER_STOPWORDS)
    toks = collection.select("doc_id", F.filter(F.split(F.col(data_col), " "),
                                                lambda t: (t != F.lit("")) & ~t.isin(words)).alias("_tok"))
    toks = conflate_arrays(toks, ["doc_id"], "_tok", conflation_map)
    p = toks.select("doc_id", F.explode("_tok").alias("term")).groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    return p.withColumn("dl", F.sum("tf").over(Window.partitionBy("doc_id")))


def doc_lengths(postings: DataFrame) -> DataFrame:
    """Indexed length per document (documents without terms are absent)."""
    return postings.groupBy("doc_id").agg(F.sum("tf").alias("dl"))


def term_vectors(postings: DataFrame) -> DataFrame:
    """Per document ``term:tf`` pairs sorted by term, as one string."""
    return postings.groupBy("doc_id").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("term", "tf"))),
                lambda x: F.concat(x["term"], F.lit(":"), x["tf"].cast("string")),
            ),
            " ",
        ).alias("vector")
    )


def bm25_idf(df: F.Column, n_docs: int | F.Column) -> F.Column:
    n = F.lit(float(n_docs)) if isinstance(n_docs, (int, float)) else n_docs.cast("double")
    d = df.cast("double")
    return F.log(F.lit(1.0) + (n - d + F.lit(0.5)) / (d + F.lit(0.5)))


def term_stats(postings: DataFrame, n_docs: int) -> DataFrame:
    """I4: per term document frequency, collection frequency and BM25 idf."""
    s = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
    return s.withColumn("idf", bm25_idf(F.col("df"), n_docs))


def coll_stats(postings: DataFrame) -> DataFrame:
    """I4: one row ``(n_docs, sum_dl, avgdl, n_terms)`` over documents with indexed terms."""
    terms = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df")).agg(F.count(F.lit(1))).scalar()
    s = doc_lengths(postings).agg(F.count(F.lit(1)).alias("n_docs"), F.sum("dl").alias("sum_dl"))
    return s.select("n_docs", "sum_dl", (F.col("sum_dl") / F.col("n_docs")).alias("avgdl"), terms.alias("n_terms"))


def text_postings(collection: DataFrame, data_col: str = "data") -> DataFrame:
    """Positional postings of the stored text (T5 tokens): ``(doc_id, term, tf, first_pos)``.

    Serves query likelihood (tf) and the pair scorer (first position within the budget)
    without re-tokenising candidate passages per query batch.
    """
    def block(rows: pa.RecordBatch, texts: pa.Array) -> list[pa.Array]:
        tokens = Tokens.split(texts)
        text, code, number, first = tokens.counts()
        return [rows.column(0).take(pa.array(text)), tokens.words(code), pa.array(number, pa.int64()), pa.array(first, pa.int32())]

    docs = collection.select("doc_id", data_col)
    return by_blocks(docs, data_col, ", ".join([*ddl(docs, "doc_id"), "term string", "tf bigint", "first_pos int"]), block)


def text_bigrams(collection: DataFrame, data_col: str = "data") -> DataFrame:
    """Adjacent token pairs of the stored text: ``(doc_id, a, b, first_pos)`` (position of ``a``)."""
    def block(rows: pa.RecordBatch, texts: pa.Array) -> list[pa.Array]:
        tokens = Tokens.split(texts)
        text, a, b, first = tokens.pairs()
        return [rows.column(0).take(pa.array(text)), tokens.words(a), tokens.words(b), pa.array(first, pa.int32())]

    docs = collection.select("doc_id", data_col)
    return by_blocks(docs, data_col, ", ".join([*ddl(docs, "doc_id"), "a string", "b string", "first_pos int"]), block)


def bigrams_found(collection: DataFrame, wanted, data_col: str = "data") -> DataFrame:
    """Of :func:`text_bigrams` the rows of the pairs ``wanted`` (a broadcast list of (a, b)),
    straight from the texts."""
    def block(rows: pa.RecordBatch, texts: pa.Array) -> list[pa.Array]:
        number: dict[str, int] = {}
        keys = np.array([number.setdefault(a, len(number)) << 32 | number.setdefault(b, len(number)) for a, b in wanted.value], np.int64)
        names, order = pa.array(list(number), pa.string()), np.sort(np.append(keys, np.int64(1) << 62))
        tokens = Tokens.split(texts)
        code = np.array([number.get(t, -1) for t in tokens.terms], np.int64)[tokens.codes] if len(tokens.terms) else tokens.codes
        at = np.flatnonzero((tokens.owner[:-1] == tokens.owner[1:]) & (code[:-1] >= 0) & (code[1:] >= 0))
        pair = code[at] << 32 | code[at + 1]
        place = np.searchsorted(order, pair)
        some = order[place] == pair
        at, place = at[some], place[some]
        _, first = np.unique(tokens.owner[at] * len(order) + place, return_index=True)
        at = at[first]
        text = tokens.owner[at]
        words = [names.take(pa.array(code[i])) for i in (at, at + 1)]
        return [rows.column(0).take(pa.array(text)), *words, pa.array(at - tokens.starts()[text], pa.int32())]

    docs = collection.select("doc_id", data_col)
    return by_blocks(docs, data_col, ", ".join([*ddl(docs, "doc_id"), "a string", "b string", "first_pos int"]), block)


def slot(term: F.Column, dim: int = 256) -> F.Column:
    """The hashed encoder's slot of a term."""
    return (F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("bigint") % dim).cast("int")


def sign(term: F.Column) -> F.Column:
    """The hashed encoder's sign of a term."""
    return F.when(F.conv(F.substring(F.md5(term), 9, 1), 16, 10).cast("int") % 2 == 0, F.lit(1.0)).otherwise(F.lit(-1.0))


def text_stats(postings_text: DataFrame, n_all_docs: int, dim: int = 256) -> DataFrame:
    """Stored-text term statistics ``(term, df, cf, idf, slot, sign)``.

    ``idf`` uses all stored documents; ``slot``/``sign`` are the hashed-encoder bucket and
    sign of the term, computed once here instead of per (document, term) at query time.
    """
    s = postings_text.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
    return s.select("term", "df", "cf", bm25_idf(F.col("df"), n_all_docs).alias("idf"),
                    slot(F.col("term"), dim).alias("slot"), sign(F.col("term")).alias("sign"))


def hashed_vectors(weighted: DataFrame, keys: list[str]) -> DataFrame:
    """The built-in encoder's vectors from term weights ``(*keys, slot, w)``: summed per slot
    and L2-normalised, as the non-zero ``slots`` (ascending) and their ``weights``."""
    sw = weighted.groupBy(*keys, "slot").agg(F.sum("w").alias("w"))
    v = sw.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("slot", "w"))).alias("e"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    unit = F.transform("e", lambda x: F.when(F.col("norm") > 0, x["w"] / F.col("norm")).otherwise(F.lit(0.0)))
    return v.select(*keys, F.transform("e", lambda x: x["slot"]).alias("slots"), unit.alias("weights"))


#: Terms that stand in more than a FREQUENT-th part of all postings; there are less than
#: FREQUENT of them, whatever the collection.
FREQUENT = 1 << 20
#: Documents whose vectors are summed at once.
VECTORS = 1000


def doc_vectors(postings_text: DataFrame, stats: DataFrame, n_postings: int, buckets: int | None = None, frequent: int = FREQUENT) -> DataFrame:
    """Built-in encoder over every stored passage: ``(doc_id, slots, weights)``.

    ``(1 + ln tf) * idf * sign`` summed per hashed slot, L2-normalised; passages without
    tokens get no row.  Only the slots that occur are stored.

    The idf of a term comes by two joins, at every size: the frequent terms, bounded by
    their definition, are broadcast, so that their postings stay where they are; the
    postings of the others, of which none is a hot key, are shuffled by term, and their
    weights back to the documents, in ``buckets`` parts as the table is stored.  A document's
    weights of both kinds are summed per slot at once, in blocks of documents.
    """
    own = stats.select("term", "df", "idf", "slot", "sign")
    often = F.col("df").cast("double") * frequent > F.lit(float(n_postings))
    entry = F.struct("slot", ((F.lit(1.0) + F.log(F.col("tf").cast("double"))) * F.col("idf") * F.col("sign")).alias("w")).alias("e")
    heavy = F.broadcast(own.where(often).select("term", "idf", "slot", "sign"))
    # a left join, so that a document of rare terms only is there too
    near = postings_text.join(heavy, "term", "left").groupBy("doc_id").agg(F.collect_list(F.when(F.col("slot").isNotNull(), entry)).alias("near"))
    rest = postings_text.join(heavy.select("term"), "term", "left_anti")
    far = rest.join(own.where(~often).hint("merge"), "term").select("doc_id", entry)
    far = far.repartition(buckets, "doc_id") if buckets else far.repartition("doc_id")
    far = far.groupBy("doc_id").agg(F.collect_list("e").alias("far"))
    both = near.join(far.hint("merge"), "doc_id", "left")

    def summed(rows: pa.RecordBatch) -> pa.RecordBatch:
        lists = [rows.column(i) for i in (1, 2)]
        text = np.concatenate([pc.list_parent_indices(x).to_numpy(zero_copy_only=False) for x in lists]).astype(np.int64)
        parts = [pc.list_flatten(x).flatten() for x in lists]
        slots, w = (np.concatenate([x[i].to_numpy(zero_copy_only=False) for x in parts]) for i in (0, 1))
        size = int(slots.max()) + 1 if len(slots) else 1
        keys, inverse = np.unique(text * size + slots, return_inverse=True)
        doc, sums = keys // size, np.bincount(inverse, weights=w, minlength=len(keys))
        norm = np.sqrt(np.bincount(doc, weights=sums * sums, minlength=rows.num_rows))[doc]
        unit = np.divide(sums, norm, out=np.zeros_like(sums), where=norm > 0)
        at = pa.array(np.searchsorted(doc, np.arange(rows.num_rows + 1)), pa.int32())
        out = [rows.column(0), *[pa.ListArray.from_arrays(at, x) for x in (pa.array(keys % size, pa.int32()), pa.array(unit))]]
        out = pa.RecordBatch.from_arrays(out, names=["doc_id", "slots", "weights"])
        return out.filter(pc.greater(pc.list_value_length(out.column(1)), 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, VECTORS):
                yield summed(batch.slice(i, VECTORS))

    return both.mapInArrow(run, ", ".join([*ddl(postings_text, "doc_id"), "slots array<int>", "weights array<double>"]))
