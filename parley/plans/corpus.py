"""The materialised corpus: collection + conflation + index, built once per input.

Every table is written under the shared ``spark.checkpoint.dir`` (lineage cut by a
written table, which survives executor loss), document-keyed tables bucketed by
``doc_id``.  Global statistics are single numbers read back as Python scalars.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
import uuid
from contextlib import contextmanager
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property
from importlib import resources

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import numpy as np
import pyarrow as pa

from parley.operators.analysis import cleaned, n_tokens, preprocess_clean
from parley.operators.blocks import Tokens, by_blocks
from parley.operators.conflation import build_conflation, changed_entries
from parley.functions.text import STOPWORDS, normalize
from parley.operators.index import build_postings, doc_vectors, term_stats, text_bigrams, text_postings, text_stats
from parley.plans.sizing import bounded_broadcast
from parley.session import apply_plan_settings, checkpoint_root, scratch_path, shuffle_partitions
from parley.sources.collection import latest, register_bucketed, write_bucketed


@dataclass
class Corpus:
    """The index of a collection.  What only the re-rankers read (the tables over the stored
    text) is written when one of them first asks for it, and found again afterwards."""

    collection: DataFrame  # doc_id, data, source, batch_id, n_tokens   (bucketed by doc_id)
    conflation: DataFrame  # surface, stem: every term of V
    stem_map: DataFrame  # changed entries of ``conflation``, broadcast when small
    postings: DataFrame  # doc_id, term, tf, dl  (bucketed by doc_id, files sorted by term)
    term_stats: DataFrame  # term, df, cf, idf
    n_docs: int
    sum_dl: int
    avgdl: float
    root: str
    buckets: int

    def _stored(self, name: str, write: Callable[[str], object], read: Callable[[str], DataFrame]) -> DataFrame:
        """Table ``name`` under ``root``: the one written before, or else written now; its
        path is published last."""
        spark = self.collection.sparkSession
        try:
            paths = [r["value"] for r in spark.read.text(f"{self.root}/_{name}").collect()]
        except AnalysisException:  # not written yet
            paths = []
        if not paths:
            paths = [f"{self.root}/{name}-{uuid.uuid4().hex[:12]}"]
            with _step(name):
                write(paths[0])
            spark.createDataFrame([(paths[0],)], "value string").coalesce(1).write.mode("append").text(f"{self.root}/_{name}")
        return read(min(paths))

    def _bucketed(self, name: str, make: Callable[[], DataFrame], prepartitioned: bool = True) -> DataFrame:
        spark = self.collection.sparkSession
        return self._stored(
            name, lambda path: write_bucketed(make(), path, buckets=self.buckets, prepartitioned=prepartitioned),
            lambda path: register_bucketed(spark, path, "doc_id", self.buckets))

    @cached_property
    def text_postings(self) -> DataFrame:
        """doc_id, term, tf, first_pos  (bucketed by doc_id)"""
        return self._bucketed("text_postings", lambda: text_postings(self.collection))

    @cached_property
    def text_bigrams(self) -> DataFrame:
        """doc_id, a, b, first_pos  (bucketed by doc_id)"""
        return self._bucketed("text_bigrams", lambda: text_bigrams(self.collection))

    @cached_property
    def text_stats(self) -> DataFrame:
        """term, df, cf, idf, slot, sign over stored-text tokens"""
        spark = self.collection.sparkSession
        return self._stored("text_stats", lambda path: text_stats(self.text_postings, self.n_all_docs).write.parquet(path), spark.read.parquet)

    @cached_property
    def doc_vectors(self) -> DataFrame:
        """doc_id, slots, weights  (bucketed by doc_id)"""
        return self._bucketed("doc_vectors", lambda: doc_vectors(self.text_postings, self.text_stats, self._text_sums[2], self.buckets))

    @cached_property
    def _text_sums(self) -> tuple[int, int, int]:
        r = self.text_stats.agg(F.sum("cf").alias("c"), F.count(F.lit(1)).alias("v"), F.sum("df").alias("p")).first()
        return int(r["c"] or 0), int(r["v"] or 0), int(r["p"] or 0)

    @property
    def text_tokens(self) -> int:
        return self._text_sums[0]

    @property
    def text_vocab(self) -> int:
        return self._text_sums[1]

    @cached_property
    def n_all_docs(self) -> int:
        return int(self.collection.count())


@contextmanager
def _step(name: str):
    t = time.time()
    yield
    if os.environ.get("PARLEY_TRACE"):
        print(f"[corpus] {name}: {time.time() - t:.2f}s", flush=True)


def vocabulary(raw: DataFrame, clean_col: str | None = None) -> DataFrame:
    """``(term, df)`` of the collection after T1–T3 (one row per distinct term of a document).

    With ``clean_col`` (stored T1–T3 text, tokens joined by a space) no regex runs here.
    """
    if clean_col is None:
        stop = F.array(*[F.lit(w) for w in (*STOPWORDS, "")])
        terms = F.array_except(F.split(F.trim(normalize("text")), " "), stop)
    else:
        def block(rows: pa.RecordBatch, texts: pa.Array) -> list[pa.Array]:
            tokens = Tokens.split(texts)
            df = np.bincount(tokens.counts()[1], minlength=len(tokens.terms))
            return [pa.array(tokens.terms, pa.string()), pa.array(df, pa.int64())]

        return by_blocks(raw.select(clean_col), clean_col, "term string, df bigint", block).groupBy("term").agg(F.sum("df").alias("df"))
    toks = raw.select(F.explode(terms).alias("term"))
    return toks.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def build_corpus(raw: DataFrame, root: str | None = None, buckets: int | None = None) -> Corpus:
    """raw ``collection(doc_id, text, source, batch_id)`` -> materialised :class:`Corpus`.

    An id that occurs again replaces the older one (latest batch, see S4); the exchange
    that buckets the collection brings its rows together.
    """
    spark = raw.sparkSession
    apply_plan_settings(spark)
    root = root or scratch_path(spark, "corpus")
    n = buckets or shuffle_partitions(spark)
    with _step("raw"):
        # T1–T3 once; everything downstream splits this plain string
        clean = cleaned(latest(raw.repartition(n, "doc_id")).select("doc_id", "text", "source", "batch_id"), "text")
        raw_t = write_bucketed(clean, f"{root}/raw", buckets=n, prepartitioned=True)
    with _step("vocabulary"):
        vocabulary(raw_t, "clean").write.mode("overwrite").parquet(f"{root}/vocabulary")
    with _step("conflation"):
        build_conflation(spark.read.parquet(f"{root}/vocabulary")).write.mode("overwrite").parquet(f"{root}/conflation")
        conf = spark.read.parquet(f"{root}/conflation")
    with _step("stem_map"):
        changed_entries(conf).write.mode("overwrite").parquet(f"{root}/stem_map")
        stem_map = bounded_broadcast(spark.read.parquet(f"{root}/stem_map"))
    with _step("collection"):
        coll = preprocess_clean(raw_t, ["doc_id"], "clean", stem_map).withColumn("n_tokens", n_tokens("data"))
        coll_t = write_bucketed(coll.select("doc_id", "data", "source", "batch_id", "n_tokens"), f"{root}/collection", buckets=n, prepartitioned=True)
    with _step("postings"):
        post_t = write_bucketed(build_postings(coll_t, stem_map), f"{root}/postings", buckets=n, prepartitioned=True, sort="term")
    with _step("stats"):
        lengths = post_t.groupBy("doc_id").agg(F.sum("tf").alias("s"))  # within the buckets
        g = lengths.agg(F.count(F.lit(1)).alias("n"), F.sum("s").alias("s")).first()
        n_docs, sum_dl = int(g["n"] or 0), int(g["s"] or 0)
        term_stats(post_t, n_docs).write.mode("overwrite").parquet(f"{root}/term_stats")
    return Corpus(
        collection=coll_t,
        conflation=conf,
        stem_map=stem_map,
        postings=post_t,
        term_stats=spark.read.parquet(f"{root}/term_stats"),
        n_docs=n_docs,
        sum_dl=sum_dl,
        avgdl=(sum_dl / n_docs) if n_docs else 0.0,
        root=root,
        buckets=n,
    )


_CACHE: dict[tuple[str, str], Corpus] = {}

_BUCKETED = ("collection", "postings")
_SCALARS = ("n_docs", "sum_dl", "avgdl")


def input_files(spark: SparkSession, sf_dir: str) -> list[tuple[str, int, int]]:
    """(path, bytes, mtime) of the documents table's files, via the Hadoop file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/documents.parquet")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    sts = fs.listStatus(p) if fs.isDirectory(p) else [fs.getFileStatus(p)]
    return [(st.getPath().toString(), int(st.getLen()), int(st.getModificationTime())) for st in sts]


def _input_key(files: list[tuple[str, int, int]]) -> str:
    """Identity of the corpus input (path, size and modification time) and of the code."""
    parts = sorted(f"{a}|{b}|{c}" for a, b, c in files)
    return hashlib.sha1(("\n".join(parts) + _code_version()).encode()).hexdigest()[:16]


BUCKET_BYTES = 16 * 1024 * 1024


def bucket_count(spark: SparkSession, input_bytes: int) -> int:
    """Buckets for the corpus tables: one per 16 MB of input, and for small inputs as many
    as there are cores to work on them, up to ``spark.sql.shuffle.partitions``.

    What a query batch makes of a bucket (a sum per turn and document) is held and sorted in
    one task, and is many times the bucket's text: of 128 MB it did not fit and was spilled.

    A bucketed scan is one task per bucket, so the count has to follow the bytes: the
    setting bounds only how far a small input is spread.
    """
    spread = min(spark.sparkContext.defaultParallelism, shuffle_partitions(spark))
    return max(1, spread, -(-input_bytes // BUCKET_BYTES))


def _code_version() -> str:
    """Hash of the engine sources, so a changed analysis never reuses an older index; read as
    package resources, so that it also works from a zip."""
    h = hashlib.sha1()
    for sub in ("functions", "operators", "plans", "sources"):
        for f in sorted(resources.files(f"parley.{sub}").iterdir(), key=lambda f: f.name):
            if f.name.endswith(".py"):
                h.update(f.read_bytes())
    return h.hexdigest()


def _save_manifest(spark: SparkSession, corpus: Corpus, build_root: str, buckets: int) -> None:
    meta = {k: getattr(corpus, k) for k in _SCALARS}
    meta.update(root=build_root, buckets=buckets)
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{build_root}/_manifest")


def _load_manifest(spark: SparkSession, cache_root: str) -> Corpus | None:
    try:
        rows = spark.read.text(f"{cache_root}/*/_manifest").collect()
    except AnalysisException:  # no such path: nothing built yet
        return None
    if not rows:
        return None
    meta = json.loads(min(r["value"] for r in rows))  # builds of one key hold the same rows
    root, n = meta["root"], int(meta["buckets"])
    t = {name: register_bucketed(spark, f"{root}/{name}", "doc_id", n, sort="term" if name == "postings" else None) for name in _BUCKETED}
    apply_plan_settings(spark)
    return Corpus(
        collection=t["collection"],
        conflation=spark.read.parquet(f"{root}/conflation"),
        stem_map=bounded_broadcast(spark.read.parquet(f"{root}/stem_map")),
        postings=t["postings"],
        term_stats=spark.read.parquet(f"{root}/term_stats"),
        root=root,
        buckets=n,
        **{k: meta[k] for k in _SCALARS},
    )


def corpus_for(spark: SparkSession, sf_dir: str) -> Corpus:
    """The corpus of ``sf_dir``'s documents, built once.

    Within an application it is kept in memory; across applications it is found again
    under the shared checkpoint folder, keyed by the identity of the input files, and
    its bucketed tables are re-registered instead of rebuilt.
    """
    from parley.sources import fixtures

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    c = _CACHE.get(key)
    if c is not None:
        return c
    files = input_files(spark, sf_dir)
    cache_root = f"{checkpoint_root(spark).rstrip('/')}/parley/corpus-cache/{_input_key(files)}"
    c = _load_manifest(spark, cache_root)
    if c is None:
        build_root = f"{cache_root}/build-{uuid.uuid4().hex[:12]}"
        n = bucket_count(spark, sum(b for _, b, _ in files))
        c = build_corpus(fixtures.collection(spark, sf_dir), build_root, n)
        _save_manifest(spark, c, build_root, n)
    _CACHE[key] = c
    return c
