"""Benchmark decontamination by winnowing (operator 2)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import text_blocks, whole
from parley.llm.words import Words

#: A contaminating passage has at least so many words (or is a whole shorter item).
SPAN = 10
#: Words of a k-gram; the sliding window then holds SPAN - GRAM + 1 of them.
GRAM = 6
#: UTF-8 bytes of benchmark text indexed, and broadcast, at a time.
INDEX_BYTES = 16 << 20


def minima(hashes: np.ndarray, whole: np.ndarray, window: int) -> np.ndarray:
    """Places of the rightmost minimum of each window of hashes that is ``whole``."""
    n = len(whole)
    best, place = hashes[:n].copy(), np.arange(n)
    for j in range(1, window):
        h = hashes[j : j + n]
        less = h <= best
        best[less] = h[less]
        place[less] = np.flatnonzero(less) + j
    place = place[whole]
    return place[np.concatenate(([True], place[1:] != place[:-1]))] if len(place) else place


def fingerprints(words: Words, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the k-grams that winnowing keeps.

    Two texts that share ``span`` consecutive words share a kept k-gram inside them: the
    window over that span holds the same hashes in both.
    """
    h = words.grams(gram)
    at = minima(h, words.fits(span), span - gram + 1)
    return at, h[at]


@dataclass
class Index:
    """Items of one benchmark block: their words, kept k-grams, and whole short items."""

    ids: list[str]
    words: list[list[bytes]]
    prints: np.ndarray
    rows: np.ndarray
    places: np.ndarray
    short: dict[int, dict[bytes, list[int]]]
    short_hashes: dict[int, np.ndarray]


def build_index(ids: list[str], texts: list[str | None], span: int = SPAN, gram: int = GRAM) -> Index:
    """Index of items; a null or wordless text has no window."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
    words = Words(np.frombuffer(b"".join(raw), np.uint8), offsets)
    at, prints = fingerprints(words, span, gram)
    order = np.argsort(prints, kind="stable")
    rows = np.searchsorted(words.at, at, side="right") - 1
    lists = [words.list(int(a), int(b)) for a, b in zip(words.at[:-1], words.at[1:])]
    short: dict[int, dict[bytes, list[int]]] = {}
    hashes: dict[int, list[int]] = {}
    for i, item in enumerate(lists):
        if 0 < len(item) < span:
            short.setdefault(len(item), {}).setdefault(b" ".join(item), []).append(i)
            hashes.setdefault(len(item), []).append(int(words.at[i]))
    short_hashes = {m: np.unique(words.grams(m)[np.array(p)]) for m, p in hashes.items()}
    return Index(ids, lists, prints[order], rows[order], (at - words.at[rows])[order], short, short_hashes)


def _extend(doc: list[bytes], item: list[bytes], p: int, q: int) -> tuple[int, int]:
    """The longest run of equal words around doc[p] = item[q], as places in doc."""
    a, b = p, q
    while a > 0 and b > 0 and doc[a - 1] == item[b - 1]:
        a, b = a - 1, b - 1
    n, m = len(doc), len(item)
    while p < n and q < m and doc[p] == item[q]:
        p, q = p + 1, q + 1
    return a, p


def _lookup(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lo = np.searchsorted(table, values)
    return lo, np.searchsorted(table, values, side="right")


def hits(words: Words, index: Index, span: int, gram: int) -> dict[int, tuple[list[tuple[int, int]], set[str]]]:
    """Per text with hits: (runs of hit words, ids of the items that hit them)."""
    found: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
    pairs: dict[int, list[tuple[int, int, int]]] = {}
    if len(index.prints):
        at, prints = fingerprints(words, span, gram)
        lo, hi = _lookup(index.prints, prints)
        for k in np.flatnonzero(hi > lo):
            text = int(np.searchsorted(words.at, at[k], side="right")) - 1
            pairs.setdefault(text, []).append((int(at[k] - words.at[text]), int(lo[k]), int(hi[k])))
    for text, candidates in pairs.items():
        doc = words.list(int(words.at[text]), int(words.at[text + 1]))
        done: dict[tuple[int, int], int] = {}
        for p, lo_k, hi_k in candidates:
            for k in range(lo_k, hi_k):
                row, q = int(index.rows[k]), int(index.places[k])
                if done.get((row, q - p), -1) > p:
                    continue
                a, b = _extend(doc, index.words[row], p, q)
                done[row, q - p] = b
                if b - a >= span:
                    runs, items = found.setdefault(text, ([], set()))
                    runs.append((a, b))
                    items.add(index.ids[row])
    for m, hashes in index.short_hashes.items():
        whole = words.fits(m)
        lo, hi = _lookup(hashes, words.grams(m))
        for p in np.flatnonzero((hi > lo) & whole):
            text = int(np.searchsorted(words.at, p, side="right")) - 1
            rows = index.short[m].get(b" ".join(words.list(int(p), int(p) + m)))
            if rows:
                a = int(p - words.at[text])
                runs, items = found.setdefault(text, ([], set()))
                runs.append((a, a + m))
                items.update(index.ids[r] for r in rows)
    return found


def union(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching runs joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


_STATE = pa.list_(pa.int32()), pa.list_(pa.string())


def _scan(index, text_col: str, span: int, gram: int):
    """mapInArrow function that adds one block's hits to the columns runs and items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            n_words = np.zeros(batch.num_rows, np.int64)
            state: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
            texts = batch.column("row").field(text_col) if "row" in names else batch.column(text_col)
            for first, _, data, offsets in text_blocks(texts):
                words = Words(data, offsets)
                n_words[first : first + len(offsets) - 1] = np.diff(words.at)
                for i, found in hits(words, index.value, span, gram).items():
                    state[first + i] = found
            runs, items = batch.column(names.index("__runs")), batch.column(names.index("__items"))
            new_runs, new_items = [], []
            for i in range(batch.num_rows):
                old = runs[i].as_py() or [] if len(runs[i]) else []
                if i in state or old:
                    more, ids = state.get(i, ([], set()))
                    joined = union([*zip(old[::2], old[1::2]), *more])
                    new_runs.append([x for r in joined for x in r])
                    new_items.append(sorted({*(items[i].as_py() or []), *ids}))
                else:
                    new_runs.append([])
                    new_items.append([])
            new = {"__words": pa.array(n_words), "__runs": pa.array(new_runs, _STATE[0]), "__items": pa.array(new_items, _STATE[1])}
            yield pa.RecordBatch.from_arrays([new.get(x, batch.column(k)) for k, x in enumerate(names)], names=names)

    return run


def marked(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
           span: int = SPAN, gram: int = GRAM, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``docs`` (with the column ``text``, or a struct ``row`` that holds it) and ``__words``
    (number of words), ``__runs`` (hit word places as start, end, start, end ...) and
    ``__items`` (ids of the items, sorted).

    The benchmark is indexed in blocks of at most ``index_bytes`` of text (a single longer
    item is a block), each broadcast and held against all documents; nothing of the
    documents is shuffled or collected.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.col(item_text).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + F.lit(16)).alias("b")).first()["b"] or 0
    count = max(1, -(-int(size) // max(1, index_bytes // 2)))
    out = docs.withColumns({"__words": F.lit(0).cast("long"), "__runs": F.array().cast("array<int>"), "__items": F.array().cast("array<string>")})
    for b in range(count):
        block = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == b).collect() if count > 1 else items.collect()
        index = spark.sparkContext.broadcast(build_index([r["id"] for r in block], [r["text"] for r in block], span, gram))
        if b:
            out = out.checkpoint()  # one Python stage at a time
        out = out.mapInArrow(_scan(index, text, span, gram), out.schema)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, item_ids, hit_runs.

    A window is ``span`` consecutive words of an item (the whole item if it has fewer, but
    not none); document words inside any occurrence of a window are hit.  Null and empty
    texts have no words; equal rows get equal results; items that share an id count once,
    a null id counts as ''; an empty benchmark hits nothing; other columns of ``docs`` are
    ignored.
    """
    rows = marked(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), benchmark, **options)
    n_hit = F.aggregate(F.transform("__runs", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.select("doc_id", F.col("__words").alias("n_words"), n_hit.alias("n_hit"), F.size("__items").cast("long").alias("n_items"),
                       F.col("__items").alias("item_ids"), F.col("__runs").alias("hit_runs"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated rows, all columns kept (cases as in ``decontaminate``)."""
    return marked(docs.select(whole(docs)), benchmark, text, **options).filter(F.size("__items") == 0).select("row.*")
