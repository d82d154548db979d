"""Substring dedup by content-defined chunks (operator 10).

A gear rolling hash over the last 16 bytes picks the chunk boundaries, so a repeated
passage is cut the same way wherever it stands, a little after its start.  Chunks are
deduplicated by digest: all but the first copy (by document id, then place) are repeats.
A stretch of consecutive repeats of at least RUN_BYTES is deleted from the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import stored, text_blocks
from parley.llm.words import mix, span_hashes

#: Of every SPAN consecutive bytes the first that has the least hash ends a chunk, so that
#: chunks have at most SPAN bytes (but for the ends of a text) and on average half of that.
SPAN = 64
#: Bytes of the shortest stretch of repeated chunks that is deleted.  A stretch lacks what
#: precedes the first common cut of a passage and what follows the last, some 40 bytes each.
RUN_BYTES = 48

#: A random number for each byte value, from a rule.
_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(48)).astype(np.uint16)
_WINDOW = 16


def gear(data: np.ndarray) -> np.ndarray:
    """h[i] = 2 h[i - 1] + G[data[i]] modulo 2^16: what it holds of the last 16 bytes, by
    doubling the number of bytes summed."""
    h = _GEAR[data]
    step = 1
    while step < _WINDOW:
        more = h.copy()
        more[step:] += h[:-step] << np.uint16(step)
        h, step = more, step * 2
    return h


def boundaries(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts of the chunks of all texts, offsets of each text's chunks).

    A boundary that would split a character moves to the next character's start.
    """
    n = len(data)
    least = (gear(data).astype(np.uint64) << np.uint64(40)) | np.arange(n, dtype=np.uint64)
    step = 1
    while step < SPAN:  # the least of `step` values from each place on, by doubling
        more = min(step, SPAN - step)
        least = np.minimum(least[:-more], least[more:])
        step += more
    # windows inside a text whose hashes hold bytes of that text only
    own = np.zeros(len(least) + 1, np.int64)
    first, last = offsets[:-1] + _WINDOW - 1, offsets[1:] - SPAN
    some = last >= first
    np.add.at(own, first[some], 1)
    np.add.at(own, last[some] + 1, -1)
    least = least[np.cumsum(own)[:-1] > 0]
    places = np.unique(least & np.uint64((1 << 40) - 1)).astype(np.int64) + 1
    follows = np.zeros(n + 1, bool)
    follows[:-1] = (data & 0xC0) == 0x80
    whole = np.flatnonzero(~follows)  # where characters start, and the end
    places = whole[np.searchsorted(whole, places)]
    # every text starts a chunk, and so does every place inside a text
    starts = np.unique(np.concatenate((offsets[:-1][np.diff(offsets) > 0], places[places < n])))
    return starts, np.searchsorted(starts, offsets)


#: Bits of the filter of repeated digests, by a digest's highest bits: 32 MB at every size.
FILTER_BITS = 28
#: A chunk's place and length in one number: place * 1024 + length.
_LENGTH_BITS = 10

_CHUNKS = "doc_id {id}, __t long, chunks array<struct<a:long,d:long,e:long>>"


def _chunked(batches: Iterator[pa.RecordBatch], repeated: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Of rows (id, __t, text): place and length in bytes and 128-bit digest of each chunk,
    of those only whose bit in the words of ``repeated`` is set, if it is given."""
    for batch in batches:
        for first, end, data, offsets in text_blocks(batch.column(2)):
            starts, at = boundaries(data, offsets)
            ends = np.append(starts[1:], len(data)) if len(starts) else starts
            d = span_hashes(data, starts, ends)
            place = starts - np.repeat(offsets[:-1], np.diff(at))
            if repeated is not None:
                bit = d >> np.uint64(59 - len(repeated).bit_length())  # 2^n words have n + 6 bits
                some = (repeated[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) > 0
                at = np.concatenate(([0], np.cumsum(some)))[at]
                starts, ends, d, place = starts[some], ends[some], d[some], place[some]
            lengths = ends - starts
            e = span_hashes(data[::-1], len(data) - ends, len(data) - starts) ^ lengths.astype(np.uint64)  # of the bytes backwards
            cells = pa.StructArray.from_arrays([pa.array((place << _LENGTH_BITS) | lengths), pa.array(d.view(np.int64)), pa.array(e.view(np.int64))], ["a", "d", "e"])
            own = [batch.column(c).slice(first, end - first) for c in range(2)]
            yield pa.RecordBatch.from_arrays([*own, pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), cells)], names=["doc_id", "__t", "chunks"])


def repeated_bits(digests: DataFrame) -> np.ndarray:
    """The filter's words: of every digest ``d`` with two rows or more the bit that its
    highest FILTER_BITS bits name.  Counts and words are summed before they move; at most
    2^(FILTER_BITS - 6) words come to the driver."""
    twice = digests.groupBy("d").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    bit = F.shiftrightunsigned("d", 64 - FILTER_BITS)
    named = twice.select(F.shiftrightunsigned(bit, 6).cast("int").alias("word"), bit.bitwiseAND(63).cast("int").alias("bit"))
    words = named.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    bare = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(bare).alias("__t"), bare.alias("text"))


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document (doc_id, __t) with repeated chunks: ``chunks``, a set of (place and
    length in one number, id of the document of the first copy).  Equal rows are one
    document.

    The chunks are computed twice: for the filter of repeated digests, and for the rows
    that it leaves, those of repeated chunks and the few that share a bit with one.  Only
    they are stored and move.  Counts and first places are summed before they move; what is
    joined is stored first, so that a chunk of very many documents can be split, and joined
    by sorting at every size.
    """
    texts = _texts(docs, doc_id, text)
    schema = _CHUNKS.format(id=texts.schema["doc_id"].dataType.simpleString())
    bits = docs.sparkSession.sparkContext.broadcast(repeated_bits(texts.mapInArrow(_chunked, schema).select(F.explode("chunks.d").alias("d"))))

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _chunked(batches, bits.value)

    again = stored(texts.mapInArrow(filtered, schema).select("doc_id", "__t", F.inline("chunks")), "chunk-again")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__t", "a")
    first = again.groupBy("d", "e").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = stored(first.filter(~F.col("first").eqNullSafe(F.col("last"))).select("d", "e", "first"), "chunk-first")
    later = again.join(first.hint("merge"), ["d", "e"]).filter(~place.eqNullSafe(F.col("first")))
    cell = F.struct("a", F.col("first.doc_id").alias("source"))
    return stored(later.groupBy("doc_id", "__t").agg(F.collect_set(cell).alias("chunks")), "chunk-later")


def dedup_substrings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", run_bytes: int = RUN_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_repeat_bytes, repeats (the deleted
    stretches as structs of place and length in bytes), source_ids (the documents that keep
    their first copies, sorted) and text, what is left.

    The first copy is that of the least document id (nulls last; texts that share an id by
    hash), then place.  Equal rows are one document and keep or lose the same bytes.  A
    null text is empty; an empty table gives no rows; other columns are ignored.
    """
    found = repeats(docs, doc_id, text)
    same = (F.col("o.__t") == F.col("r.__t")) & (F.col("o.__k") == F.col("r.__k")) & F.col("o.doc_id").eqNullSafe(F.col("r.doc_id"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = _texts(docs, doc_id, text).withColumn("__k", key).alias("o").join(found.withColumn("__k", key).hint("merge").alias("r"), same, "left")
    rows = rows.select("o.doc_id", "o.text", "r.chunks")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"n_bytes": [], "n_repeat_bytes": [], "repeats": [], "source_ids": [], "text": []}
            for t, found in zip(batch.column(1), batch.column(2)):
                raw, runs, sources, kept, at = t.as_buffer().to_pybytes(), [], set(), [], 0
                cells = [{"at": c["a"] >> _LENGTH_BITS, "n": c["a"] & ((1 << _LENGTH_BITS) - 1), "source": c["source"]} for c in found.as_py() or []]
                for a, n, ids in stretches(cells, run_bytes):
                    runs.append({"at": a, "n": n})
                    sources.update(i for i in ids if i is not None)
                    kept.append(raw[at:a])
                    at = a + n
                out["n_bytes"].append(len(raw))
                out["n_repeat_bytes"].append(sum(r["n"] for r in runs))
                out["repeats"].append(runs)
                out["source_ids"].append(sorted(sources))
                out["text"].append(b"".join([*kept, raw[at:]]).decode("utf-8"))
            types = [pa.int64(), pa.int64(), pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())])), pa.list_(batch.schema.field(0).type), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(v, k) for v, k in zip(out.values(), types)]], names=["doc_id", *out])

    return rows.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_repeat_bytes long, repeats array<struct<at:int,n:int>>, source_ids array<{kind}>, text string")


def stretches(chunks: list[dict], run_bytes: int) -> list[tuple[int, int, set]]:
    """(place, length, sources) of the runs of adjacent chunks of at least ``run_bytes``."""
    out: list[tuple[int, int, set]] = []
    for c in sorted(chunks, key=lambda c: c["at"]):
        if out and out[-1][0] + out[-1][1] == c["at"]:
            a, n, ids = out[-1]
            out[-1] = (a, n + c["n"], ids | {c["source"]})
        else:
            out.append((c["at"], c["n"], {c["source"]}))
    return [r for r in out if r[1] >= run_bytes]
