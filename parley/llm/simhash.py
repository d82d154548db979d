"""Near-duplicate documents by SimHash and pigeonhole blocks (operator 12).

A text's fingerprint has a bit set where more than half of the XXH64 hashes of its 3-word
shingles have it.  Fingerprints that differ in at most DISTANCE bits agree in at least one
of DISTANCE + 1 blocks of bits, so a join on blocks meets every such pair; the Hamming
distance is then verified.  A block value that very many fingerprints share is dealt again
by blocks of the remaining bits, where the same holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import stored, utf8
from parley.llm.components import components

#: Words of a shingle, the seed of its hash, and the most differing bits of a link.
SHINGLE, SEED, DISTANCE = 3, 42, 3
#: Fingerprints of one block value that are compared with each other at once.
BUCKET = 1024
#: Text bytes handled at once, within a text too.
PIECE = 1 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def word_pieces(raw: memoryview, limit: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text, lower-cased (A-Z), in lists of about ``limit`` bytes of text."""
    at = 0
    while at < len(raw):
        end = min(at + limit, len(raw))
        while end < len(raw):  # up to the next blank
            stop = min(end + 4096, len(raw))
            blank = np.flatnonzero(_BLANK[np.frombuffer(raw[end:stop], np.uint8)])
            if len(blank):
                end += int(blank[0])
                break
            end = stop
        yield bytes(raw[at:end]).lower().split()
        at = end


def hashes(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """XXH64 of every ``size`` consecutive words, joined by a space."""
    text = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
    return np.array([digest(text[a:b], SEED) for a, b in spans], np.uint64)


def fingerprint(raw: memoryview) -> int:
    """The 64-bit fingerprint of a text (UTF-8); 0 if it has no words."""
    ones, n, tail = np.zeros(64, np.int64), 0, []
    for words in word_pieces(raw):
        words = tail + words
        if len(words) >= SHINGLE:
            h = hashes(words)
            bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
            n += len(h)
            words = words[1 - SHINGLE :]
        tail = words
    if n == 0 and tail:  # fewer words than a shingle: the whole sequence
        h = xxhash.xxh64_intdigest(b" ".join(tail), SEED)
        return h
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        raw, at = memoryview(data), offsets.tolist()
        out = np.array([fingerprint(raw[a:b]) for a, b in zip(at[:-1], at[1:])], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long; a null text is empty."""
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return own.mapInArrow(_fingerprints, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, fp long")


def blocks(mask: int, count: int = DISTANCE + 1) -> list[int]:
    """``mask`` with each of ``count`` runs of the bits it lacks added."""
    free = [i for i in range(64) if not mask >> i & 1]
    cuts = [len(free) * j // count for j in range(count + 1)]
    return [mask | sum(1 << i for i in free[a:b]) for a, b in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (fps), the fingerprints of one block value: links (a, b) that join what is
    within DISTANCE of each other, one less than there are fingerprints in a component."""
    for batch in batches:
        a, b = [], []
        values = batch.column(0)
        flat, at = values.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.concatenate(([0], np.cumsum(values.value_lengths().to_numpy(zero_copy_only=False))))
        for i, j in zip(at[:-1].tolist(), at[1:].tolist()):
            fps = np.unique(flat[i:j])
            if len(fps) == 2:  # most block values
                if int(fps[0] ^ fps[1]).bit_count() <= DISTANCE:
                    a.append(fps[0]), b.append(fps[1])
                continue
            near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= DISTANCE
            left = np.ones(len(fps), bool)
            for k in range(len(fps)):
                if not left[k]:
                    continue
                left[k], front = False, np.array([k])
                while len(front):
                    found = near[front].any(axis=0) & left
                    front = np.flatnonzero(found)
                    left[front] = False
                    a += [fps[k]] * len(front)
                    b += list(fps[front])
        pair = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)]
        yield pa.RecordBatch.from_arrays(pair, names=["a", "b"])


def links(fps: DataFrame) -> DataFrame:
    """(a, b), stored: links between the distinct fingerprints ``fps`` (fp) whose components
    are those of all pairs within DISTANCE.

    A level fixes one more block of the bits that are left.  Block values of up to BUCKET
    fingerprints are compared whole; larger ones go on to the next level, whose buckets
    shrink until so few bits are left that none can be larger.  Tables that are joined on
    a block value are stored first, so that adaptive execution can split a hot one; joins
    sort at every size.
    """
    spark = fps.sparkSession
    level, masks, found = fps.select("fp", F.lit(0).cast("long").alias("mask")), {0}, None
    while masks:
        children = {m: blocks(m) for m in masks}
        table = spark.createDataFrame([(_signed(m), _signed(c)) for m, cs in children.items() for c in cs], "mask long, child long")  # 4 rows a mask: 4, 16, 64, ...
        cells = level.join(F.broadcast(table), "mask").select("fp", F.col("child").alias("mask"), F.col("fp").bitwiseAND(F.col("child")).alias("value"))
        cells = stored(cells if found is None else cells.distinct(), "simhash-cells")
        sizes = stored(cells.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "simhash-sizes")
        small = cells.join(sizes.filter(F.col("c") <= BUCKET).hint("merge"), ["mask", "value"]).groupBy("mask", "value").agg(F.collect_list("fp").alias("fps"))
        close = stored(small.select("fps").mapInArrow(_close, "a long, b long").distinct(), "simhash-links")
        found = close if found is None else found.union(close)
        large = sizes.filter(F.col("c") > BUCKET)
        masks = {r["mask"] % (1 << 64) for r in large.select("mask").distinct().collect()}  # blocks, not fingerprints
        if masks:
            level = stored(cells.join(large.select("mask", "value").hint("merge"), ["mask", "value"], "left_semi").select("fp", "mask"), "simhash-level")
    return found


def _hex(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 lowercase hex digits),
    component_id (the smallest doc_id reachable by links, its own included).

    Words are runs of other than space and \\t to \\r, A-Z lower-cased; a text of fewer than
    three, but not none, is one shingle.  Equal fingerprints are one node, so that copies
    cost a row each and no pair.  Texts without words, null ones among them, have fingerprint
    zero, which links like any other.  A null doc_id is no component_id unless its
    component has no other.  Equal rows get equal results; an empty table gives none;
    other columns are ignored.
    """
    own = stored(fingerprints(docs, doc_id, text), "simhash-docs")
    nodes = stored(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    joined = links(nodes.select("fp")).select(_hex("a").alias("a"), _hex("b").alias("b"))
    labels = components(stored(joined, "simhash-pairs"))
    nodes = stored(nodes.withColumn("node", _hex("fp")).join(labels.hint("merge"), "node", "left").select("fp", "node", "least", F.coalesce("label", "node").alias("label")), "simhash-labels")
    heads = stored(nodes.groupBy("label").agg(F.min("least").alias("component_id")), "simhash-heads")
    nodes = stored(nodes.join(heads.hint("merge"), "label").select("fp", "node", "component_id"), "simhash-classes")
    return own.join(nodes.hint("merge"), "fp").select("doc_id", F.col("node").alias("fingerprint"), "component_id")
