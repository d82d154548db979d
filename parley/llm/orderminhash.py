"""Near-duplicate documents by order MinHash (operator 6).

A sketch of a text holds, for each of SKETCHES hash functions, the ELEMENTS least of its
occurrence-labelled k-mers (K consecutive words, and which occurrence of them it is) in
the order in which they stand in the text.  Texts of a small edit distance share sketches;
the same k-mers in another order do not.  Documents that share a sketch are candidates,
and a banded alignment of their k-mer sequences verifies them.

A bucket's members are aligned with one hub first, which brings most duplicates into one
class.  Pairs of a bucket that are of different classes by then are all compared, in tiles
of members: those whose k-mers overlap enough are aligned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import spread, stored, text_blocks, whole
from parley.llm.components import components
from parley.llm.words import Words, mix

#: Words of a k-mer, and the least similarity of duplicates.
K, SIMILARITY = 5, 0.8
#: With similarity 0.8 a sketch of 2 elements agrees with probability of about 0.64, so
#: that two such texts share none of 16 sketches in fewer than 1 of 10 million cases.
SKETCHES, ELEMENTS = 16, 2
#: Sketches that candidates must share before they are aligned (expected: 10 of 16).
AGREE = 2
#: Documents are grouped by each sketch, and again by each run of 2 (up to DEPTH) of them:
#: where many texts share one passage, the groups of two sketches tell them apart.
DEPTH = 2
#: Members of a bucket are dealt into blocks of about so many, and of so many bytes of
#: k-mers; every two blocks meet in a task.
MEMBERS, HELD = 512, 8 << 20


def kmers(words: Words, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all texts' k-mers, offsets of each text's); a text of fewer than k words,
    but not none, has one k-mer of all its words."""
    n = np.diff(words.at)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    at = np.concatenate(([0], np.cumsum(count)))
    out = np.zeros(at[-1], np.uint64)
    grams = words.grams(k)
    first = np.repeat(words.at[:-1], count) + np.arange(at[-1]) - np.repeat(at[:-1], count)
    full = np.repeat(n >= k, count)
    out[full] = grams[first[full]]
    for i in np.flatnonzero((n > 0) & (n < k)):
        h = np.uint64(n[i])
        for x in words.hashes[words.at[i] : words.at[i + 1]]:
            h = mix(np.array([h], np.uint64) * np.uint64(31) + x)[0]
        out[at[i]] = h
    return out, at


def labelled(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The hashes with the number of earlier equal ones in the same text mixed in."""
    if not len(hashes):
        return hashes
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((np.arange(len(hashes)), hashes, text))
    h, t = hashes[order], text[order]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])))
    start = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    nth = np.empty(len(h), np.uint64)
    nth[order] = (np.arange(len(h)) - start).astype(np.uint64)
    return mix(hashes + nth * np.uint64(0x9E3779B97F4A7C15))


def sketches(hashes: np.ndarray, at: np.ndarray, count: int = SKETCHES, elements: int = ELEMENTS) -> np.ndarray:
    """A row of ``count`` sketches for each text that has k-mers, in order."""
    n = np.diff(at)
    own, starts = np.flatnonzero(n > 0), at[:-1][n > 0]
    sizes = n[own]
    out = np.zeros((len(own), count), np.uint64)
    top = np.uint64(2**64 - 1)
    places = np.arange(len(hashes))
    for s in range(count):
        values = mix(hashes ^ mix(np.array([s + 1], np.uint64) * np.uint64(0xA0761D6478BD642F))[0])
        found = []
        for _ in range(elements):
            least = np.minimum.reduceat(values, starts) if len(starts) else values[:0]
            where = np.minimum.reduceat(np.where(values == np.repeat(least, sizes), places, len(hashes)), starts) if len(starts) else places[:0]
            found.append(np.where(least < top, where, -1))  # -1: no such element
            values[where] = top
        order = np.sort(np.array(found), axis=0)  # the order of the text
        h = np.zeros(len(own), np.uint64)
        for row in order:
            h = mix(h * np.uint64(0xD6E8FEB86659FD93) + np.where(row >= 0, hashes[row], np.uint64(0)))
        out[:, s] = h
    return out


_COLUMNS = "__t long, __u long, node string, n int, sketch array<long>"


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (id, __t, __u, text): the node (equal word sequences share it; a text without
    words is a node of its own), the number of k-mers, and the sketches."""
    for batch in batches:
        for first, end, data, offsets in text_blocks(batch.column(3)):
            words = Words(data, offsets)
            hashes, at = kmers(words)
            whole = np.zeros((2, len(at) - 1), np.uint64)  # two sums over (word, place)
            place = np.arange(len(words)) - np.repeat(words.at[:-1], np.diff(words.at))
            for i, salt in enumerate((0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)):
                h = mix(words.hashes ^ mix(place.astype(np.uint64) + np.uint64(salt)))
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h, dtype=np.uint64)))
                whole[i] = mix(sums[words.at[1:]] - sums[words.at[:-1]] + np.diff(words.at).astype(np.uint64))
            own, t, u = (batch.column(c).slice(first, end - first) for c in range(3))
            n = np.diff(at).tolist()
            rows = iter(sketches(labelled(hashes, at), at).view(np.int64).tolist())
            names = [f"{a:016x}{b:016x}" if k else f"-{x % 2**64:016x}{y % 2**64:016x}" for a, b, k, x, y in zip(*whole.tolist(), n, t.to_pylist(), u.to_pylist())]
            yield pa.RecordBatch.from_arrays([
                own, t, u, pa.array(names, pa.string()), pa.array(n, pa.int32()),
                pa.array([next(rows) if k else [] for k in n], pa.list_(pa.int64()))], names=["doc_id", "__t", "__u", "node", "n", "sketch"])


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (node, text): the k-mers in order, as 32-bit numbers."""
    for batch in batches:
        for first, end, data, offsets in text_blocks(batch.column(1)):
            hashes, at = kmers(Words(data, offsets))
            small = (hashes >> np.uint64(32)).astype("<u4").tobytes()
            own = pa.array([small[4 * a : 4 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), own], names=["node", "kmers"])


def similarity(a: np.ndarray, b: np.ndarray, least: float) -> float:
    """Aligned k-mers over all k-mers, m / (len(a) + len(b) - m), m the longest common
    subsequence within the band of diagonals that a similarity of ``least`` leaves."""
    if len(a) > len(b):
        a, b = b, a
    total = len(a) + len(b)
    need = least * total / (1 + least)
    if len(a) < need:
        return 0.0
    band = int(total - 2 * need) + 1
    same = a == b[: len(a)]
    head = int(np.argmin(same)) if not same.all() else len(a)
    same = a[head:][::-1] == b[head:][::-1][: len(a) - head]
    tail = int(np.argmin(same)) if len(same) and not same.all() else len(same)
    a, b = a[head : len(a) - tail].tolist(), b[head : len(b) - tail].tolist()
    masks: dict[int, int] = {}
    wanted = set(b)
    for i, x in enumerate(a):
        if x in wanted:
            masks[x] = masks.get(x, 0) | 1 << i
    # bit-parallel rows: a zero bit marks a step of the longest common subsequence
    full = (1 << len(a)) - 1
    v, window = full, (1 << (2 * band + 1)) - 1
    for j, x in enumerate(b):
        m = masks.get(x)
        if m:
            u = v & m & (window << (j - band) if j > band else window >> (band - j))
            v = ((v + u) | (v - u)) & full
    matched = head + tail + len(a) - v.bit_count()
    return matched / (total - matched) if total > matched else 1.0


_CHECKED = "a string, b string, linked boolean"


def _verify(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [similarity(*(np.frombuffer(k.as_py(), "<u4") for k in pair), least) >= least for pair in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keep, pa.bool_())], names=["a", "b", "linked"])

    return run


class Tile:
    """Members of one bucket, of one block or of two, that meet in a task: a row for each of
    (i, cross, block, node, n, label, hubs, sketch), and its k-mers."""

    def __init__(self, rows: pa.Table, least: float):
        column = lambda c: rows.column(c).to_numpy()
        self.least, self.i, self.cross = least, int(column("i")[0]), bool(column("cross")[0])
        self.block, self.n, self.label = column("block"), column("n").astype(np.int64), column("label").copy()
        self.nodes = rows.column("node").to_pylist()
        self.sketch = rows.column("sketch").combine_chunks().flatten().to_numpy().reshape(len(self.n), -1)
        self.hubs = (column("hubs")[:, None] >> np.arange(self.sketch.shape[1]) & 1).astype(bool)

    def open(self, x: int) -> np.ndarray:
        """The members after ``x`` to compare with it: of another class and a near enough
        length, alike in AGREE sketches of which this bucket's is the first, and not aligned
        before, as a member and its hub are."""
        y = slice(x + 1, None)
        ok = (self.label[y] != self.label[x]) & (np.minimum(self.n[y], self.n[x]) >= self.least * np.maximum(self.n[y], self.n[x]))
        if self.cross:
            ok &= self.block[y] != self.block[x]
        at = np.flatnonzero(ok) + x + 1
        same = self.sketch[at] == self.sketch[x]
        ok = (same.argmax(axis=1) == self.i) & (same.sum(axis=1) >= AGREE) & ~(same & (self.hubs[at] | self.hubs[x])).any(axis=1)
        return at[ok]

    def waiting(self) -> list[str]:
        """The members of a pair to compare."""
        found = np.zeros(len(self.n), bool)
        for x in range(len(self.n) - 1):
            at = self.open(x)
            found[at] = True
            found[x] |= len(at) > 0
        return [self.nodes[x] for x in np.flatnonzero(found)]

    def links(self, kmers: list[bytes]) -> list[tuple[str, str]]:
        """Links that join all classes which some pair to compare joins.  The aligned k-mers
        of two texts are at most those they share, so few pairs have to be aligned."""
        texts = [np.frombuffer(k, "<u4") for k in kmers]
        at = np.concatenate(([0], np.cumsum(self.n)))
        codes = np.unique(labelled(mix(np.concatenate(texts).astype(np.uint64)), at), return_inverse=True)[1]
        own, out = np.zeros(len(codes), bool), []
        for x in range(len(self.n) - 1):
            y = self.open(x)
            if not len(y):
                continue
            mine = codes[at[x] : at[x + 1]]
            own[mine] = True
            shared = np.add.reduceat(own[codes[spread(self.n[y], at[y])]], np.cumsum(self.n[y]) - self.n[y], dtype=np.int64)
            own[mine] = False
            enough = shared >= self.least * (self.n[x] + self.n[y]) / (1 + self.least) - 1e-6
            for j in y[enough][np.argsort(-shared[enough], kind="stable")].tolist():
                if self.label[j] != self.label[x] and similarity(texts[x], texts[j], self.least) >= self.least:
                    self.label[self.label == self.label[j]] = self.label[x]
                    out.append((self.nodes[x], self.nodes[j]))
        return out


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each tile, of batches sorted by ``tile``."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        if held is not None:
            rows = pa.concat_tables([held, rows])
        tile = rows.column("tile").to_numpy()
        cuts = [0, *(np.flatnonzero(tile[1:] != tile[:-1]) + 1).tolist()]
        for a, b in zip(cuts, cuts[1:]):
            yield rows.slice(a, b - a)
        held = rows.slice(cuts[-1])
    if held is not None:
        yield held


def _waiting(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _tiles(batches):
            found = Tile(rows, least).waiting()
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([rows.column(c)[0].as_py()] * len(found), k) for c, k in (("i", pa.int32()), ("key", pa.int64()))] + [pa.array(found, pa.string())], names=["i", "key", "node"])

    return run


def _linked(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _tiles(batches):
            found = Tile(rows, least).links(rows.column("kmers").to_pylist())
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found)], names=["a", "b"])

    return run


def _cells(nodes: DataFrame, depth: int) -> DataFrame:
    """``nodes`` once for each bucket (i, key) that it is in."""
    width = F.size("sketch")

    def keys(d: int):
        key = lambda i: F.xxhash64(F.lit(d), *[F.get("sketch", (i + j) % width) for j in range(d)])
        return F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.struct((i * depth + d).alias("i"), key(i).alias("key")))

    cells = [keys(d) for d in range(1, depth + 1)]
    return nodes.filter(width > 0).withColumn("cell", F.explode(F.concat(*cells))).select("*", "cell.*").drop("cell")


def candidates(nodes: DataFrame, least: float = SIMILARITY, depth: int = DEPTH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """((a, b): a document a and the hub b of a bucket of documents with equal sketches,
    (i, key, c): the number of documents in each bucket of several, (i, key, hub)).

    The hub is the member that shares most sketches with others (the original of a group
    of edited copies is nearer to all of them than they are to each other), so a bucket
    gives one pair per member; ``_across`` compares its other pairs.  Pairs whose sketches as a whole are too far
    apart go.  Where members are too short or too long for their hub, the bucket is dealt
    again by length: two texts of near enough lengths share one of their two classes, each
    of which has its own hub, the shortest.  What is joined is stored first, so that a join on a key of
    very many rows has plain exchanges, which adaptive execution splits; joins sort at
    every size.
    """
    cells = _cells(nodes, depth)
    sizes = stored(cells.groupBy("i", "key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "sketch-sizes")
    fame = stored(cells.select("node", "i", "key").join(sizes.hint("merge"), ["i", "key"]).groupBy("node").agg(F.sum("c").alias("fame")), "sketch-fame")
    # one byte of each sketch is enough to count how many agree
    brief = F.transform("sketch", lambda x: F.pmod(x, F.lit(251)).cast("short")).alias("brief")
    ranked = stored(_cells(nodes.join(fame.hint("merge"), "node"), depth).select("node", "i", "key", "fame", "n", brief), "sketch-ranked")
    hubs = stored(ranked.groupBy("i", "key").agg(F.max(F.struct("fame", "node", "n", "brief")).alias("hub")), "sketch-hubs")
    agree = F.size(F.filter(F.zip_with("brief", "hub.brief", lambda x, y: x == y), lambda x: x))
    met = ranked.join(hubs.hint("merge"), ["i", "key"]).filter((F.col("node") == F.col("hub.node")) | (agree >= F.least(F.lit(AGREE), F.size("brief"))))
    near = F.least("n", "hub.n") >= least * F.greatest("n", "hub.n")
    met = stored(met.select("i", "key", "node", "n", "brief", F.col("hub.node").alias("hub"), near.alias("near")), "met")
    far = stored(met.filter("not near").select("i", "key").distinct(), "far-buckets")
    step = F.floor(F.log("n") / F.lit(-math.log(least))).cast("int")
    dealt = met.join(far.hint("merge"), ["i", "key"], "left_semi").select("i", "key", "node", "n", "brief", F.explode(F.array(step, step + 1)).alias("step"))
    dealt = stored(dealt, "dealt")
    heads = stored(dealt.groupBy("i", "key", "step").agg(F.min(F.struct("n", "node", "brief")).alias("hub")), "dealt-hubs")
    again = dealt.join(heads.hint("merge"), ["i", "key", "step"]).filter((F.col("node") != F.col("hub.node")) & (agree >= F.least(F.lit(AGREE), F.size("brief"))))
    pairs = met.filter("near and node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    return pairs.union(again.select("node", "hub.node")).distinct(), sizes, hubs


def _crowds(nodes: DataFrame, sizes: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(i, key, node, n): the members of the buckets of one sketch, ``i``, that have more
    members than a hub and one other."""
    many = sizes.filter((F.col("c") > 2) & (F.pmod(F.col("i") - 1, F.lit(depth)) == 0)).select(((F.col("i") - 1) / depth).cast("int").alias("i"), "key")
    cells = _cells(nodes.select("node", "n", "sketch"), 1).select((F.col("i") - 1).alias("i"), "key", "node", "n")
    return stored(cells.join(many.hint("merge"), ["i", "key"]), "crowds")


def _in_tiles(members: DataFrame) -> DataFrame:
    """``members`` of buckets (i, key), dealt into ``blocks``, once for each two blocks of
    which one is theirs; sorted by ``tile``."""
    block = F.pmod(F.xxhash64(F.lit("block"), "node"), F.col("blocks")).cast("int").alias("block")
    rows = members.select("*", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("cross", F.col("other") != F.col("block"))
    rows = rows.withColumn("tile", F.xxhash64("i", "key", F.least("block", "other"), F.greatest("block", "other")))
    return rows.drop("blocks", "other").repartition("tile").sortWithinPartitions("tile")


def _across(crowds: DataFrame, nodes: DataFrame, hubs: DataFrame, labels: DataFrame, sequences: DataFrame, least: float, depth: int = DEPTH) -> DataFrame:
    """Links (a, b) among the ``crowds`` between different classes by the links so far
    (``labels``): of any two texts of a bucket that are linked, both are of one class then.

    No pair of a bucket is left out: two members are told apart by their classes, lengths
    and sketches, and else by their k-mers.  A task holds two blocks of a bucket, and moves
    only k-mers of members that are in such a pair.
    """
    own = crowds.join(labels.hint("merge"), "node", "left").select("i", "key", "node", "n", F.xxhash64(F.coalesce("label", "node")).alias("label"))
    own = stored(own, "crowds-classes")
    mixed = own.groupBy("i", "key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("c"), F.sum("n").alias("n")).filter("low <> high")
    blocks = F.greatest(F.ceil(F.col("c") / MEMBERS), F.ceil(F.col("n") * 4 / HELD)).cast("int").alias("blocks")
    own = stored(own.join(mixed.select("i", "key", blocks).hint("merge"), ["i", "key"]), "crowds-open")
    ids = own.select("node").distinct()
    heads = hubs.filter(F.pmod(F.col("i") - 1, F.lit(depth)) == 0).groupBy(F.col("hub.node").alias("node")).agg(F.expr(f"sum(shiftleft(1, cast((i - 1) / {depth} as int)))").alias("hubs"))
    known = nodes.select("node", "sketch").join(ids.hint("merge"), "node", "left_semi").join(heads.hint("merge"), "node", "left")
    known = stored(known.select("node", "sketch", F.coalesce("hubs", F.lit(0).cast("long")).alias("hubs")), "crowds-known")
    full = stored(own.join(known.hint("merge"), "node"), "crowds-full")
    waiting = stored(_in_tiles(full).mapInArrow(_waiting(least), "i int, key long, node string").distinct(), "crowds-waiting")
    full = full.join(waiting.hint("merge"), ["i", "key", "node"], "left_semi").join(sequences.hint("merge"), "node")
    return stored(_in_tiles(full).mapInArrow(_linked(least), "a string, b string").distinct(), "crowds-linked")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) after further ``links`` (a, b), by the components of the labels."""
    of = lambda s: labels.select(F.col("node").alias(s), F.col("label").alias(f"l{s}")).hint("merge")
    named = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select("a", "b", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb"))
    named = stored(named, "links-named")
    merged = components(named.select(F.col("la").alias("a"), F.col("lb").alias("b"))).select(F.col("node").alias("label"), F.col("label").alias("new"))
    every = labels.union(named.select("a", "la")).union(named.select("b", "lb")).distinct()
    return stored(every.join(merged.hint("merge"), "label", "left").select("node", F.coalesce("new", "label").alias("label")), "labels")


def classes(rows: DataFrame, texts: DataFrame, least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """((node, label) of the nodes that have a duplicate of other words, (node, n_links) of
    the same nodes: verified links to others); ``rows`` are ``_describe``'s, stored, of
    ``texts`` (__t, __u, __text).

    Only the texts to align move: those that stand for a node of some pair.
    """
    nodes = rows.groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min(F.struct("__t", "__u")).alias("own"))
    nodes = stored(nodes, "nodes")
    pairs, sizes, hubs = candidates(nodes.select("node", "n", "sketch"), least)
    pairs, crowds = stored(pairs, "pairs"), _crowds(nodes, sizes)
    ids = pairs.select(F.explode(F.array("a", "b")).alias("node")).union(crowds.select("node")).distinct()
    ids = stored(nodes.select("node", "own.*").join(ids, "node", "left_semi"), "pair-nodes")
    wanted = texts.select("__t", "__u", "__text").join(ids.hint("merge"), ["__t", "__u"]).select("node", "__text")
    sequences = stored(wanted.mapInArrow(_sequences, "node string, kmers binary").groupBy("node").agg(F.first("kmers").alias("kmers")), "pair-kmers")
    side = lambda s: sequences.select(F.col("node").alias(s), F.col("kmers").alias(f"k{s}")).hint("merge")
    checked = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ka", "kb").mapInArrow(_verify(least), _CHECKED)
    links = stored(checked.filter("linked").select("a", "b"), "pairs-checked")
    labels = components(links)
    new = _across(crowds, nodes, hubs, labels, sequences, least)
    labels, links = _merged(labels, new), links.union(new)
    ends = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().select(F.explode(F.array("a", "b")).alias("node"))
    return labels, stored(ends.groupBy("node").agg(F.count(F.lit(1)).alias("n_links")), "node-links")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (the least doc_id of its class),
    class_size (the rows of the class), n_links (the other texts, of different words, that its
    text is linked to by an alignment; copies are no links), n_kmers, kept (of each class one document, that of
    the least doc_id, stays; its equal rows are marked alike), and the two hashes of the
    text that tell rows apart, ``__t`` and ``__u``.

    Texts of equal words (lower-cased, marks and spaces aside) are one node from the
    start, so that copies cost a row each and no pair.  A null text is empty; texts without
    words are of one class only if they are equal.  Nulls are the last choice for class_id.
    An empty table gives no rows; other columns are ignored.
    """
    bare = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    texts = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(bare).alias("__t"), F.xxhash64(F.lit("second"), bare).alias("__u"), bare.alias("__text"))
    schema = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, {_COLUMNS}"
    rows = stored(texts.mapInArrow(_describe, schema), "described")
    labels, linked = classes(rows, texts, least)
    labels = stored(labels.join(linked.hint("merge"), "node"), "labels-links")
    own = rows.select("doc_id", "__t", "__u", "node", "n").join(labels.hint("merge"), "node", "left").withColumn("class", F.coalesce("label", "node"))
    own = stored(own.drop("label", "node"), "classed")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__t", "__u")
    heads = stored(own.groupBy("class").agg(F.min(order).alias("head"), F.count(F.lit(1)).alias("class_size")), "class-heads")
    kept = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("__t") == F.col("head.__t")) & (F.col("__u") == F.col("head.__u"))
    return own.join(heads.hint("merge"), "class").select("doc_id", F.col("head.doc_id").alias("class_id"), "class_size", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.col("n").alias("n_kmers"), kept.alias("kept"), "__t", "__u")


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class (see ``near_duplicates``), all columns kept."""
    heads = near_duplicates(docs, doc_id, text, least).filter("kept")
    heads = stored(heads.select(F.col("doc_id").alias("__id"), "__t", "__u").distinct(), "kept")
    bare, key = F.coalesce(F.col(f"`{text}`"), F.lit("")), F.coalesce(F.col("__id").cast("string"), F.lit("")).alias("__key")
    heads = heads.select(F.col("__t").alias("__ht"), F.col("__u").alias("__hu"), key.alias("__hkey"), F.col("__id").isNull().alias("__hnull"))
    own = docs.select(whole(docs), F.xxhash64(bare).alias("__t"), F.xxhash64(F.lit("second"), bare).alias("__u"),
                      F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("__key"), F.col(f"`{doc_id}`").isNull().alias("__null"))
    same = (F.col("__t") == F.col("__ht")) & (F.col("__u") == F.col("__hu")) & (F.col("__key") == F.col("__hkey")) & (F.col("__null") == F.col("__hnull"))
    first = F.row_number().over(Window.partitionBy("__t", "__u", "__key", "__null").orderBy("__t"))
    return own.join(heads.hint("merge"), same, "left_semi").withColumn("__row", first).filter("__row = 1").select("row.*")
