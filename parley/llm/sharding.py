"""Contiguous minimax sharding of atomic groups (operator 9).  DataFrame expressions only.

Groups are equal texts, ordered by text hash.  The order is divided into atoms: first 2^16
hash ranges, each of whole groups.  The smallest shard capacity that the atoms' sizes allow
is found by binary search, each capacity checked greedily.  Atoms that a cut may fall into
are divided further, by 8 bits of the hash at a time, until those are single groups or
finer atoms cannot lower the capacity; it is then the smallest for the groups themselves.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import stored

#: The first atoms are told apart by so many leading bits of the hash, finer ones by so
#: many more each time.
BITS, STEP = 16, 8
#: Bytes that each document counts besides its text.
OVERHEAD = 16


def capacity(sizes: list[int], shards: int) -> int:
    """The smallest possible size of the largest of ``shards`` runs of consecutive sizes."""
    ends = list(accumulate(sizes, initial=0))

    def fits(c: int) -> bool:
        at = 0
        for _ in range(shards):
            at = bisect_right(ends, ends[at] + c, at) - 1
            if at == len(sizes):
                return True
        return False

    low, high = max([0, *sizes]), ends[-1]
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


def cut(sizes: list[int], shards: int) -> list[int]:
    """Where each shard starts.  No shard is over ``capacity``; below that, every shard
    takes what comes nearest to an equal part of what is left, as far as the rest still
    fits into the shards after it."""
    n, ends, most = len(sizes), list(accumulate(sizes, initial=0)), capacity(sizes, shards)
    need = [0] * (n + 1)  # shards that the sizes from i on need
    for i in range(n - 1, -1, -1):
        need[i] = 1 + need[bisect_right(ends, ends[i] + most, i) - 1]
    starts, at = [], 0
    for left in range(shards, 0, -1):
        starts.append(at)
        goal = ends[at] + (ends[n] - ends[at]) / left
        last = bisect_right(ends, ends[at] + most, at) - 1
        to = bisect_left(ends, goal, at, n + 1)
        if to > at and (to > n or ends[to] - goal > goal - ends[to - 1]):
            to -= 1
        to = min(to, last)
        while to < last and need[to] > left - 1:
            to += 1
        at = to
    return starts


@dataclass(frozen=True, order=True)
class Atom:
    """A range of 2^(64 - bits) hashes from ``first`` on; ``single``: it holds one group."""

    first: int
    bits: int
    size: int
    rows: int
    single: bool


def _fluid(atoms: list[Atom], shards: int) -> int:
    """A capacity below which the groups cannot fit: the smallest if an atom of several
    groups could be cut anywhere."""
    ends = list(accumulate((a.size for a in atoms), initial=0))

    def fits(c: int) -> bool:
        at = 0
        for _ in range(shards):
            at = _reach(atoms, ends, at, c)
            if at >= ends[-1]:
                return True
        return False

    low, high = max([0, *(a.size for a in atoms if a.single)]), ends[-1]
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


def _reach(atoms: list[Atom], ends: list[int], at: int, c: int) -> int:
    """The most bytes before a cut if the cut before it has ``at`` and a shard holds c."""
    i = bisect_right(ends, at + c) - 1  # the atom that byte at + c is in
    return at + c if i < len(atoms) and not atoms[i].single else ends[min(i, len(atoms))]


def _open(atoms: list[Atom], shards: int) -> list[Atom]:
    """The atoms of several groups that the smallest capacity may depend on; none if it is
    known.  Every cut lies between the greedy cut at the least possible capacity and atoms
    whole, and that at the greatest and atoms cut anywhere."""
    sizes = [a.size for a in atoms]
    least, most = _fluid(atoms, shards), capacity(sizes, shards)
    if least == most:
        return []
    ends = list(accumulate(sizes, initial=0))
    low = high = 0
    out: set[int] = set()
    for _ in range(shards):
        low = ends[bisect_right(ends, low + least) - 1]
        high = _reach(atoms, ends, high, most)
        first, last = bisect_right(ends, low) - 1, bisect_left(ends, high)
        out.update(i for i in range(max(0, first), min(last, len(atoms))) if not atoms[i].single)
    return [atoms[i] for i in sorted(out)]


def _atoms(rows: DataFrame, key: Column, bits: int) -> list[Atom]:
    """Atoms of rows (__u, an unsigned hash with its first bit turned, and size)."""
    sums = rows.groupBy(key.alias("k")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"), (F.min("__u") == F.max("__u")).alias("single"))
    return sorted(Atom((r["k"] << (64 - bits)) % (1 << 64), bits, r["size"], r["rows"], r["single"]) for r in sums.collect())


def refined(rows: DataFrame, shards: int) -> list[Atom]:
    """Atoms fine enough for the smallest capacity of the groups.  The driver sees 2^BITS
    sums at first, then at most 2^STEP for each atom that a cut may fall into, of which
    there are about shards^2 / 2 at most (capacities differ by one atom at most, so the
    k-th cuts by k of them)."""
    unsigned = F.col("__u").bitwiseXOR(F.lit(-(2**63)))
    prefix = lambda bits: F.shiftrightunsigned(unsigned, 64 - bits) if bits < 64 else unsigned
    atoms = _atoms(rows, prefix(BITS), BITS)
    while found := _open(atoms, shards):
        spark = rows.sparkSession
        for bits in sorted({a.bits for a in found}):
            own = [a for a in found if a.bits == bits]
            spots = spark.createDataFrame([(a.first >> (64 - bits),) for a in own], "__k long")  # under 64 bits: an atom of 64 is single
            held = rows.withColumn("__k", prefix(bits)).join(F.broadcast(spots), "__k", "left_semi")
            finer = min(64, bits + STEP)
            gone = set(own)
            atoms = [a for a in atoms if a not in gone] + _atoms(held, prefix(finer), finer)
        atoms.sort()
    return atoms


def shard_by_bytes(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size (UTF-8 bytes and ``OVERHEAD``), text_crc32,
    law ('bytes'), shard, slot (gapless from 0 in each shard) and grown_shard (null: a
    shard more would move rows anywhere).

    Equal texts are of one group and so of one shard; a null text has no bytes and goes
    with the empty texts.  Equal rows get slots of their own.  A group larger than an
    equal part makes its shard as large as it is.  An empty table gives no rows, and there
    may be empty shards if there are few groups.  Other columns are ignored.

    Rows are numbered per cell: the rows of a hash range in a shard, or for a range of many
    rows (a large group) a part of them by a stored salt.  There are about 5/4 * 2^16 cells
    at any size, so their bases are broadcast.
    """
    bare = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    h = F.xxhash64(bare)
    rows = stored(docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), (F.octet_length(bare) + F.lit(OVERHEAD)).cast("long").alias("size"), F.crc32(F.encode(bare, "UTF-8")).alias("text_crc32"),
        h.bitwiseXOR(F.lit(-(2**63))).alias("__u"), F.shiftrightunsigned(h, 64 - BITS).cast("int").alias("__range"), F.monotonically_increasing_id().alias("__salt")), "shard-rows")
    atoms = refined(rows, shards)
    starts = cut([a.size for a in atoms], shards)
    firsts = [atoms[s].first - (1 << 63) for s in starts[1:] if s < len(atoms)]  # as __u
    shard = F.size(F.filter(F.array(*[F.lit(x).cast("long") for x in firsts]), lambda x: x <= F.col("__u"))) if firsts else F.lit(0)
    rows = rows.withColumn("shard", shard.cast("int"))
    # salt only the ranges that hold several cells' rows
    cell = 4 * max(1, -(-sum(a.rows for a in atoms) // (1 << BITS)))
    wide = rows.groupBy("shard", "__range").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > cell).select("shard", "__range", F.ceil(F.col("rows") / cell).alias("__parts"))
    rows = rows.join(F.broadcast(wide), ["shard", "__range"], "left").withColumn("__cell", F.pmod(F.xxhash64("__salt"), F.coalesce("__parts", F.lit(1))))
    before = Window.partitionBy("shard").orderBy("__range", "__cell").rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.groupBy("shard", "__range", "__cell").agg(F.count(F.lit(1)).alias("__n"))
    bases = bases.select("shard", "__range", "__cell", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    place = F.row_number().over(Window.partitionBy("shard", "__range", "__cell").orderBy("__u", "doc_id", "__salt"))
    return rows.withColumn("__place", place).join(F.broadcast(bases), ["shard", "__range", "__cell"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("__base") + F.col("__place") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
