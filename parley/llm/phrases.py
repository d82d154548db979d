"""Phrase collocation mining by top-order marginalisation (operator 11).

Every word opens a window: itself and the words that lead it, up to LONGEST, padded at the
end of its piece.  Only these longest windows are counted; ROLLUP over their columns sums
the counts of successively shorter prefixes, which are the counts of all shorter phrases.

A word or pair of words that stands less than LEAST times is in no candidate, nor in a part
of one, so windows are also padded there.  What is rare is told by counters of hashed words
and pairs (2^BITS of them, whatever the input): a counter is never less than any count it
holds, so no window of a candidate is cut.  Longer phrases whose words and pairs all passed
are counted in the same way, and windows padded from the first length on that stands less
than LEAST times: what moves are phrases of candidates' counts, not all the windows of
frequent words.  The fuller the counters, the fewer windows they shorten; the result is the
same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import blocks, spread, stored, utf8
from parley.llm.words import LOWER, mix, span_hashes
from parley.session import apply_plan_settings

#: Words of the longest phrase, the least count of a candidate, rows returned per language.
LONGEST, LEAST, TOP = 5, 100, 2000
#: 2^BITS counters, of which a bit each is sent to the tasks (32 MB).  They tell rare pairs
#: while there are less than some 50 words to a counter, up to 10^10 words.
BITS = 28
#: Text bytes handled at once, within a text too, and counters and windows that a task holds.
BLOCK, HELD, KEPT = 2 << 20, 4 << 20, 1 << 19
#: Words that a task looks for windows in, on average, where there are more tasks than cores
#: (some 20 s).
TASK_WORDS = 1 << 26

#: Counters travel in parts of 2^20, each of 16 runs of 2^16.
_PART, _RUN = 1 << 20, 1 << 16
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORD = ~_BREAK
_WORD[[0x20, 0x09]] = False
_ODD = np.uint64(0xD6E8FEB86659FD93)


def _cuts(data: np.ndarray, limit: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, end of the words that windows at its end lead to) of pieces of a text of
    about ``limit`` bytes, cut before a blank or break."""
    def boundary(at: int, words: int) -> int:
        """The end of that many more words after ``at``, or of the word at ``at`` if none."""
        while at < len(data):
            chunk = _WORD[data[at : at + 65536]]
            ends = np.flatnonzero(chunk[:-1] & ~chunk[1:]) + 1 if words else np.flatnonzero(~chunk)
            if len(ends) >= max(words, 1):
                return at + int(ends[max(words, 1) - 1])
            if words and len(ends):
                at, words = at + int(ends[-1]), words - len(ends)
            else:
                at += max(len(chunk) - 1, 1) if words else len(chunk)
        return len(data)

    at = 0
    while at < len(data):
        end = boundary(min(at + limit, len(data)), 0)
        yield at, end, boundary(end, LONGEST - 1)
        at = end


class Block:
    """The words of a block of texts: byte spans, hashes with their language, how many of
    the words that follow are of the same piece of text, and which words it counts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, seeds: np.ndarray, own: int):
        self.data = LOWER[data]
        inside = _WORD[self.data]
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        full = np.diff(offsets) > 0
        before[offsets[:-1][full]] = False
        after[offsets[1:][full] - 1] = False
        self.starts, self.ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        self.text = np.searchsorted(offsets, self.starts, side="right") - 1
        piece = np.searchsorted(np.flatnonzero(_BREAK[self.data]), self.starts)
        self.joined = np.zeros(len(self.starts), bool)  # with the next word
        self.joined[:-1] = (piece[1:] == piece[:-1]) & (self.text[1:] == self.text[:-1])
        self.hashes = mix(span_hashes(self.data, self.starts, self.ends) ^ seeds[self.text])
        self.own = self.starts < own

    def pairs(self) -> np.ndarray:
        h = np.zeros(len(self.hashes), np.uint64)
        h[:-1] = mix(self.hashes[:-1] * _ODD + self.hashes[1:])
        return h


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[Block, list[str]]]:
    """Blocks of the rows (lang, text), and the language of each of their texts."""
    langs = batch.column(0).to_pylist()
    seed = {x: xxhash.xxh64_intdigest(x.encode()) for x in set(langs)}
    data, offsets = utf8(batch.column(1))
    for i, j in blocks(offsets, BLOCK):
        seeds = np.array([seed[x] for x in langs[i:j]], np.uint64)
        own = data[offsets[i] : offsets[j]]
        if len(own) <= 2 * BLOCK:
            yield Block(own, offsets[i : j + 1] - offsets[i], seeds, len(own)), langs[i:j]
        else:  # one long text
            for a, b, c in _cuts(own, BLOCK):
                yield Block(own[a:c], np.array([0, c - a]), seeds, b - a), langs[i:j]


def _slots(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.uint32)


def _summed(slots: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct slots in order, and the sums of their counts."""
    order = np.argsort(slots, kind="stable")
    slots, counts = slots[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], slots[1:] != slots[:-1]))) if len(slots) else order
    return slots[first], np.add.reduceat(counts, first) if len(slots) else counts


def _parts(slots: np.ndarray, counts: np.ndarray, kind: str) -> Iterator[tuple]:
    """Rows (part, low halves of the slots, slots in each run, counts) of ascending slots."""
    cuts = np.searchsorted(slots, np.arange(0, int(slots[-1]) + _RUN + 1, _RUN)) if len(slots) else np.zeros(1, np.int64)
    sizes = np.diff(cuts)
    for i in range(0, len(sizes), _PART // _RUN):
        a, own = cuts[i], sizes[i : i + _PART // _RUN]
        if own.sum():
            b = a + own.sum()
            yield i * _RUN // _PART, (slots[a:b] & np.uint32(_RUN - 1)).astype("<u2").tobytes(), own.astype("<u4").tobytes(), counts[a:b].astype(kind).tobytes(), None, None


_COUNTED = "part int, low binary, sizes binary, counts binary, lang string, n long"


def _kind(least: int) -> str:
    """A number that holds a count up to ``least``, beyond which it need not be told."""
    return "<u1" if least < 256 else "<u4"


def _chains(block: Block, kept: np.ndarray, bits: int) -> tuple[np.ndarray, Iterator[tuple[int, np.ndarray, np.ndarray]]]:
    """Which words are among the ``kept``, and for each number of leads, 1 to LONGEST - 1, a
    hash of every word with so many leads, and where all its words and pairs are kept."""
    word = _among(kept, block.hashes, bits)
    chain = block.joined & word & _among(kept, block.pairs(), bits)
    chain[:-1] &= word[1:]

    def leads() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        run_on, key = word.copy(), block.hashes
        for k in range(1, LONGEST):
            end = max(0, len(chain) - k + 1)
            run_on[:end] &= chain[k - 1 :]
            run_on[end:] = False
            nxt = np.zeros(len(key), np.uint64)
            nxt[: max(0, len(key) - k)] = block.hashes[k:]
            key = mix(key * _ODD + nxt)
            yield k, key, run_on

    return word, leads()


def _count(least: int, bits: int, packed=None):
    """Counters of words and pairs, or of the longer phrases of the words and pairs that are
    among the ``packed``."""
    kind, most = _kind(least), least if least < 256 else 2**32 - 1

    def rows(out: list[tuple]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.string(), pa.int64())
        for i in range(0, len(out), 64):
            cols = list(zip(*out[i : i + 64]))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["part", "low", "sizes", "counts", "lang", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counters of this task, and with those of words its number of words per language."""
        kept = None if packed is None else np.frombuffer(packed.value, np.uint8)
        held, size, words = [(np.zeros(0, np.uint32), np.zeros(0, np.int64))], 0, {}
        for batch in batches:
            for block, langs in _blocks(batch):
                own = block.own
                if kept is None:
                    slots = np.concatenate((_slots(block.hashes[own], bits), _slots(block.pairs()[own & block.joined], bits)))
                else:
                    slots = np.concatenate([_slots(key[own & there], bits) for k, key, there in _chains(block, kept, bits)[1] if k > 1])
                held.append(_summed(slots, np.ones(len(slots), np.int64)))
                size += len(held[-1][0])
                for text, n in zip(*(x.tolist() for x in np.unique(block.text[own], return_counts=True))) if kept is None else ():
                    words[langs[text]] = words.get(langs[text], 0) + n
                if size > HELD:
                    held = [_summed(*(np.concatenate(x) for x in zip(*held)))]
                    size = len(held[0][0])
                    if size > HELD // 2:
                        yield from rows(list(_parts(held[0][0], np.minimum(held[0][1], most), kind)))
                        held, size = [(np.zeros(0, np.uint32), np.zeros(0, np.int64))], 0
        slots, counts = _summed(*(np.concatenate(x) for x in zip(*held)))
        yield from rows([*_parts(slots, np.minimum(counts, most), kind), *[(None, None, None, None, lang, n) for lang, n in words.items()]])

    return run


def _often(least: int, bits: int):
    kind, width = _kind(least), min(_PART, 1 << bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of all tasks' counters, sorted by part: a bit for each that is ``least`` or more.
        One part is held at a time, however many a task gets."""
        part, own = None, np.zeros(width, np.int32)

        def found() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(own >= least).tobytes()], pa.binary())], names=["part", "bits"])

        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(i)[at].as_py() for i, c in enumerate(("part", "low", "sizes", "counts"))}
                if row["part"] != part:
                    if part is not None:
                        yield found()
                    part = row["part"]
                    own[:] = 0
                sizes = np.frombuffer(row["sizes"], "<u4")
                slots = np.frombuffer(row["low"], "<u2") + np.repeat(np.arange(len(sizes)) * _RUN, sizes)
                own[slots] = np.minimum(own[slots] + np.frombuffer(row["counts"], kind).astype(np.int64), least)
        if part is not None:
            yield found()

    return run


def often(counted: DataFrame, least: int = LEAST, bits: int = BITS) -> bytes:
    """A bit for each of the 2^``bits`` counters: whether it is ``least`` or more."""
    width = min(_PART, 1 << bits) // 8
    out = bytearray((1 << bits) // 8)
    found = counted.filter("part is not null").select("part", "low", "sizes", "counts").repartition("part").sortWithinPartitions("part").mapInArrow(_often(least, bits), "part int, bits binary")
    for r in stored(found, "phrase-often").toLocalIterator():  # at most 2^(bits - 20) rows of 128 KB
        out[r["part"] * width : (r["part"] + 1) * width] = r["bits"]
    return bytes(out)


def _among(packed: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    slot = _slots(h, bits)
    return (packed[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1).astype(bool)


def _strings(block: Block, words: np.ndarray, there: np.ndarray) -> pa.Array:
    """The words of those numbers as strings, empty where not ``there``."""
    starts = np.where(there, block.starts[np.where(there, words, 0)], 0)
    sizes = np.where(there, block.ends[np.where(there, words, 0)] - starts, 0)
    data = block.data[spread(sizes, starts)]
    at = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data))).cast(pa.string())


WINDOW = [f"w{i}" for i in range(1, LONGEST + 1)]


def _windows(bits: int, packed):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(lang, w1 .. w5, n): the distinct longest windows of a task and their counts; of
        more than KEPT, those so far are given out and counted anew."""
        kept = np.frombuffer(packed.value, np.uint8)

        def empty() -> tuple:
            # hashes in order, the number of each one's row, rows made, and their counts
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), [], np.zeros(0, np.int64)

        def rows() -> Iterator[pa.RecordBatch]:
            done = 0
            for cols in made:
                n = counts[done : done + len(cols[0])]
                done += len(cols[0])
                yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64())], names=["lang", *WINDOW, "n"])

        known, place, made, counts = empty()
        for batch in batches:
            for block, langs in _blocks(batch):
                if not len(block.starts):
                    continue
                word, leads = _chains(block, kept, bits)
                size, run_on, key = word.astype(np.int64), word.copy(), block.hashes
                for k, phrase, there in leads:  # words of the window, and a hash of them
                    run_on &= there
                    if k > 1:
                        run_on &= _among(kept, phrase, bits)
                    size += run_on
                    key = np.where(run_on, phrase, key)
                at = np.flatnonzero(block.own & word)
                if not len(at):
                    continue
                own, first, n = np.unique(mix(key[at] ^ size[at].astype(np.uint64)), return_index=True, return_counts=True)
                where = np.searchsorted(known, own)
                again = np.zeros(len(own), bool)
                inside = where < len(known)
                again[inside] = known[where[inside]] == own[inside]
                counts[place[where[again]]] += n[again]
                new = ~again
                if not new.any():
                    continue
                at = at[first[new]]
                place = np.insert(place, where[new], len(counts) + np.arange(len(at)))
                known, counts = np.insert(known, where[new], own[new]), np.concatenate((counts, n[new]))
                lang = pa.array([langs[t] for t in block.text[at].tolist()], pa.string())
                made.append([lang, *[_strings(block, at + k, size[at] > k) for k in range(LONGEST)]])
                if len(known) > KEPT:
                    yield from rows()
                    known, place, made, counts = empty()
        yield from rows()

    return run


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, k, f) of all phrases of up to LONGEST words that stand at least
    ``least`` times, (lang, n) of all languages' words), both stored.

    A null text is empty, a null language ``und``.
    """
    spark = docs.sparkSession
    own = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    counted = stored(own.mapInArrow(_count(least, bits), _COUNTED), "phrase-counters")
    totals = stored(counted.filter("lang is not null").groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    some = often(counted, least, bits)
    packed = spark.sparkContext.broadcast(some)  # 2^bits bits
    longer = stored(own.mapInArrow(_count(least, bits, packed), _COUNTED), "phrase-longer")
    packed.unpersist()
    some = np.frombuffer(some, np.uint8) | np.frombuffer(often(longer, least, bits), np.uint8)
    packed = spark.sparkContext.broadcast(some.tobytes())
    # a task gives each of its windows once: a task for each core, so that frequent windows
    # are not given anew by ever more tasks of a larger input; more where they would grow long
    words = totals.agg(F.sum("n")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-words // TASK_WORDS))
    found = own.coalesce(tasks).mapInArrow(_windows(bits, packed), ", ".join(["lang string", *[f"{w} string" for w in WINDOW], "n long"]))
    longest = stored(found.groupBy("lang", *WINDOW).agg(F.sum("n").alias("n")), "phrase-windows")
    # level: how many of the columns are summed away; a prefix that ends in padding is a
    # shorter phrase, which the level of its own length counts
    level = F.grouping_id("lang", *WINDOW)
    sums = longest.rollup("lang", *WINDOW).agg(F.sum("n").alias("f"), level.alias("level"))
    k = F.lit(LONGEST) - F.bit_count("level")
    last = F.get(F.array(*[F.col(w) for w in WINDOW]), F.col("k") - 1)
    sums = sums.filter(F.col("f") >= least).withColumn("k", k).filter("k >= 1").filter(last != "")
    phrase = F.array_join(F.slice(F.array(*[F.col(w) for w in WINDOW]), 1, F.col("k")), " ")
    return stored(sums.select("lang", phrase.alias("phrase"), "k", "f"), "phrase-counts"), totals


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, bits: int = BITS) -> DataFrame:
    """The first ``top`` phrases of 2 to LONGEST words of each language: lang, rank, phrase,
    a (its count), l and r (the counts of the two parts of its lowest-scoring cut), n (the
    language's words) and score = floor(1000 a n / (l r)).

    A phrase that is part of a longer candidate of the same count is dropped.  Scores are
    exact (decimals of up to 38 digits: counts below 10^15, words below 10^17).  Ties: the
    shorter first part; then the greater count and the lesser phrase in UTF-8 bytes.  Null
    texts are empty, null languages ``und``; equal rows count each; an empty table gives no
    rows; other columns are ignored.
    """
    apply_plan_settings(docs.sparkSession)  # the partial limit of a window goes up to 10,000 rows
    counts, totals = phrase_counts(docs, text, lang, least, bits)
    words = F.split("phrase", " ")
    many = counts.filter("k > 1").withColumn("words", words)
    # longer candidates' parts, with the greatest count of a longer one
    size = F.size("words")
    spans = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: F.array_join(F.slice("words", i, m), " "))))
    inner = many.filter("k > 2").select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), F.col("f").alias("longer"))
    covered = stored(inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer")), "phrase-covered")
    left = many.join(covered.hint("merge"), ["lang", "phrase"], "left").filter("longer is null or 100 * longer < 100 * f")
    left = stored(left.select("lang", "phrase", F.col("f").alias("a"), "words"), "phrase-left")
    cut = F.explode(F.sequence(F.lit(1), size - 1)).alias("cut")
    sides = left.select("lang", "phrase", "a", "words", cut).select(
        "lang", "phrase", "a", "cut", F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("cut") + 1, size - F.col("cut")), " ").alias("rest"))
    side = lambda s, f: counts.select("lang", F.col("phrase").alias(s), F.col("f").alias(f)).hint("merge")
    half = stored(sides.join(side("first", "l"), ["lang", "first"]).drop("first"), "phrase-first")
    both = stored(half.join(side("rest", "r"), ["lang", "rest"]).drop("rest"), "phrase-both").join(totals.hint("merge"), "lang")
    big = lambda c, p=15: F.col(c).cast(f"decimal({p},0)")
    both = both.withColumn("up", big("a") * big("n", 17) * F.lit(1000).cast("decimal(4,0)")).withColumn("down", big("l") * big("r"))
    both = both.withColumn("score", F.expr("up div down").cast("long"))
    best = both.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long").alias("rank")
    out = best.select("lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score"))
    return out.select("lang", rank, "phrase", "a", "l", "r", "n", "score").filter(F.col("rank") <= top)
