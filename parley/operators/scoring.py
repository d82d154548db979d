"""Q4-Q6 inside a bucket: BM25 sums of a query batch, and the rows of its top k.

All turns of a batch against all documents are turns x documents sums, quadratic when both
grow.  A task holds the postings of one bucket that carry a term of the batch, and goes
through the turns one by one.  A turn's sums over all documents are first taken in small
whole numbers, rounded up, which bound the scores from both sides; frequent terms are added
as whole columns.  Scores proper are summed only for the documents that the bounds leave,
TILE of them at a time; of a turn a task passes on at most k rows.  For large batches each
bucket first passes on a few best (least possible) scores of every turn; the k-th best of
these is a score that k documents reach, so that nothing below it needs to be moved.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.operators.blocks import ddl

# sent along with the tasks, so that executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Documents left by the bounds that are held at once, and (document, term) shares of scores
#: added at once.
TILE = 1 << 20
#: Of a bucket's documents, the part from which a term counts as frequent, and the bytes
#: that the columns of such terms may take.
SHARE = 1 / 40
COLUMNS = 64 << 20
#: Bounds (of turns x documents) held at once, and shares of them added at once.
CELLS = 1 << 18
#: Rows that each bucket may pass on, and half of those of a turn, before a least score of each
#: turn is sought first: that reads all postings once more, some millions of a bucket.
FREE_ROWS = 1 << 19
UNITS = 10_000  # scores are whole numbers of 1 / UNITS (four digits)
SMALL = np.iinfo(np.uint16).max  # bounds of a turn whose terms may reach more are summed in 32 bits


class Batch:
    """The terms of a query batch: by turn its terms and their numbers, by term the weight,
    and the turns' keys."""

    def __init__(self, weights: pa.Table, keys: list[str], k1: float, b: float, avgdl: float):
        self.k1, self.b, self.avgdl = k1, b, avgdl
        turn = np.zeros(weights.num_rows, np.int64)
        for c in keys:
            codes = weights.column(c).combine_chunks().dictionary_encode(null_encoding="encode")
            turn = np.unique(turn * max(1, len(codes.dictionary)) + codes.indices.to_numpy(zero_copy_only=False), return_inverse=True)[1]
        coded = weights.column("term").combine_chunks().dictionary_encode()
        term, names = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
        self.names, self.terms = names, {t: i for i, t in enumerate(names.to_pylist())}
        order = np.lexsort((term, turn))
        turn, self.term = turn[order], term[order].astype(np.int32)
        self.qtf = weights.column("qtf").to_numpy()[order].astype(np.int32)
        self.turns = int(turn[-1]) + 1 if len(turn) else 0
        self.start = np.searchsorted(turn, np.arange(self.turns + 1))
        first = pa.array(order[self.start[:-1]])
        self.keys = [weights.column(c).combine_chunks().take(first) for c in keys]
        self.weight = np.zeros(len(names))
        self.weight[term] = weights.column("idf").to_numpy() * (k1 + 1.0)
        # most that a turn's terms can reach, and its number of terms: what rounding up adds at most
        self.most, self.slack = self.by_turn(self.weight[self.term] * self.qtf), self.by_turn(self.qtf)
        # small numbers to a point of score: few turns reach more than SMALL, no posting does
        usual = float(np.quantile(self.most, 0.95)) if self.turns else 1.0
        self.scale = (SMALL - 2) / max(usual + 1e-9, float(self.weight.max(initial=0.0)) + 1e-9)

    def by_turn(self, x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x, self.start[:-1]) if self.turns else x[:0]

    @classmethod
    def of(cls, state: dict) -> Batch:
        """A batch from its broadcast attributes (a broadcast instance would need this package)."""
        own = cls.__new__(cls)
        own.__dict__.update(state)
        return own


def spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers from each of ``first`` on, ``count`` of them, and of each its place in ``first``."""
    place = np.repeat(np.arange(len(first)), count)
    return np.arange(len(place)) + (first - (np.cumsum(count) - count))[place], place


class Bucket:
    """The postings of a batch's terms in a bucket: by term the places of its documents, whose
    ids are in order, and their shares of a score."""

    def __init__(self, batch: Batch, batches: Iterator[pa.RecordBatch]):
        """From rows (doc_id, term, tf, dl)."""
        self.batch = batch
        rows = list(batches)
        if not rows:
            self.ids, self.n = [], 0
            return
        rows = pa.Table.from_batches(rows)
        coded = rows.column(1).combine_chunks().dictionary_encode()
        known = np.array([batch.terms.get(t, -1) for t in coded.dictionary.to_pylist()], np.int64)
        term = known[coded.indices.to_numpy(zero_copy_only=False)]
        coded = rows.column(0).combine_chunks().dictionary_encode()
        names = coded.dictionary.to_pylist()
        order = sorted(range(len(names)), key=names.__getitem__)
        place = np.empty(len(names), np.int64)
        place[order] = np.arange(len(names))
        self.ids, self.n = [names[i] for i in order], len(names)
        doc = place[coded.indices.to_numpy(zero_copy_only=False)]
        tf, dl = (rows.column(i).to_numpy().astype(float) for i in (2, 3))
        keep = np.flatnonzero(term >= 0)
        by_term = keep[np.lexsort((doc[keep], term[keep]))]
        self.doc, self.term, tf, dl = doc[by_term], term[by_term], tf[by_term], dl[by_term]
        self.part = tf / (tf + batch.k1 * ((1.0 - batch.b) + batch.b * dl / batch.avgdl)) * batch.weight[self.term]
        # rounded up, so that a match is never 0
        self.small = np.maximum(1, np.ceil(self.part * batch.scale)).astype(np.uint16)
        self.start = np.searchsorted(self.term, np.arange(len(batch.terms) + 1))
        self.df = np.diff(self.start)
        self.wide = -(-self.n // 8) * 8
        often = np.argsort(-self.df, kind="stable")[: max(1, COLUMNS // (2 * self.wide))]
        often = often[self.df[often] >= max(1.0, self.n * SHARE)]
        self.column = np.full(len(self.df), -1)
        self.column[often] = np.arange(len(often))
        self.columns = [np.zeros(self.wide, np.uint16) for _ in often]
        for t, column in zip(often.tolist(), self.columns):
            at = slice(self.start[t], self.start[t + 1])
            column[self.doc[at]] = self.small[at]

    def bounds(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(turns, sums of these x documents) for all turns: the sums are at most ``slack``
        small numbers above the scores, and not below them; 0 where nothing matches, and in
        the places beyond the documents that fill up a row."""
        own = self.batch
        reach, low = own.most * own.scale + own.slack, -1.0
        for kind in (np.uint16, np.uint32, np.uint64):
            high = float(np.iinfo(kind).max)
            turns, low = np.flatnonzero((reach >= low) & (reach < high)), high
            step = max(1, CELLS // self.wide)
            for some in (turns[i : i + step] for i in range(0, len(turns), step)):
                where, row = spread(own.start[some], own.start[some + 1] - own.start[some])
                term, times = own.term[where], own.qtf[where]
                sums = np.zeros((len(some), self.wide), kind)
                flat, column = sums.reshape(-1), self.column[term]
                rare = np.flatnonzero((column < 0) & (self.df[term] > 0))
                ends, i = np.cumsum(self.df[term[rare]]), 0
                while i < len(rare):  # pairs of about CELLS postings, or one pair
                    j = max(i + 1, int(np.searchsorted(ends, (int(ends[i - 1]) if i else 0) + CELLS, side="right")))
                    at, pair = spread(self.start[term[rare[i:j]]], self.df[term[rare[i:j]]])
                    share = self.small[at].astype(kind, copy=False)
                    if times[rare[i:j]].max() > 1:
                        share = share * times[rare[i:j]].astype(kind)[pair]
                    np.add.at(flat, self.doc[at] + (row[rare[i:j]] * self.wide)[pair], share)
                    i = j
                rows, add, columns, often = list(sums), np.add, self.columns, np.flatnonzero(column >= 0)
                for r, c, f in zip(row[often].tolist(), column[often].tolist(), times[often].tolist()):
                    add(rows[r], columns[c] if f == 1 else columns[c].astype(kind) * kind(f), rows[r])
                yield some, sums

    def scores(self, turn: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The scores of (turn, document) pairs: of each document its terms are laid out, and
        the turns' terms looked up there."""
        own = self.batch
        if not hasattr(self, "by_doc"):
            self.by_doc = np.argsort(self.doc, kind="stable")
            self.ends = np.searchsorted(self.doc[self.by_doc], np.arange(self.n + 1))
        out, share = np.zeros(len(turn)), np.zeros(len(own.terms))
        order = np.argsort(doc, kind="stable")
        ends = np.flatnonzero(np.diff(doc[order], append=-1)) + 1
        begin = 0
        for end in ends.tolist():
            at = self.by_doc[self.ends[doc[order[begin]]] : self.ends[doc[order[begin]] + 1]]
            share[self.term[at]] = self.part[at]
            while begin < end:  # pairs of about TILE terms, or one pair
                some = order[begin:end]
                first = own.start[turn[some]]
                count = own.start[turn[some] + 1] - first
                total = np.cumsum(count)
                j = max(1, int(np.searchsorted(total, TILE, side="right")))
                some, first, count, total = some[:j], first[:j], count[:j], total[:j]
                where, _ = spread(first, count)
                out[some] = np.add.reduceat(share[own.term[where]] * own.qtf[where], total - count)
                begin += j
            share[self.term[at]] = 0.0
        return out


def units(sums: np.ndarray) -> np.ndarray:
    """Sums in whole numbers of 1 / UNITS, rounded half up; -1 where nothing matched."""
    return np.where(sums > 0, np.floor(sums * UNITS + 0.5), -1).astype(np.int64)


def at_least(own: Batch, turns, sums: np.ndarray) -> np.ndarray:
    """The scores in units that are certain of ``turns`` by their bounds."""
    least = np.maximum(0.0, sums.astype(float) - own.slack[turns] - 1) / own.scale
    return np.floor(least * UNITS * (1 - 1e-12) + 0.5).astype(np.int64)


def small_enough(own: Batch, floor: np.ndarray) -> np.ndarray:
    """The small numbers that a score of ``floor`` units comes to at least; 1 is any match."""
    return np.maximum(1, ((floor - 0.5) / UNITS * own.scale * (1 - 1e-9)).astype(np.int64) - 1)


def best_scores(postings: DataFrame, batch, m: int) -> DataFrame:
    """(turn, scores): of each bucket and turn the ``m`` best scores, as far as they are certain."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = Bucket(own := Batch.of(batch.value), batches)
        for turns, sums in bucket.bounds() if bucket.n else ():
            # the best of each of some groups of documents, where these are far more than m
            best = sums
            while best.shape[1] >= 16 * m and best.shape[1] % 2 == 0:
                half = best.shape[1] // 2
                best = np.maximum(best[:, :half], best[:, half:])
            if best.shape[1] > m:
                best = np.partition(best, best.shape[1] - m, axis=1)[:, -m:]
            some = best > 0
            scores = at_least(own, turns[:, None], best)[some]
            ends = np.cumsum([0, *some.sum(axis=1)])
            yield pa.RecordBatch.from_arrays([pa.array(turns, pa.int32()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(scores))], names=["turn", "scores"])

    return postings.select("doc_id", "term", "tf", "dl").mapInArrow(run, "turn int, scores array<bigint>")


def best_rows(postings: DataFrame, batch, weights: DataFrame, keys: list[str], k: int, least=None) -> DataFrame:
    """(*keys, doc_id, score): of each bucket and turn the ``k`` best rows, by score and then
    ``doc_id``, without those below the turn's ``least`` score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = Bucket(own := Batch.of(batch.value), batches)
        names = pa.array(bucket.ids, pa.string())
        floors = np.zeros(own.turns, np.int64) if least is None else np.maximum(0, least.value)

        def out() -> pa.RecordBatch:
            turn, doc = (np.concatenate(x) for x in zip(*left))
            score = units(bucket.scores(turn, doc))
            keep = np.flatnonzero(score >= floors[turn])
            turn, doc, score = turn[keep], doc[keep], score[keep]
            order = np.lexsort((doc, -score, turn))
            turn, doc, score = turn[order], doc[order], score[order]
            first = np.arange(len(turn)) - np.searchsorted(turn, turn) < k
            turn, doc, score = pa.array(turn[first]), pa.array(doc[first]), pa.array(score[first] / UNITS)
            return pa.RecordBatch.from_arrays([*[c.take(turn) for c in own.keys], names.take(doc), score], names=[*keys, "doc_id", "score"])

        left, held = [], 0
        for turns, sums in bucket.bounds() if bucket.n else ():
            top = np.iinfo(sums.dtype).max
            enough = sums >= np.minimum(small_enough(own, floors[turns]), top).astype(sums.dtype)[:, None]
            # eight places at a time, of which most are empty
            place = np.flatnonzero(enough.reshape(-1).view(np.uint64))
            place = (place[:, None] * 8 + np.arange(8)).reshape(-1)
            place = place[enough.reshape(-1)[place]]
            row, doc, found = place // bucket.wide, place % bucket.wide, sums.reshape(-1)[place]
            ends = np.searchsorted(row, np.arange(len(turns) + 1))
            many, keep = np.flatnonzero(np.diff(ends) > k), None
            for i in many.tolist():  # k documents of the bucket reach a score
                some = found[ends[i] : ends[i + 1]]
                floor = at_least(own, turns[i], np.partition(some, len(some) - k)[len(some) - k])
                floors[turns[i]] = max(floors[turns[i]], int(floor))
                keep = np.ones(len(row), bool) if keep is None else keep
                keep[ends[i] : ends[i + 1]] = some >= small_enough(own, floors[turns[i]])
            row, doc = (row, doc) if keep is None else (row[keep], doc[keep])
            left.append((turns[row], doc))
            held += len(row)
            if held >= TILE:
                yield out()
                left, held = [], 0
        if held:
            yield out()

    schema = ", ".join([*ddl(weights, *keys), *ddl(postings, "doc_id"), "score double"])
    return postings.select("doc_id", "term", "tf", "dl").mapInArrow(run, schema)


def in_buckets(postings: DataFrame) -> bool:
    """Whether all postings of a document are in one partition, as stored; also where a join
    with a table of the same buckets leaves some out, which Spark may still replan."""
    plan = postings._jdf.queryExecution().executedPlan()
    plan = plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    return "hashpartitioning(doc_id" in plan.outputPartitioning().toString() and "Exchange hashpartitioning" not in plan.toString()


def scored_buckets(tables: list[DataFrame], weights: DataFrame, keys: list[str], k: int, avgdl: float, k1: float, b: float) -> DataFrame:
    """Q4 + Q5 of a (size-checked) batch of query weights over bucketed postings: rows that
    hold the top ``k`` of every turn, few more than these."""
    sc = weights.sparkSession.sparkContext
    own = Batch(weights.select(*keys, "term", "qtf", "idf").toArrow(), keys, k1, b, float(avgdl))
    batch = sc.broadcast(vars(own))
    terms = F.broadcast(weights.sparkSession.createDataFrame(pa.table({"term": own.names.cast(pa.string())})))
    postings = None
    for t in tables:  # only postings of the batch's terms reach Python; no document changes its bucket
        found = t.select("doc_id", "term", "tf", "dl").join(terms, "term", "left_semi")
        postings = found if postings is None else postings.union(found)
    parts, least = sum(t.rdd.getNumPartitions() for t in tables), None
    if parts > 1 and max(own.turns, parts // 2) * k > FREE_ROWS:
        some = best_scores(postings, batch, min(k, 2 * -(-k // parts)))
        each = some.groupBy("turn").agg(F.try_element_at(F.sort_array(F.flatten(F.collect_list("scores")), False), F.lit(k)).alias("least"))
        found = each.where("least is not null").toArrow()
        bounds = np.zeros(own.turns, np.int64)
        bounds[found.column("turn").to_numpy()] = found.column("least").to_numpy()
        least = sc.broadcast(bounds)
    return best_rows(postings, batch, weights, keys, k, least)
