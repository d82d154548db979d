"""Byte-level BPE encoding and decoding by ranked merges (operator 4)."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import spread, text_blocks
from parley.llm.pieces import PieceEncoder

#: Words of more bytes are merged one at a time, so that no padded block grows with them.
LONG_WORD = 64
_NONE = np.int32(2**31 - 1)


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank map of a vocabulary file: a line holds base64 of the bytes, and the rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Ranks:
    """The rank map as arrays: pairs of ids that merge, and the bytes of each id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [((ranks[t[:i]] << 32) | ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        pairs.sort()
        self.pair = np.array([p for p, _ in pairs] + [2**62], np.int64)
        self.merged = np.array([r for _, r in pairs] + [_NONE], np.int32)
        size = max(ranks.values()) + 1
        pieces = [b""] * size
        for t, r in ranks.items():
            pieces[r] = t
        self.flat, self.length, self.start = _table(pieces)
        self.decimal = _table([b"%d " % i for i in range(size)])

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The id that a pair merges into, which is its rank; _NONE where there is none."""
        key = (a.astype(np.int64) << 32) | b
        at = np.searchsorted(self.pair, key)
        return np.where(self.pair[at] == key, self.merged[at], _NONE)

    def fold(self, words: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Merges the rows of ``words`` (ids, all of one length) until none has a mergeable
        pair; each step merges the leftmost pair of lowest rank of every unfinished row.
        Yields (row numbers, their final ids)."""
        rows, done = np.arange(len(words)), []
        rank = self.rank(words[:, :-1], words[:, 1:])
        while len(rows):
            n, width = words.shape
            best = rank.min(axis=1) if width > 1 else np.full(n, _NONE)
            active = best < _NONE
            if not active.all():
                done.append((rows[~active], words[~active]))
                rows, words, rank, best = rows[active], words[active], rank[active], best[active]
                n = len(rows)
            if not n:
                break
            at, every = rank.argmin(axis=1), np.arange(n)
            words = words.copy()
            words[every, at] = best
            keep = np.ones((n, width), bool)
            keep[every, at + 1] = False
            words = words[keep].reshape(n, width - 1)
            rank = rank[keep[:, 1:]].reshape(n, width - 2)
            if width > 2:
                left = at > 0
                r, c = every[left], at[left] - 1
                rank[r, c] = self.rank(words[r, c], words[r, c + 1])
                right = at < width - 2
                r, c = every[right], at[right]
                rank[r, c] = self.rank(words[r, c], words[r, c + 1])
        return done

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word (as little-endian unsigned 32-bit integers): its own rank if
        it has one, else what its bytes merge into."""
        out = [b""] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if (r := self.ranks.get(w)) is not None:
                out[i] = r.to_bytes(4, "little")
            elif len(w) > LONG_WORD:
                out[i] = self._long(w).tobytes()
            else:
                by_length.setdefault(len(w), []).append(i)
        for length, at in by_length.items():
            start = self.of_byte[np.frombuffer(b"".join(words[i] for i in at), np.uint8)].reshape(-1, length)
            for rows, ids in self.fold(start):
                raw, step = ids.astype("<u4").tobytes(), 4 * ids.shape[1]
                for k, r in enumerate(rows.tolist()):
                    out[at[r]] = raw[k * step : (k + 1) * step]
        return out

    def _long(self, word: bytes) -> np.ndarray:
        """The same merges for one long word, with a heap of pairs over a linked list."""
        import heapq

        ids = self.of_byte[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ends, live = list(range(1, n + 1)), [True] * n
        rank = lambda i, j: self.ranks.get(word[i : ends[j]])
        heap = [(r, i, i + 1, ends[i + 1]) for i in range(n - 1) if (r := rank(i, i + 1)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, j, end = heapq.heappop(heap)
            if not live[i] or j >= n or not live[j] or after[i] != j or ends[j] != end or self.ranks.get(word[i:end]) != r:
                continue
            ids[i], ends[i], live[j], after[i] = r, end, False, after[j]
            if after[j] < n:
                before[after[j]] = i
                if (x := rank(i, after[i])) is not None:
                    heapq.heappush(heap, (x, i, after[i], ends[after[i]]))
            if before[i] >= 0 and (x := rank(before[i], i)) is not None:
                heapq.heappush(heap, (x, before[i], i, ends[i]))
        return np.array([x for x, ok in zip(ids, live) if ok], "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """The pieces of the ids, concatenated."""
        return self.flat[spread(self.length[ids], self.start[ids])].tobytes()

    def decimals(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by one space."""
        flat, length, start = self.decimal
        return flat[spread(length[ids], start[ids])].tobytes()[:-1]


def _table(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all bytes, lengths, starts) of a list of byte strings."""
    length = np.array([len(p) for p in pieces], np.int64)
    return np.frombuffer(b"".join(pieces), np.uint8), length, np.cumsum(length) - length


def split_pattern(pattern: str) -> regex.Pattern:
    """The pattern with its white space spelt out, as the Unicode property has it."""
    space = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    pattern = pattern.replace(r"[^\s", rf"[^{space}").replace(r"\s", rf"[{space}]").replace(r"\S", rf"[^{space}]")
    return regex.compile(pattern)


class Encoder:
    """Texts to ids and back; kept per process, as building its arrays takes a moment."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = Ranks(ranks), split_pattern(pattern)
        self.pieces = PieceEncoder(self._encode)

    def _encode(self, pieces: list[bytes]) -> list[bytes]:
        split = [self.pattern.findall(p.decode("utf-8")) for p in pieces]
        words = list(dict.fromkeys(w for s in split for w in s))
        ids = dict(zip(words, self.ranks.encode([w.encode("utf-8") for w in words])))
        return [ids[s[0]] if len(s) == 1 else b"".join([ids[w] for w in s]) for s in split]


@lru_cache(maxsize=2)
def _encoder(key: str, shared) -> Encoder:
    ranks, pattern = shared.value
    return Encoder(ranks, pattern)


_OUT = "doc_id {id}, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256 (of the decimal ids joined
    by one space), decoded_sha256 (of the decoded bytes) and, ``with_ids``, ids.

    The rank map is read once on the driver and broadcast; its size is that of the
    vocabulary.  A null text is empty and has no ids; equal rows get equal results; an
    empty table gives none; other columns of ``docs`` are ignored.  No row is shuffled.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast((read_ranks(ranks_path), pattern))
    key = f"{ranks_path} {pattern}"
    schema = _OUT.format(id=rows.schema["doc_id"].dataType.simpleString()) + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(key, shared)
        ranks = encoder.ranks
        for batch in batches:
            for first, end, data, offsets in text_blocks(batch.column(1)):
                ids, at = encoder.pieces.block(data, offsets)
                texts = [ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                columns = [
                    batch.column(0).slice(first, end - first),
                    pa.array(np.diff(at)),
                    pa.array([hashlib.sha256(ranks.decimals(x)).hexdigest() for x in texts], pa.string()),
                    pa.array([hashlib.sha256(ranks.decode(x)).hexdigest() for x in texts], pa.string()),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, schema)
