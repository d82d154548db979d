"""Blocks of texts, analysed at once inside a task as Arrow arrays.

Spark deals the documents out; a block holds some consecutive texts of a task, at most
BLOCK_BYTES of them or one longer text.  Its tokens are numbers into the block's distinct
terms, so that counting a document's terms needs no row per token, no hash table or sort
over a whole bucket, and nothing that could spill: memory is that of a block at every size.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame

# sent along with the tasks, so that executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Text bytes handled at once; a longer text is a block of its own.
BLOCK_BYTES = 2 << 20

#: T1 on bytes: ASCII letters and digits in lower case, a space for everything else.
_NORMAL = np.full(256, ord(" "), np.uint8)
for _c in b"0123456789abcdefghijklmnopqrstuvwxyz":
    _NORMAL[_c] = _c
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _NORMAL[_c] = _c + 32


class Tokens:
    """The tokens of a block: ``terms`` (its distinct ones, Python strings), ``codes`` (the
    place in ``terms`` of each token) and ``owner`` (the text of each token)."""

    def __init__(self, terms: list[str], codes: np.ndarray, owner: np.ndarray, texts: int):
        self.terms, self.codes, self.owner, self.texts = terms, codes, owner, texts

    @classmethod
    def split(cls, column: pa.Array, raw: bool = False) -> Tokens:
        """Split at spaces, no empty tokens; a ``raw`` text is normalised (T1) first."""
        column = pc.fill_null(column.cast(pa.string()), "")
        if raw and len(column):
            _, offsets, data = column.buffers()
            plain = _NORMAL[np.frombuffer(data, np.uint8)] if data is not None else np.zeros(0, np.uint8)
            column = pa.StringArray.from_buffers(len(column), offsets, pa.py_buffer(plain), offset=column.offset)
        lists = pc.split_pattern(column, " ")
        flat, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
        some = pc.not_equal(flat, "")
        coded = flat.filter(some).dictionary_encode()
        owner = owner.filter(some).to_numpy(zero_copy_only=False).astype(np.int64)
        return cls(coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), owner, len(column))

    def without(self, stop: frozenset[str]) -> Tokens:
        return self._where([t not in stop for t in self.terms])

    def only(self, terms: frozenset[str]) -> Tokens:
        return self._where([t in terms for t in self.terms])

    def _where(self, kept: list[bool]) -> Tokens:
        keep = np.array(kept, bool)[self.codes] if len(self.terms) else np.zeros(0, bool)
        return Tokens(self.terms, self.codes[keep], self.owner[keep], self.texts)

    def conflated(self, stems: dict[str, str]) -> Tokens:
        """Each term replaced by its stem (T4); terms of one stem become one."""
        places: dict[str, int] = {}
        to = np.array([places.setdefault(stems.get(t, t), len(places)) for t in self.terms], np.int64)
        return Tokens(list(places), to[self.codes] if len(to) else self.codes, self.owner, self.texts)

    def distinct(self) -> Tokens:
        """The first of equal tokens of each text, in order."""
        _, first = np.unique(self.owner * max(1, len(self.terms)) + self.codes, return_index=True)
        first.sort()
        return Tokens(self.terms, self.codes[first], self.owner[first], self.texts)

    def starts(self) -> np.ndarray:
        """The place of each text's first token, and the end."""
        return np.searchsorted(self.owner, np.arange(self.texts + 1))

    def ranks(self) -> np.ndarray:
        """The place of each of ``terms`` among them in their order."""
        out = np.empty(len(self.terms), np.int64)
        out[sorted(range(len(self.terms)), key=self.terms.__getitem__)] = np.arange(len(self.terms))
        return out

    def joined(self) -> pa.Array:
        """The texts again, their tokens joined by a space."""
        flat = pa.array(self.terms, pa.string()).take(pa.array(self.codes))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(self.starts(), pa.int32()), flat), " ")

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, code, number, first place in the text) of each distinct term of each text."""
        n = max(1, len(self.terms))
        keys, first, number = np.unique(self.owner * n + self.codes, return_index=True, return_counts=True)
        text = keys // n
        return text, keys % n, number, first - self.starts()[text]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, code, code of the next token, first place) of each distinct pair of each text."""
        n = max(1, len(self.terms))
        at = np.flatnonzero(self.owner[:-1] == self.owner[1:])
        keys, first = np.unique((self.owner[at] * n + self.codes[at]) * n + self.codes[at + 1], return_index=True)
        text = keys // (n * n)
        return text, keys // n % n, keys % n, at[first] - self.starts()[text]

    def words(self, codes: np.ndarray) -> pa.Array:
        return pa.array(self.terms, pa.string()).take(pa.array(codes))


def blocks(column: pa.Array) -> Iterator[tuple[int, int]]:
    """(first row, rows) of consecutive blocks of a string column."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    i, n = 0, len(column)
    while i < n:
        before = int(ends[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(ends, before + BLOCK_BYTES, side="right")))
        yield i, j - i
        i = j


def by_blocks(df: DataFrame, text_col: str, schema: str, block: Callable[[pa.RecordBatch, pa.Array], list[pa.Array]]) -> DataFrame:
    """``df`` block by block: ``block(rows, texts)`` gives the columns of ``schema``.

    Rows stay in their partitions, so a frame dealt out by a column that is passed on is
    still dealt out by it.
    """
    names = [f.split(" ")[0].strip("`") for f in schema.split(", ")]
    place = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, rows in blocks(batch.column(place)):
                part = batch.slice(first, rows)
                yield pa.RecordBatch.from_arrays(block(part, part.column(place)), names=names)

    return df.mapInArrow(run, schema)


def ddl(df: DataFrame, *columns: str) -> list[str]:
    """The DDL of some of a frame's columns."""
    return [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns]
