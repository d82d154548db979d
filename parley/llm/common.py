"""Helpers shared by the operators: materialised steps, Arrow text buffers, block sizes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.session import scratch_path

#: Text bytes handled at once inside a task; a longer text is one block of its own.
BLOCK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under ``spark.checkpoint.dir`` and read back.

    Cuts lineage with files every executor can reach, so a lost executor costs the
    readers nothing but their own tasks.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole(docs: DataFrame) -> Column:
    """All columns of a row as one struct, ``row``, so that no column of a caller's table can
    clash with a working column; ``select("row.*")`` gives them back."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of at most ``limit`` bytes, or of one longer text."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive blocks of a string column."""
    data, offsets = utf8(column)
    for i, j in blocks(offsets, limit):
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]


def spread(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Indices that visit ``lengths[i]`` places from ``starts[i]`` on, for each i in turn."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
