"""Token ids as flat unsigned-integer files with 64-bit document offsets (operator 8).

A data set is a folder of parts in ascending document order:

* ``part-NNNNN.bin``: the ids of its documents, one after the other, little-endian
  unsigned 16-bit (vocabularies of at most 65,536 ids) or 32-bit integers;
* ``part-NNNNN.idx``: little-endian 64-bit integers: the offset, in ids within the part,
  where each document starts, then the part's number of ids;
* ``part-NNNNN.doc``: the documents' ids, little-endian 64-bit integers, -2^63 for null.

Document i of the data set starts at its part's base plus its offset; the bases are the
prefix sums of the parts' numbers of ids.  All files can be memory-mapped.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import stored, text_blocks
from parley.llm.pieces import PieceEncoder

#: Pieces given to the tokenizer at once.
BATCH = 2000
NULL_ID = -(2**63)


@lru_cache(maxsize=2)
def _encoder(path: str, definition) -> PieceEncoder:
    """The tokenizer of a broadcast definition, kept per process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition.value)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text

    def encode(pieces: list[bytes]) -> list[bytes]:
        texts = [p.decode("utf-8") for p in pieces]
        return [np.array(e.ids, "<u4").tobytes() for i in range(0, len(texts), BATCH) for e in tokenizer.encode_batch_fast(texts[i : i + BATCH], add_special_tokens=False)]

    return PieceEncoder(encode)


def _place(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)


def _id_type(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def write_tokens(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes ``docs`` to ``folder`` (which all executors share) in ascending doc_id order.

    Returns the manifest, stored: one row per part with rows: part, n_docs, n_tokens, base
    (ids before the part) and first_doc (documents before it).  Rows that share a doc_id
    are ordered by their text's hash and text; nulls come first.  A null text is empty; every document
    ends with ``end_id``.  An empty table gives no part.  Other columns are ignored.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    from tokenizers import Tokenizer

    id_type = _id_type(max(end_id + 1, Tokenizer.from_str(definition).get_vocab_size(with_added_tokens=True)))
    shared = spark.sparkContext.broadcast(definition)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("__h", F.xxhash64("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "doc_id", "__h").sortWithinPartitions("doc_id", "__h", "text").select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path, shared)
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        fs, path = _place(folder)
        fs.create_dir(path, recursive=True)
        names = {kind: f"{path}/part-{part:05d}.{kind}" for kind in ("bin", "idx", "doc")}
        starts, total = [], 0
        with fs.open_output_stream(f"{names['bin']}.{attempt}") as out, fs.open_output_stream(f"{names['idx']}.{attempt}") as index, fs.open_output_stream(f"{names['doc']}.{attempt}") as doc:
            for batch in batches:
                doc.write(pc.fill_null(batch.column(0).cast(pa.int64()), NULL_ID).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                for _, _, data, offsets in text_blocks(batch.column(1)):
                    ids, at = encoder.block(data, offsets)
                    n = len(offsets) - 1
                    out.write(np.insert(ids, at[1:], end_id).astype(id_type).tobytes())
                    starts = total + at[:-1] + np.arange(n)
                    index.write(starts.astype("<i8").tobytes())
                    total += len(ids) + n
            index.write(np.array([total], "<i8").tobytes())
            n_docs = index.tell() // 8 - 1
        for name in names.values():
            fs.move(f"{name}.{attempt}", name) if n_docs else fs.delete_file(f"{name}.{attempt}")
        if n_docs:
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "n_docs": pa.array([n_docs], pa.int64()), "n_tokens": pa.array([total], pa.int64())})

    written = stored(ordered.mapInArrow(write, "part long, n_docs long, n_tokens long"), "token-parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    return written.select("part", "n_docs", "n_tokens", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"),
                          F.coalesce(F.sum("n_docs").over(before), F.lit(0)).alias("first_doc"), F.lit(folder).alias("folder"), F.lit(id_type).alias("id_type"))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """One row per document of the files: doc_id, place (documents before it), start (ids before
    it), n_tokens (with the end id) and ids_crc32 of its ids as unsigned 32-bit integers.
    Local files are memory-mapped; others are read range by range."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = _place(row["folder"])
                name = f"{path}/part-{row['part']:05d}"
                opened = (lambda f: pa.memory_map(f)) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file
                with opened(f"{name}.idx") as index, opened(f"{name}.bin") as data, opened(f"{name}.doc") as doc:
                    width = np.dtype(row["id_type"]).itemsize
                    for i in range(0, row["n_docs"], 1000):
                        n = min(1000, row["n_docs"] - i)
                        at = np.frombuffer(index.read_at(8 * (n + 1), 8 * i), "<i8")
                        crc = [zlib.crc32(np.frombuffer(data.read_at(width * (b - a), width * a), row["id_type"]).astype("<u4").tobytes()) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                        ids = np.frombuffer(doc.read_at(8 * n, 8 * i), "<i8")
                        yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, mask=ids == NULL_ID), "place": pa.array(row["first_doc"] + i + np.arange(n)), "start": pa.array(row["base"] + at[:-1]), "n_tokens": pa.array(np.diff(at)), "ids_crc32": pa.array(crc, pa.int64())})

    each = max(1, manifest.count())
    return manifest.repartition(each, "part").mapInArrow(read, "doc_id long, place long, start long, n_tokens long, ids_crc32 long")
