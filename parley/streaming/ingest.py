"""Incremental passage ingest with Structured Streaming.

The reference feeds its index in chunks of rows (a memory device, with a barrier every
few chunks).  Here new passage files arriving in a folder are the stream:

  readStream.text(folder) -> parse (S1) -> foreachBatch: append the micro-batch under
  ``epoch=<id>`` with ``batch_id = id + 1`` (overwrite of that one folder, so a replayed
  epoch after a failure rewrites the same rows: exactly-once output)

The stored table is append-only; :func:`read_ingested` applies the S4 rule (latest
``batch_id`` wins) when reading, which is a per-``doc_id`` top-1 with a partial limit
before the shuffle.  A compaction is just ``replace_collection(read_ingested(...))``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parley.sources.collection import latest
from parley.sources.passages import parse_passage_lines


def start_ingest(spark: SparkSession, source_dir: str, table_path: str, checkpoint_path: str,
                 prefix: str = "MARCO_", source: str = "MARCO", max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Process every passage file present in ``source_dir`` (``availableNow`` trigger)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    passages = parse_passage_lines(reader.load(source_dir), prefix, source, 0)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(epoch_id + 1).cast("bigint"))
            .write.mode("overwrite")
            .parquet(f"{table_path.rstrip('/')}/epoch={epoch_id}")
        )

    return (
        passages.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


def read_ingested(spark: SparkSession, table_path: str) -> DataFrame:
    """Current collection: every ingested row, latest batch per ``doc_id``."""
    rows = spark.read.parquet(table_path).select("doc_id", "text", "source", "batch_id")
    return latest(rows)
