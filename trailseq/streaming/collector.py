"""The collector as a stateless stream: same columns as the batch job, no shuffle, every batch stored once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from trailseq.operators.collect import MIN_HISTORY, collect_histories
from trailseq.sources import json_lines, schemas


def read_contexts(spark: SparkSession, path: str, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schemas.EVENT_CONTEXT).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def start_batches(rows: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
                  available_now: bool = False, interval: str = "10 seconds") -> StreamingQuery:
    """Hand every micro-batch to ``handle(batch, batch_id)``.

    After a failure Spark hands over the last batch again, with the same id and the same rows; a handle that writes
    must know what it has written (``json_lines.append_pairs`` does).
    """
    writer = rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def start_collector(contexts: DataFrame, path: str, checkpoint: str, fmt: str = "json",
                    min_items: int = MIN_HISTORY, available_now: bool = False,
                    interval: str = "10 seconds", stream: str = "0") -> StreamingQuery:
    """Append collected histories to the table at ``path``; JSON files name the pair ``_1``, ``_2``.

    A ledger at ``path`` lists the batches that are stored, so a batch that is replayed writes nothing. A
    checkpoint counts its batches from 0: a collector with a new checkpoint that goes on with the same table needs
    another name of its ``stream``, or its batches count as replays.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        json_lines.append_pairs(batch, path, f"{stream}-{batch_id:012d}", fmt)

    return start_batches(collect_histories(contexts, min_items), store, checkpoint, available_now, interval)
