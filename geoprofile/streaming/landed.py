"""Incremental profiles over landed survey extracts (Structured Streaming).

The reference fetches survey tables and snapshots them to files between
scripts.  Here each landed extract (one file = one complete table for one
year) is picked up by a file-source stream and run through the same batch
operators in ``foreachBatch``; ``trigger(availableNow=True)`` processes
what has landed and stops, so a scheduled job only touches new files.

Exactly-once output: each micro-batch is written to its own
``batch_id=N`` folder with overwrite, so a retried batch replaces its own
output instead of appending twice; offsets live in the checkpoint
location (a shared folder), so a restarted job resumes where it stopped.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.metadata import ESTIMATES_SCHEMA


def profile_landed(spark: SparkSession, landed_dir: str, out_dir: str, checkpoint: str,
                   transform: Callable[[DataFrame], DataFrame], schema: str = ESTIMATES_SCHEMA,
                   fmt: str = "parquet", max_files_per_trigger: int | None = None):
    """Start (and return) the stream; call ``.awaitTermination()`` to wait.

    ``max_files_per_trigger`` can put the files of one table in two batches, and
    ``transform`` then sees (and shares out) each part alone: set it only when a file is a
    complete table, as it is by the landing convention above.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.load(landed_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(os.path.join(out_dir, f"batch_id={batch_id}"))

    return (src.writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
