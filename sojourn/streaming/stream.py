"""The trace job as a Structured Streaming query.

New files of a point log are read with ``readStream``; every micro-batch is a
bounded batch that runs the same DataFrame pipeline as the batch job and
writes its lines under ``batch=<epoch>``.  Each epoch overwrites its own
directory, so a retried epoch replaces its partial output (idempotent sink),
and the query's checkpoint -- in the shared folder -- replaces the saved
``stopTime``.  As in the batch job, a stay that spans two batches is cut at
the batch border.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.stage import stage_tables
from ..session import shared_dir


def start_trace_stream(spark: SparkSession, source_dir: str, schema: str,
                       to_lines: Callable[[DataFrame], DataFrame], target_dir: str,
                       checkpoint_dir: str | None = None, available_now: bool = True,
                       max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; ``to_lines`` maps one micro-batch to ``(t, line)``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    source = reader.parquet(source_dir)

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        with stage_tables(spark):
            to_lines(batch).select("line").write.mode("overwrite").text(f"{target_dir.rstrip('/')}/batch={epoch_id}")

    writer = (source.writeStream.foreachBatch(each_batch)
              .option("checkpointLocation", checkpoint_dir or shared_dir(spark, "stream-checkpoint")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
