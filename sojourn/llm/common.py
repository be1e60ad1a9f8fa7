"""Helpers shared by the training-data operators.

Tables are read by Spark's own reader (any store Spark reaches).  Work that
needs Python runs per Arrow batch inside tasks; ``small_batches`` cuts each
batch by bytes, so one batch of very long texts never has to be processed as a
whole.  Intermediate tables go to the cluster's shared folder
(``session.shared_dir``), which also cuts lineage: a lost executor later on
recomputes from such a table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir

#: Bytes of Arrow data handled at a time inside a Python task.
BATCH_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    path = shared_dir(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(batches: Iterator[pa.RecordBatch], limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in the same order, cut so that a piece holds about ``limit`` bytes or one row."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        step = max(1, int(n * limit / max(batch.nbytes, 1)))
        for at in range(0, n, step):
            piece = batch.slice(at, step)
            if piece.nbytes > 4 * limit and piece.num_rows > 1:  # long rows lie together
                yield from small_batches(_singles(piece, limit), limit=1 << 62)
            else:
                yield piece


def _singles(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    start, held = 0, 0
    for i in range(batch.num_rows):
        held += batch.slice(i, 1).nbytes
        if held >= limit:
            yield batch.slice(start, i + 1 - start)
            start, held = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def text_bytes(column: pa.Array) -> list[bytes]:
    """The column's strings as UTF-8 bytes; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if x is None else x for x in column.cast(kind).to_pylist()]
