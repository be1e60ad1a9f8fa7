"""Stage boundaries written to the shared folder.

Numbering the parts of a walk reads them twice (per-slice counts, and the
parts themselves).  Left lazy, Spark would run the walk once per reader, and
every later plan would carry each earlier walk twice over -- a doubling that
compounds along a pipeline.  The pipelines therefore write the event-walk,
interval-walk and run-walk parts and the re-laid slices as Parquet tables
under the cluster's shared folder (``spark.checkpoint.dir``): later plans stay
linear, and a lost executor late in the job recomputes from such a table
instead of from the scan.

A result is lazy and reads its stage tables, so they can go only once it has
been written: jobs that write run inside ``stage_tables``, which deletes the
tables made within it when it ends.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir

_made: ContextVar[list[str] | None] = ContextVar("stage_tables", default=None)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back."""
    spark = df.sparkSession
    path = shared_dir(spark, "stages", name)
    made = _made.get()
    if made is not None:
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def stage_tables(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the stage tables made inside."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        jvm = spark.sparkContext._jvm
        for path in made:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
