"""Dense ranks within groups, without a task that sees a whole group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage_table


def ranked(df: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``rank`` (from 0, along ``order`` within ``group``, a column without nulls) and ``n``
    (rows of the group).

    Rows are dealt by a range partitioning over (group, *order), so a slice holds about as many rows
    whatever a group holds; each slice numbers its rows in one sorted pass and is written.  What precedes
    a slice in its group comes from a window over one row for each slice and group."""
    fields = df.select("*", F.lit(0).alias("__slice"), F.lit(0).cast("long").alias("__at")).schema
    at = df.columns.index(group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            g = b.column(at)
            fresh = np.concatenate([[last is None or g[0].as_py() != last], pc.not_equal(g[1:], g[:-1]).to_numpy(zero_copy_only=False)]).astype(bool)
            rows = np.arange(b.num_rows)
            start = np.maximum.accumulate(np.where(fresh, rows, -1))
            local = np.where(start < 0, seen + rows, rows - start)
            last, seen = g[-1].as_py(), int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(local)], b.schema.names[:-1] + ["__at"])

    slices = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (df.repartitionByRange(slices, group, *order).sortWithinPartitions(group, *order)
             .select("*", F.spark_partition_id().alias("__slice"), F.lit(0).cast("long").alias("__at")))
    rows = stage_table(dealt.mapInArrow(run, fields), name)
    counts = rows.groupBy(group, "__slice").agg((F.max("__at") + 1).alias("__n"))
    w = Window.partitionBy(group).orderBy("__slice")
    before = stage_table(counts.select(
        F.col(group).alias("__g"), F.col("__slice").alias("__s"), (F.sum("__n").over(w) - F.col("__n")).alias("__before"),
        F.sum("__n").over(Window.partitionBy(group)).alias("n")), f"{name}_slices")
    return (rows.join(before, (rows[group] == before["__g"]) & (rows["__slice"] == before["__s"]))
            .select(*(rows[c] for c in df.columns), (F.col("__before") + F.col("__at")).alias("rank"), "n"))
