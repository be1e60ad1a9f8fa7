"""Write statistics and the resumable high-water mark.

After a batch ``[start, end)`` is written, the job saves ``stopTime`` (where
the next batch starts) and ``resultNums`` (rows written):

* if every input row was written, or the newest written time equals the newest
  input time, the next batch starts at ``end``;
* otherwise it starts at the newest written time, plus one second when that is
  still before ``end``.

``max_out`` is seeded with ``start`` (a max-accumulator with that zero).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_stats(rows: DataFrame, job_col: str, time_col: str, written: Column, start: int) -> DataFrame:
    """``(job, count_in, max_in, count_out, max_out)`` in one aggregate pass."""
    t = F.col(time_col)
    return rows.groupBy(F.col(job_col).alias("job")).agg(
        F.count(F.lit(1)).cast("long").alias("count_in"),
        F.max(t).alias("max_in"),
        F.count_if(written).cast("long").alias("count_out"),
        F.greatest(F.lit(start).cast("long"), F.max(F.when(written, t))).alias("max_out"),
    )


def next_watermark_expr(count_in: Column, max_in: Column, count_out: Column, max_out: Column,
                        end: Column) -> Column:
    done = (count_in == count_out) | (max_in == max_out)
    return F.when(done, end).otherwise(max_out + F.when(max_out < end, 1).otherwise(0))


def next_watermark(stats: DataFrame, end: int) -> DataFrame:
    """``(job, stop_time, result_nums)`` from :func:`write_stats` rows."""
    e = F.lit(end).cast("long")
    stop = next_watermark_expr(F.col("count_in"), F.col("max_in"), F.col("count_out"), F.col("max_out"), e)
    return stats.select("job", stop.cast("long").alias("stop_time"), F.col("count_out").alias("result_nums"))


def next_watermark_value(count_in: int, max_in: int | None, count_out: int, max_out: int, end: int) -> int:
    """Driver-side twin for one job's observed stats (the writer's metrics)."""
    if count_in == count_out or max_in == max_out:
        return end
    return max_out + (1 if max_out < end else 0)
