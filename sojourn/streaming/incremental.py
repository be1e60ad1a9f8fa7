"""Resumable bounded batches: the original job's run model.

Each run of a job processes ``[start, end)`` where ``start`` is the job's
saved ``stopTime``; after the lines are published, the next ``stopTime`` and
the number of rows written are saved and an audit line is appended.

The control table is append-only (``id, type, name, value`` with increasing
ids, read back through :func:`operators.state.state_latest`), so a run that
dies half-way leaves the previous mark in force and the batch is simply
processed again.  Its files are folded to the newest row of each key as they
grow, while readers go on (``sinks.append``).  Publishing carries the slice as its run id: a rerun of a
slice whose lines were already committed publishes nothing again, so each slice
is delivered once.  An empty slice publishes no file and moves the mark.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.state import state_latest
from ..operators.watermark import next_watermark_value
from ..plans.stage import materialize, stage_tables
from ..sinks import audit_append, publish_lines
from ..sinks.append import append_rows, fold, read_appended

CONTROL_SCHEMA = "id bigint, type string, name string, value string"
STOP_TIME = "stopTime"
RESULT_NUMS = "resultNums"


def read_control(spark: SparkSession, path: str) -> DataFrame:
    """The control table; empty only if it does not exist yet.  Any other error raises, so a
    storage fault never looks like a job without a mark."""
    return read_appended(spark, path, CONTROL_SCHEMA)


def newest_rows(rows: DataFrame) -> DataFrame:
    """Per type and name (without case) the row with the largest id: all that a reader of marks needs."""
    key = [F.lower(F.trim("type")).alias("_type"), F.lower(F.trim("name")).alias("_name")]
    columns = [f.split()[0] for f in CONTROL_SCHEMA.split(", ")]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*columns), "id").alias("_row")).select("_row.*")


def saved_value(spark: SparkSession, path: str, job: str, name: str) -> str | None:
    """The newest value of ``(job, name)``, names compared without case; one row reaches the driver."""
    rows = read_control(spark, path).select("id", F.lower("type").alias("type"), F.lower("name").alias("name"), "value")
    row = (state_latest(rows).where((F.col("type") == job.strip().lower()) & (F.col("name") == name.strip().lower()))
           .select("value").first())
    return None if row is None else row[0]


def save_values(spark: SparkSession, path: str, job: str, values: dict[str, str]) -> None:
    base = time.time_ns()
    rows = [(base + i, job, name, str(v)) for i, (name, v) in enumerate(values.items())]
    append_rows(spark, path, rows, CONTROL_SCHEMA)
    fold(spark, path, CONTROL_SCHEMA, newest_rows)


def run_increment(spark: SparkSession, job: str, run: Callable[[int, int], DataFrame], targets: Sequence[str],
                  control_path: str, end: int, first_start: int, audit_path: str | None = None,
                  num_files: int | None = None) -> dict:
    """Run ``run(start, end)`` -> ``(t, line)`` for the next slice of ``job`` and save the mark.

    Returns ``{"start", "end", "rows", "stop_time"}``; nothing is done when the
    saved mark has already reached ``end``.
    """
    saved = saved_value(spark, control_path, job, STOP_TIME)
    start = int(saved) if saved is not None else first_start
    if start >= end:
        return {"start": start, "end": end, "rows": 0, "stop_time": start}
    with stage_tables(spark):
        lines = run(start, end)
        if num_files:  # they are measured, then written
            lines = materialize(lines.select("t", "line"), "increment")
        stats = publish_lines(lines, targets, num_files=num_files, run_id=f"{job}-{start}-{end}")
    rows, max_t = stats["rows"], stats["max_t"]
    if rows == 0:
        stop = end                       # empty slice: move on, nothing written
    else:
        max_out = max(start, int(max_t))
        stop = next_watermark_value(rows, int(max_t), rows, max_out, end)
    save_values(spark, control_path, job, {STOP_TIME: str(stop), RESULT_NUMS: str(rows)})
    if audit_path:
        audit_append(spark, audit_path, job, f"{spark.sparkContext.applicationId},{start},{end}")
    return {"start": start, "end": end, "rows": rows, "stop_time": stop}
