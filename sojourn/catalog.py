"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the benchmark tables (``events``, ``documents``) through the
adapters in ``sources/tables.py`` and runs over the whole table; the only
range-limited queries are the range scans themselves, whose range *is* the
operator.  Column names and types equal the SQL in ``oracle.py``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from .functions import csv_index, epoch_to_day, is_epoch_seconds, is_valid_id, is_valid_site, segment_line
from .functions import strip_quotes, tsv_line
from .operators.lists import events_per_id, flatten_events
from .operators.merge import remerge
from .operators.runs import RELAY_RULE, SPLIT_RULE, mark_runs
from .operators.segments import dwell_segments, interval_segments
from .operators.sequence import range_slices
from .operators.smoothing import relay_by_dwell, split_equal
from .operators.state import state_delete, state_exists, state_latest, state_upsert
from .operators.watermark import next_watermark, write_stats
from .plans import jobs, traces
from .session import shared_dir
from .sinks import audit_append, compact_lines, publish_lines, published, read_audit
from .sinks.lines import read_lines, staged_bytes
from .sources import tables as tb
from .sources.scans import endpoint_events, point_events, scan_range
from .streaming import read_control, run_increment

Query = Callable[[SparkSession, str], DataFrame]
SEG = ["id", "stime", "site", "etime"]


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return tb.read_table(spark, sf, "events")


def _points(spark: SparkSession, sf: str) -> DataFrame:
    return tb.points(_events(spark, sf))


# --- scans ------------------------------------------------------------------

def log_scan_closed(spark, sf):
    start, end = O.MIDNIGHT_RANGE[0], O.CLOSED_END
    rows = tb.log(tb.events_in_range(_events(spark, sf), start, end, inclusive_end=True))
    return scan_range(rows, "t", start, end, inclusive_end=True, day_col="day", columns=tb.LOG_COLUMNS)


def log_scan_half_open(spark, sf):
    start, end = O.DAY_RANGE
    rows = tb.log(tb.events_in_range(_events(spark, sf), start, end))
    return scan_range(rows, "t", start, end, day_col="day", columns=tb.LOG_COLUMNS)


def day_pruned_scan(spark, sf):
    """A range past midnight over a log stored by day: only its two days are read."""
    start, end = O.MIDNIGHT_RANGE
    path = shared_dir(spark, "log-by-day")
    tb.log(_events(spark, sf)).repartition("day").write.partitionBy("day").parquet(path)
    stored = spark.read.schema(tb.log(_events(spark, sf)).schema).parquet(path)
    return scan_range(stored, "t", start, end, day_col="day", columns=tb.LOG_COLUMNS)


def point_scan(spark, sf):
    start, end = O.MIDNIGHT_RANGE
    raw = tb.points(tb.events_in_range(_events(spark, sf), start, end))
    return scan_range(point_events(raw, "id", "t", "site"), "t", start, end)


def endpoint_events_q(spark, sf):
    return endpoint_events(tb.intervals(_events(spark, sf), null_ends=True))


# --- cleaning rules and scalars ----------------------------------------------

def _dirty(spark, sf):
    return tb.points_dirty(_events(spark, sf))


def strip_quotes_q(spark, sf):
    return _dirty(spark, sf).select(strip_quotes("id").alias("id"), "t", strip_quotes("site").alias("site"))


def valid_epoch(spark, sf):
    return _dirty(spark, sf).where(is_epoch_seconds("t"))


def valid_id(spark, sf):
    return _dirty(spark, sf).select(strip_quotes("id").alias("id"), "t", "site").where(is_valid_id("id"))


def valid_site(spark, sf):
    return _dirty(spark, sf).select("id", "t", strip_quotes("site").alias("site")).where(is_valid_site("site"))


def epoch_to_day_q(spark, sf):
    t = tb.epoch_seconds()
    return _events(spark, sf).select("event_id", epoch_to_day(t).alias("day_s"),
                                     epoch_to_day(t * 1000).alias("day_ms"))


def csv_index_q(spark, sf):
    return _events(spark, sf).select("event_id", csv_index("event_type", F.lit("click,view,error")).alias("idx"))


def row_to_tsv(spark, sf):
    return tb.log(_events(spark, sf)).select("t", tsv_line(*tb.LOG_COLUMNS).alias("line"))


def segment_to_tsv(spark, sf):
    return traces.trace_relay(_points(spark, sf)).select(F.col("stime").alias("t"),
                                                          segment_line(jobs.POINT_SOURCE).alias("line"))


# --- lists -------------------------------------------------------------------

def events_per_id_q(spark, sf):
    return events_per_id(_points(spark, sf))


def flatten_events_q(spark, sf):
    return flatten_events(events_per_id(_points(spark, sf)))


# --- ordered per-id operators ----------------------------------------------

def dwell_segments_q(spark, sf):
    return dwell_segments(_points(spark, sf)).select(*SEG)


def dwell_segments_mixed(spark, sf):
    return dwell_segments(tb.points_mixed(_events(spark, sf))).select(*SEG)


def interval_segments_q(spark, sf):
    return interval_segments(tb.intervals(_events(spark, sf))).select(*SEG)


def runs_head_excluded(spark, sf):
    return mark_runs(dwell_segments(_points(spark, sf)), *SPLIT_RULE).select(
        "id", "seg", "stime", "site", "etime", "short", "run")


def runs_head_included(spark, sf):
    return mark_runs(dwell_segments(_points(spark, sf)), *RELAY_RULE).select(
        "id", "seg", "stime", "site", "etime", "short", "run")


def split_equal_q(spark, sf):
    segs = traces.sliced_point_segments(_points(spark, sf))
    return split_equal(mark_runs(segs, *RELAY_RULE), ["run"])


def relay_by_dwell_q(spark, sf):
    """Row path: runs marked per segment, then the re-lay."""
    segs = traces.sliced_point_segments(_points(spark, sf))
    return relay_by_dwell(mark_runs(segs, *RELAY_RULE), ["run"])


def remerge_q(spark, sf):
    order = ["stime", "site", "etime"]
    return remerge(range_slices(tb.intervals(_events(spark, sf)).distinct(), order), order, "_chunk")


def trace_split_excl(spark, sf):
    return traces.trace_split_excl(_points(spark, sf))


def trace_split_incl(spark, sf):
    return traces.trace_split_incl(_points(spark, sf))


def trace_relay(spark, sf):
    return traces.trace_relay(_points(spark, sf))


def trace_interval(spark, sf):
    return traces.trace_interval(tb.intervals(_events(spark, sf)))


# --- jobs --------------------------------------------------------------------

def _job_events(spark, sf):
    return tb.events_in_range(_events(spark, sf), O.JOB_START, O.JOB_END)


def job_trace_points(spark, sf):
    return jobs.job_trace_points(tb.points_dirty(_job_events(spark, sf)), O.JOB_START, O.JOB_END)


def job_trace_split(spark, sf):
    return jobs.job_trace_split(tb.points_dirty(_job_events(spark, sf)), O.JOB_START, O.JOB_END)


def job_trace_endpoints(spark, sf):
    return jobs.job_trace_endpoints(tb.intervals(_job_events(spark, sf), null_ends=True), O.JOB_START, O.JOB_END)


def job_split_endpoints(spark, sf):
    return jobs.job_split_endpoints(tb.intervals_dirty(_job_events(spark, sf)), O.JOB_START, O.JOB_END)


def job_log_export_closed(spark, sf):
    """The closed-end export: rows of the last second are part of the slice."""
    start, end = O.MIDNIGHT_RANGE[0], O.CLOSED_END
    rows = tb.log(tb.events_in_range(_events(spark, sf), start, end, inclusive_end=True))
    return jobs.job_log_export(rows, tb.LOG_COLUMNS, "t", start, end, inclusive_end=True)


def job_incremental(spark, sf):
    """Three runs of the export job -- two slices and an empty one: the published lines, the
    marks after each run and the audit rows."""
    events = _events(spark, sf)
    control, audit = shared_dir(spark, "control"), shared_dir(spark, "audit")
    targets = [shared_dir(spark, "library", f"inc{i}") for i in range(2)]

    def export(start, end):
        return jobs.job_log_export(tb.log(tb.events_in_range(events, start, end)), tb.LOG_COLUMNS, "t", start, end)

    for end in O.INCREMENT_ENDS:
        run_increment(spark, "export", export, targets, control, end, O.JOB_START, audit, num_files=3)
    lines = published(spark, targets).select(F.lit("line").alias("kind"), F.lit(None).cast("string").alias("name"), F.col("line").alias("value"))
    marks = read_control(spark, control).select(F.lit("mark").alias("kind"), "name", "value")
    runs = read_audit(spark, audit).select(F.lit("audit").alias("kind"), F.col("title").alias("name"),
                                           F.substring_index("content", ",", -2).alias("value"))
    return lines.unionByName(marks).unionByName(runs)


def job_log_export(spark, sf):
    return jobs.job_log_export(tb.log(_job_events(spark, sf)), tb.LOG_COLUMNS, "t", O.JOB_START, O.JOB_END)


# --- statistics and the mark -------------------------------------------------

def _stats(spark, sf):
    ev = _events(spark, sf)
    t = tb.epoch_seconds()
    rows = ev.select(F.concat(F.lit("job"), F.col("user_id").cast("string")).alias("job"),
                     F.when(F.col("event_id") % 97 == 0, t * 1000).otherwise(t).alias("t"))
    return write_stats(rows, "job", "t", is_epoch_seconds("t"), O.JOB_START)


def write_stats_q(spark, sf):
    return _stats(spark, sf)


def next_watermark_q(spark, sf):
    return next_watermark(_stats(spark, sf), O.JOB_END)


# --- control state -----------------------------------------------------------

def _control(spark, sf):
    return tb.control(_events(spark, sf))


def _even(df):
    return df.where(F.col("id") % 2 == 0)


def _odd(df):
    return df.where(F.col("id") % 2 == 1)


def _renamed(df):
    """Keys of two thirds of the rows changed, so that many are absent from the base."""
    return df.withColumn("name", F.when(F.col("id") % 3 == 0, F.col("name")).otherwise(F.concat("name", F.lit("-old"))))


def state_latest_q(spark, sf):
    return state_latest(_control(spark, sf)).select("id", "type", "name", "value")


def state_upsert_q(spark, sf):
    c = _control(spark, sf)
    return state_upsert(_even(c), _odd(c))


def state_delete_q(spark, sf):
    c = _control(spark, sf)
    return state_delete(_even(c), _renamed(_odd(c)))


def state_exists_q(spark, sf):
    c = _control(spark, sf)
    return state_exists(_even(c), _renamed(_odd(c)))


# --- sinks -------------------------------------------------------------------

def publish_lines_q(spark, sf):
    lines = tb.lines(tb.read_table(spark, sf, "documents")).withColumn("t", F.lit(None).cast("long"))
    targets = [shared_dir(spark, "library", f"lib{i}") for i in range(2)]
    publish_lines(lines, targets, num_files=4)
    return published(spark, targets)


def compact_lines_q(spark, sf):
    lines = tb.lines(tb.read_table(spark, sf, "documents"))
    staging = shared_dir(spark, "compact-staging")
    library = shared_dir(spark, "compact-library")
    lines.repartition(16).write.text(staging)
    total = staged_bytes(spark, staging)
    # No file is old enough: only full groups move; the rest stays staged.
    libraries = [f"{library}/{k}" for k in range(2)]
    compact_lines(spark, staging, libraries, limit_bytes=max(1, total // 3), limit_seconds=10 ** 9)
    return read_lines(spark, [library, staging])


def audit_append_q(spark, sf):
    n = traces.trace_relay(_points(spark, sf)).count()
    path = shared_dir(spark, "audit")
    ts = _dt.datetime.fromtimestamp(O.JOB_END, tz=_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    size = tb.log(_events(spark, sf)).select(F.sum(F.length(tsv_line(*tb.LOG_COLUMNS)) + 1)).first()[0]
    audit_append(spark, path, "trace_relay", str(n), ts=ts)
    audit_append(spark, path, "import", "log", ts=ts, path="library/log", nbytes=size, duration_ms=0)
    return read_audit(spark, path)


QUERIES: dict[str, Query] = {
    "log_scan_closed": log_scan_closed,
    "log_scan_half_open": log_scan_half_open,
    "day_pruned_scan": day_pruned_scan,
    "point_scan": point_scan,
    "endpoint_events": endpoint_events_q,
    "strip_quotes": strip_quotes_q,
    "valid_epoch": valid_epoch,
    "valid_id": valid_id,
    "valid_site": valid_site,
    "epoch_to_day": epoch_to_day_q,
    "csv_index": csv_index_q,
    "row_to_tsv": row_to_tsv,
    "segment_to_tsv": segment_to_tsv,
    "events_per_id": events_per_id_q,
    "flatten_events": flatten_events_q,
    "dwell_segments": dwell_segments_q,
    "dwell_segments_mixed": dwell_segments_mixed,
    "interval_segments": interval_segments_q,
    "runs_head_excluded": runs_head_excluded,
    "runs_head_included": runs_head_included,
    "split_equal": split_equal_q,
    "relay_by_dwell": relay_by_dwell_q,
    "remerge": remerge_q,
    "trace_split_excl": trace_split_excl,
    "trace_split_incl": trace_split_incl,
    "trace_relay": trace_relay,
    "trace_interval": trace_interval,
    "job_trace_points": job_trace_points,
    "job_trace_split": job_trace_split,
    "job_trace_endpoints": job_trace_endpoints,
    "job_split_endpoints": job_split_endpoints,
    "job_log_export": job_log_export,
    "job_log_export_closed": job_log_export_closed,
    "job_incremental": job_incremental,
    "write_stats": write_stats_q,
    "next_watermark": next_watermark_q,
    "state_latest": state_latest_q,
    "state_upsert": state_upsert_q,
    "state_delete": state_delete_q,
    "state_exists": state_exists_q,
    "publish_lines": publish_lines_q,
    "compact_lines": compact_lines_q,
    "audit_append": audit_append_q,
}
