"""End-to-end jobs: slice scan -> cleaning -> trace pipeline (or raw rows) -> lines.

Each job returns ``(t, line)``: the line to publish and the time used for the
high-water mark.  Writing, statistics and the mark are in ``sinks``.

Cleaning follows the original order: quotes are removed first, then rows are
kept when the id is long enough, the time is ten digits and (strict variant)
the site has exactly 14 characters.  Rows with a null id, time or site are
dropped instead of aborting the run.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_epoch_seconds, is_valid_id, is_valid_site, segment_line, strip_quotes, tsv_line
from ..sources.scans import endpoint_events, scan_range
from . import traces

POINT_SOURCE = "1"      # fixed values: the source tag of point-derived and interval-derived lines
INTERVAL_SOURCE = "2"


def clean_points(raw: DataFrame, strict_sites: bool = False) -> DataFrame:
    """``(id, t, site)`` with quotes stripped and invalid rows removed."""
    rows = raw.select(strip_quotes("id").alias("id"), F.col("t"), strip_quotes("site").alias("site"))
    keep = is_valid_id("id") & F.col("t").isNotNull() & is_epoch_seconds("t") & F.col("site").isNotNull()
    if strict_sites:
        keep = keep & is_valid_site("site")
    return rows.where(keep)


def segments_to_lines(segments: DataFrame, source: str) -> DataFrame:
    return segments.select(F.col("stime").alias("t"), segment_line(source).alias("line"))


def job_trace_points(points_raw: DataFrame, start: int, end: int, strict_sites: bool = False,
                     pipeline: Callable[[DataFrame], DataFrame] = traces.trace_relay,
                     source: str = POINT_SOURCE) -> DataFrame:
    """Point log ``(id, t, site)`` in ``[start, end)`` -> segment lines."""
    sliced = scan_range(points_raw, "t", start, end)
    return segments_to_lines(pipeline(clean_points(sliced, strict_sites)), source)


def job_trace_split(points_raw: DataFrame, start: int, end: int) -> DataFrame:
    """The strict split job: 14-character sites, head-excluded equal split."""
    return job_trace_points(points_raw, start, end, strict_sites=True, pipeline=traces.trace_split_excl)


def job_trace_endpoints(intervals_raw: DataFrame, start: int, end: int, strict_sites: bool = False,
                        pipeline: Callable[[DataFrame], DataFrame] = traces.trace_relay) -> DataFrame:
    """Interval log: the range applies to ``stime``; both ends become points."""
    sliced = scan_range(intervals_raw, "stime", start, end)
    return segments_to_lines(pipeline(clean_points(endpoint_events(sliced), strict_sites)), INTERVAL_SOURCE)


def job_split_endpoints(intervals_raw: DataFrame, start: int, end: int) -> DataFrame:
    """The strict split job over an interval log: both ends as points, 14-character sites,
    head-excluded equal split."""
    return job_trace_endpoints(intervals_raw, start, end, strict_sites=True, pipeline=traces.trace_split_excl)


def job_log_export(log_rows: DataFrame, columns: Sequence[str], time_col: str, start: int, end: int,
                   inclusive_end: bool = False, day_col: str | None = "day") -> DataFrame:
    """Generic log slice -> ``(t, line)``; rows whose time is not ten digits are dropped."""
    sliced = scan_range(log_rows, time_col, start, end, inclusive_end, day_col)
    return (sliced.where(is_epoch_seconds(time_col))
            .select(F.col(time_col).cast("long").alias("t"), tsv_line(*columns).alias("line")))
