"""The trace pipelines: points (or intervals) -> dwell history.

=================  ===========================================================
``trace_split_excl``  segments -> short runs 300/1800, head excluded -> equal split -> dedupe
``trace_split_incl``  segments -> short runs 300/300, head included -> equal split -> dedupe
``trace_relay``       segments -> short runs 60/180, head included -> re-lay by dwell -> re-merge
``trace_interval``    interval segments -> short runs 300/300, head excluded -> equal split -> dedupe
=================  ===========================================================

Each stage keeps ``id`` in its keys, and every per-id walk is sliced (see
``operators/sequence.py``), so no stage sends one id's whole history to one
task.  All outputs are ``(id, stime, site, etime)``.  With ``slices`` the walks and the
scans of each run's sites go over that many slices of equal size, for very dense ids
and for runs over very many sites.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from pyspark.sql import functions as F

from ..operators.merge import dedupe_segments, remerge
from ..operators.runs import RELAY_RULE, SLICE_SEGMENTS, SPLIT_RULE, SPLIT_RULE_TIGHT, run_key, run_site_parts
from ..operators.segments import (DAY_SLICE, DWELL_GAP, dwell_segment_parts, even_dwell_segments, interval_segments, merge_segment_parts,
                                  number_segment_parts)
from ..operators.sequence import rank_chunk, with_halo
from ..operators.smoothing import MIN_RELAY_RUN, merge_site_stats, relay_from_stats, split_from_stats
from .stage import materialize

SLICE_RUNS = 100_000


def sliced_segments(segments: DataFrame, slice_segments: int = SLICE_SEGMENTS, halo: bool = False) -> DataFrame:
    """Segments written to the shared folder, then hash-partitioned on
    ``(id, _sc)`` with ``_sc`` = blocks of ``slice_segments`` segments -- the
    partitioning the run walk uses.  With ``halo`` each block's last segment
    is also copied into the next block (flag ``_halo``) before that one
    shuffle."""
    segs = materialize(segments, "segments").withColumn("_sc", rank_chunk("seg", slice_segments))
    if halo:
        segs = with_halo(segs, "_sc", (F.col("seg") % slice_segments) == 0)
    return segs.repartition("id", "_sc")


def sliced_point_segments(points: DataFrame, slice_seconds: int = DAY_SLICE,
                          slice_segments: int = SLICE_SEGMENTS, halo: bool = False, slices: int | None = None) -> DataFrame:
    """As :func:`sliced_segments` for point events: segment parts are written,
    numbered, copied into the next block when they belong to a block's last
    segment, and merged after the one shuffle on ``(id, _sc)``.  With ``slices``
    the walk is :func:`segments.even_dwell_segments`, for very dense ids."""
    if slices:
        return sliced_segments(even_dwell_segments(points, slices=slices), slice_segments, halo)
    parts = materialize(dwell_segment_parts(points, slice_seconds=slice_seconds), "segment-parts")
    parts = number_segment_parts(parts).withColumn("_sc", rank_chunk("seg", slice_segments))
    trailing: tuple[str, ...] = ()
    if halo:
        parts = with_halo(parts, "_sc", (F.col("seg") % slice_segments) == 0)
        trailing = ("_halo",)
    return merge_segment_parts(parts.repartition("id", "_sc"), ("_sc",), trailing)


def run_stats(segments: DataFrame, dur: int, gap: int, head_included: bool,
              slice_segments: int = SLICE_SEGMENTS, slices: int | None = None, slice_runs: int | None = None) -> DataFrame:
    """Sliced segments (with halo copies) -> per ``(id, run[, short], site)``
    statistics, partitioned on ``(id, run)`` for the per-run windows; with ``slice_runs`` on
    ``(id, _rb)``, the blocks of run keys in which a later walk goes on, so it needs no shuffle;
    with ``slices``, whose scans need no such partitioning, on the whole key, so a run's sites are spread."""
    flag = "_halo" if "_halo" in segments.columns else None
    parts = run_site_parts(segments, dur, gap, head_included, slice_segments, halo_flag=flag)
    if slice_runs and not slices:
        parts = parts.withColumn("_rb", rank_chunk("run", slice_runs)).repartition("id", "_rb")
        return merge_site_stats(parts, ["_rb", *run_key(head_included)])
    return merge_site_stats(parts if slices else parts.repartition("id", "run"), run_key(head_included))


def split_runs(segments: DataFrame, dur: int, gap: int, head_included: bool,
               slice_segments: int = SLICE_SEGMENTS, slices: int | None = None) -> DataFrame:
    """Sliced segments -> each run cut into equal slices; ``(id, *key, stime, site, etime)``."""
    key = run_key(head_included)
    return split_from_stats(run_stats(segments, dur, gap, head_included, slice_segments, slices), key, slices)


def relay_runs(segments: DataFrame, dur: int = RELAY_RULE[0], gap: int = RELAY_RULE[1],
               min_run: int = MIN_RELAY_RUN, slice_segments: int = SLICE_SEGMENTS, slices: int | None = None,
               slice_runs: int = SLICE_RUNS) -> DataFrame:
    """Sliced segments -> runs (head included) re-laid by dwell;
    ``(id, _rb, run, ord, stime, site, etime)`` with ``_rb`` the block of ``slice_runs`` run keys."""
    stats = run_stats(segments, dur, gap, True, slice_segments, slices, slice_runs)
    if slices:
        return relay_from_stats(stats, ["run"], min_run, slices).withColumn("_rb", rank_chunk("run", slice_runs))
    return relay_from_stats(stats, ["_rb", "run"], min_run)


def remerge_relaid(relaid: DataFrame, gap: int = DWELL_GAP) -> DataFrame:
    """Re-merge re-laid slices in ``(run, ord)`` order, in the blocks ``_rb`` that :func:`relay_runs` made."""
    return remerge(relaid, ["run", "ord"], "_rb", gap)


def trace_split_excl(points: DataFrame, slice_seconds: int = DAY_SLICE,
                     slice_segments: int = SLICE_SEGMENTS, slices: int | None = None) -> DataFrame:
    segs = sliced_point_segments(points, slice_seconds, slice_segments, halo=True, slices=slices)
    return dedupe_segments(split_runs(segs, *SPLIT_RULE, head_included=False, slice_segments=slice_segments, slices=slices))


def trace_split_incl(points: DataFrame, slice_seconds: int = DAY_SLICE,
                     slice_segments: int = SLICE_SEGMENTS, slices: int | None = None) -> DataFrame:
    segs = sliced_point_segments(points, slice_seconds, slice_segments, halo=True, slices=slices)
    return dedupe_segments(split_runs(segs, *SPLIT_RULE_TIGHT, head_included=True, slice_segments=slice_segments, slices=slices))


def trace_relay(points: DataFrame, slice_seconds: int = DAY_SLICE, slice_segments: int = SLICE_SEGMENTS,
                slice_runs: int = SLICE_RUNS, slices: int | None = None) -> DataFrame:
    segs = sliced_point_segments(points, slice_seconds, slice_segments, halo=True, slices=slices)
    return remerge_relaid(relay_runs(segs, *RELAY_RULE, slice_segments=slice_segments, slices=slices, slice_runs=slice_runs))


def trace_interval(intervals: DataFrame, slices: int | None = None, slice_segments: int = SLICE_SEGMENTS) -> DataFrame:
    """Copies of an inverted interval are left out of the walk: such a row is never short, so each copy
    would stand alone and the output drops duplicates."""
    segs = sliced_segments(interval_segments(intervals, slices=slices, copies=False), slice_segments, halo=True)
    return dedupe_segments(split_runs(segs, *SPLIT_RULE_TIGHT, head_included=False, slice_segments=slice_segments, slices=slices))


__all__ = ["SLICE_SEGMENTS", "relay_runs", "remerge_relaid", "run_stats", "sliced_point_segments", "sliced_segments",
           "split_runs", "trace_interval", "trace_relay", "trace_split_excl", "trace_split_incl"]
