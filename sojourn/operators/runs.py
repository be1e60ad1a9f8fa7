"""Short-stay runs over an id's segments.

A segment is *short* when it is not the id's first, lasts less than ``dur``
seconds and starts less than ``gap`` seconds after the previous segment's end.

* head included: every non-short segment opens a run and the short ones that
  follow join it -> run key ``run``;
* head excluded: each non-short segment stands alone and each maximal block of
  short segments is a run -> run key ``(run, short)``.

Both are one running count of non-short segments; the walk is
:func:`sequence.halo_walk` over slices of ``SLICE_SEGMENTS`` consecutive
segments, so an id with billions of segments is still scanned in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.stage import materialize
from .sequence import halo_walk, key_parts, number_parts, rank_chunk
from .smoothing import site_stats

SLICE_SEGMENTS = 100_000

# The (duration, gap) pairs the original jobs use.
RELAY_RULE = (60, 180)          # re-lay job, head included
SPLIT_RULE = (300, 1800)        # split job, head excluded
SPLIT_RULE_TIGHT = (300, 300)   # second split variant and the interval job


def walk_runs(segments: DataFrame, dur: int, gap: int, slice_segments: int, chunk: str,
              halo_flag: str | None = None) -> DataFrame:
    """The run walk: the slice's own segments with ``short`` and ``lrun``, the runs opened so far inside
    the slice.  A segment's rule looks at the previous segment only, which for a slice's first row is
    the previous slice's last segment (``seg % slice_segments == 0``): that one row per slice border is
    the halo (already present when ``halo_flag`` names its flag column)."""
    def breaks(prev, cur):
        short = ((cur["etime"] - cur["stime"]) < dur) & ((cur["stime"] - prev["etime"]) < gap)
        return ~F.coalesce(short, F.lit(False))

    in_halo = (F.col("seg") % slice_segments) == 0
    walked = halo_walk(segments, ["id"], chunk, ["seg"], in_halo, ["stime", "etime"], breaks, out="lrun",
                       halo_flag=halo_flag)
    return walked.withColumn("short", ~F.col("opens")).drop("opens")


def mark_runs(segments: DataFrame, dur: int, gap: int, slice_segments: int = SLICE_SEGMENTS) -> DataFrame:
    """Segments ``(id, seg, stime, site, etime)`` with dense ``seg`` ->
    the same rows plus ``short`` (bool) and ``run`` (dense per id from 1)."""
    segs = segments.withColumn("_rc", rank_chunk("seg", slice_segments))
    walked = materialize(walk_runs(segs, dur, gap, slice_segments, "_rc"), "run-rows")
    return number_parts(walked, ["id"], "_rc", "lrun", "run").select(*segments.columns, "short", "run")


def run_key(head_included: bool) -> list[str]:
    return ["run"] if head_included else ["run", "short"]


def run_site_parts(segments: DataFrame, dur: int, gap: int, head_included: bool, slice_segments: int,
                   chunk: str = "_sc", halo_flag: str | None = None) -> DataFrame:
    """Runs marked and reduced to per-site statistics in one sorted pass.

    ``segments`` must be partitioned on ``(id, chunk)`` with
    ``chunk = rank_chunk(seg, slice_segments)`` (see :func:`walk_runs`).
    Statistics are kept per run *part* (a run that crosses slices has one part
    per slice); the parts are written, given their run's key and returned as
    ``(id, run[, short], site, cnt, m, d, fp, lp, first, last)`` for
    :func:`smoothing.merge_site_stats`.  ``run`` rises along an id's runs but is
    not dense: the slice and the place in it where the run opens
    (:func:`sequence.key_parts`), so ``rank_chunk(run, slice_segments)`` is that slice.
    """
    walked = walk_runs(segments, dur, gap, slice_segments, chunk, halo_flag)
    end = F.lead(F.lit(1)).over(Window.partitionBy("id", chunk).orderBy("seg")).isNull()
    parts = site_stats(walked.withColumn("_end", end), ["lrun"] if head_included else ["lrun", "short"], extra=[chunk],
                       flags=["_end"])
    # The keys read the parts twice: written once, the walk runs once.
    keyed = key_parts(materialize(parts, "run-parts"), ["id"], chunk, "lrun", "run", slice_segments, last="_end")
    return keyed.drop(chunk, "lrun", "_end")
