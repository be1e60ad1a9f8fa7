"""Dwell segments: "id was at site from stime to etime".

``dwell_segments`` (from point events) and ``interval_segments`` (from
intervals) walk each id's events in time order; a row extends the current
segment when its site equals the segment's site ignoring case and the gap is
below ``gap`` seconds, otherwise it opens a new segment.

Both fold exact duplicate rows first (a partial aggregate, combined map-side):
a duplicate always extends the segment it follows, so the result is unchanged,
and a hot id's raw rows collapse to its distinct seconds before any shuffle by
id.  Points are walked by :func:`sequence.halo_walk` over one-day slices (a
silence of ``gap`` always breaks, so only a slice's last ``gap`` seconds reach
the next); intervals, whose previous end can reach arbitrarily far, over
:func:`sequence.range_slices` with a per-slice summary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import same_site
from ..plans.stage import materialize
from .sequence import day_chunk, halo_walk, number_parts, range_slices, slice_offsets

# Fixed value: two hours of silence (or a site change) ends a stay.
DWELL_GAP = 7200
DAY_SLICE = 86400


def dwell_segments(points: DataFrame, gap: int = DWELL_GAP, slice_seconds: int = DAY_SLICE,
                   slices: int | None = None) -> DataFrame:
    """Points ``(id, t, site)`` -> segments ``(id, seg, stime, site, etime)``.

    Order within an id is ``(t, site)``; the label is the first event's site
    text, ``etime`` the last event's time.  ``seg`` is dense per id from 1.
    With ``slices`` the walk runs over that many slices of about equal numbers
    of points instead of over time slices (:func:`even_dwell_segments`).
    """
    if slices:
        return even_dwell_segments(points, gap, slices)
    parts = materialize(dwell_segment_parts(points, gap, slice_seconds), "segment-parts")
    numbered = number_segment_parts(parts)
    # Only a slice's last part, and a part that continues an earlier slice, can belong to a segment of
    # several parts; the others are segments as they stand and are not shuffled again.
    border = (F.col("lseg") == 0) | F.col("_end")
    inner = numbered.where(~border).select("id", "seg", F.col("head.t").alias("stime"), F.col("head.site").alias("site"), "etime")
    return inner.unionByName(merge_segment_parts(numbered.where(border)))


def even_dwell_segments(points: DataFrame, gap: int = DWELL_GAP, slices: int | None = None) -> DataFrame:
    """:func:`dwell_segments` over range slices: for ids with very many points in a day, or sites in a
    second, where a time slice of one id would be one task's work.

    A point is an interval without length, and the rule is the same (gap from the previous row's end, same
    site ignoring case), so the walk is that of :func:`interval_segments`: breaks inside a slice in one
    sorted pass, a slice's first row from a summary of two rows a slice, however many slices two hours of
    one id span.  The range bounds are sampled, which reads the points once more than the time slices do.
    """
    flat = points.select("id", F.col("t").alias("stime"), "site", F.col("t").alias("etime"))
    return interval_segments(flat, gap, slices, copies=False)


def _folded_points(points: DataFrame, slice_seconds: int) -> DataFrame:
    return (points.select("id", "t", "site")
            .where(F.col("id").isNotNull() & F.col("t").isNotNull() & F.col("site").isNotNull())
            .distinct()
            .withColumn("_chunk", day_chunk("t", slice_seconds)))


def dwell_segment_parts(points: DataFrame, gap: int = DWELL_GAP, slice_seconds: int = DAY_SLICE) -> DataFrame:
    """The walk of :func:`dwell_segments` summarized per slice:
    ``(id, _chunk, lseg, head, etime, _end)``, grouped on the walk's own partitioning.

    ``lseg`` counts the segments that start inside the slice (0 = rows that
    continue the segment open at the end of the previous slice); a segment
    that spans slices has one part per slice.  :func:`number_segment_parts`
    gives every part its dense segment number.

    Only the last ``gap`` seconds of a slice can influence the next one (a longer
    silence always breaks), so those rows are the halo of
    :func:`sequence.halo_walk` and one sorted pass per slice decides every
    break.  Slices are therefore at least ``gap`` seconds wide.
    """
    slice_seconds = max(slice_seconds, gap)
    pts = _folded_points(points, slice_seconds)

    def breaks(prev, cur):
        return ~same_site(cur["site"], prev["site"]) | (cur["t"] - prev["t"] >= gap)

    width = F.lit(slice_seconds).cast("long")
    tail = (F.col("t") - F.col("_chunk") * width) >= (width - gap)
    walked = halo_walk(pts, ["id"], "_chunk", ["t", "site"], tail, ["t", "site"], breaks, out="lseg")
    # Parts straight from the ordered rows, no aggregate (a struct minimum
    # would need a sort-based aggregate, i.e. a second sort of every row): a
    # part's head is the row that opens it (or the slice's first row), its
    # end the t of the row before the next head.  These windows reuse the
    # walk's order, so no sort is added.
    w = Window.partitionBy("id", "_chunk").orderBy("t", "site")
    edges = walked.select(
        "*",
        F.lag(F.lit(1)).over(w).isNull().alias("_first"),
        F.coalesce(F.lead("opens").over(w), F.lit(True)).alias("_last"),
    ).where(F.col("opens") | F.col("_first") | F.col("_last"))
    edges = edges.select("*", F.lead("t").over(w).alias("_next_t"))
    heads = edges.where(F.col("opens") | F.col("_first"))
    return heads.select(
        "id", "_chunk", "lseg", F.struct("t", "site").alias("head"),
        F.when(F.col("_last"), F.col("t")).otherwise(F.col("_next_t")).alias("etime"),
        F.lead(F.lit(1)).over(w).isNull().alias("_end"),
    )


def number_segment_parts(parts: DataFrame) -> DataFrame:
    """Add the dense per-id segment number ``seg`` to segment parts."""
    return number_parts(parts, ["id"], "_chunk", "lseg", "seg", last="_end")


def merge_segment_parts(parts: DataFrame, slice_keys: tuple[str, ...] = (),
                        trailing_keys: tuple[str, ...] = ()) -> DataFrame:
    """Numbered parts -> segments ``(id, seg, stime, site, etime)``.

    Grouped by ``(id, *slice_keys, seg, *trailing_keys)`` -- the extra keys
    must be functions of ``(id, seg)`` or flags.  Keys in this order leave the
    rows sorted by ``(id, slice, seg)``, which is exactly the order the run
    walk needs next, so it adds no sort of its own."""
    head = F.min("head")
    return parts.groupBy("id", *slice_keys, "seg", *trailing_keys).agg(
        head["t"].alias("stime"), head["site"].alias("site"), F.max("etime").alias("etime"))


def interval_segments(intervals: DataFrame, gap: int = DWELL_GAP, slices: int | None = None,
                      copies: bool = True) -> DataFrame:
    """Intervals ``(id, stime, site, etime)`` -> segments ``(id, seg, stime, site, etime)``
    (see :func:`interval_segment_parts`).  Without ``copies`` the repeated copies of an
    inverted interval, which are segments of their own, are left out and not numbered."""
    parts = materialize(interval_segment_parts(intervals, gap, slices, copies), "interval-parts")
    segments = number_interval_parts(parts, gap)
    return expand_copies(segments) if copies else segments.select("id", "seg", "stime", "site", "etime")


def interval_segment_parts(intervals: DataFrame, gap: int = DWELL_GAP, slices: int | None = None,
                           copies: bool = True) -> DataFrame:
    """The walk of :func:`interval_segments`, summarized per slice:
    ``(id, _chunk, lseg, stime, site, etime, last)``.

    The gap is measured from the previous row's ``etime`` (it may be
    negative); the segment's ``etime`` is its *last* row's, not the largest.
    Order within an id is ``(stime, site, etime)``.

    A duplicate row merges into its twin unless ``stime - etime >= gap`` (an
    inverted interval): then every copy after the first is a segment of its
    own, and the row that follows breaks too, since it starts no earlier.  Such
    copies are carried as a number (``last.extra`` of the part they follow),
    never as rows.

    The previous row's end can lie arbitrarily far back, so no halo bounds the
    look-back.  Slices come from :func:`sequence.range_slices`; one sorted pass
    per slice finds the breaks *inside* it (``lseg`` counts them) and reads
    parts off the ordered rows.  Whether a slice's first row breaks from the
    last row of the previous slice is answered later on a per-slice summary of
    the written parts (:func:`number_interval_parts`).
    """
    rows = intervals.select("id", "stime", "site", "etime").where(
        F.col("id").isNotNull() & F.col("stime").isNotNull() & F.col("site").isNotNull()
        & F.col("etime").isNotNull())
    order = ["stime", "site", "etime"]
    counted = rows.groupBy("id", *order).agg(F.count(F.lit(1)).alias("_n"))
    extra = F.when((F.col("stime") - F.col("etime") >= gap) & F.lit(copies), F.col("_n") - 1).otherwise(F.lit(0).cast("long"))
    rows = range_slices(counted.select("id", *order, extra.alias("extra")), order, slices=slices)

    def breaks(prev, cur):
        return ~same_site(cur["site"], prev["site"]) | (cur["stime"] - prev["etime"] >= gap)

    w = Window.partitionBy("id", "_chunk").orderBy(*order)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prev = {"site": F.lag("site").over(w), "etime": F.lag("etime").over(w)}
    first = F.lag(F.lit(1)).over(w).isNull()
    inner = F.when(first, F.lit(False)).otherwise(
        F.coalesce(breaks(prev, {"site": F.col("site"), "stime": F.col("stime")}), F.lit(True)))
    row_end = F.struct("stime", "site", "etime", "extra")
    walked = rows.select("*", first.alias("_first"), inner.alias("_inner"))
    walked = walked.select("*", (F.sum(F.col("_inner").cast("long") + F.col("extra")).over(running) - F.col("extra")).alias("lseg"),
                           F.coalesce(F.lead("_inner").over(w), F.lit(True)).alias("_last"))
    edges = walked.where(F.col("_first") | F.col("_inner") | F.col("_last"))
    edges = edges.select("*", F.lead(row_end).over(w).alias("_next_end"))
    return edges.where(F.col("_first") | F.col("_inner")).select(
        "id", "_chunk", "lseg", "stime", "site",
        F.when(F.col("_last"), row_end).otherwise(F.col("_next_end")).alias("last"),
        "_first", F.lead(F.lit(1)).over(w).isNull().alias("_end")).withColumn("etime", F.col("last.etime"))


def number_interval_parts(parts: DataFrame, gap: int = DWELL_GAP) -> DataFrame:
    """Segments ``(id, seg, stime, site, etime, last)`` from interval parts: decide each slice's first-row
    break on a per-slice summary and merge parts that continue across slices."""
    def breaks(prev, cur):
        return ~same_site(cur["site"], prev["site"]) | (cur["stime"] - prev["etime"] >= gap)

    # A slice's first part follows the previous slice's last part (all rows of a part share the site up to
    # case); the last part also tells how many segments the slice has opened.
    ends = parts.where(F.col("_first") | F.col("_end")).select(
        "id", "_chunk", "lseg", "stime", "site", "etime", "_first",
        F.when(F.col("_end"), F.col("lseg") + F.col("last.extra")).otherwise(0).alias("_n"))
    per_slice = slice_offsets(ends, "_chunk", "lseg", breaks, ["site", "etime"], ["site", "stime"])
    numbered = parts.join(per_slice, (parts["id"] == per_slice["_s_id"]) & (parts["_chunk"] == per_slice["_s_chunk"]))
    numbered = numbered.select("id", "_chunk", (F.col("_off") + F.col("_fb") + F.col("lseg")).alias("seg"),
                               "stime", "site", "etime", "last", (F.col("_first") | F.col("_end")).alias("_border"))
    # Only a slice's first and last parts can belong to a segment of several parts.
    merged = numbered.where("_border").groupBy("id", "seg").agg(
        F.min_by("stime", "_chunk").alias("stime"),
        F.min_by("site", "_chunk").alias("site"),
        F.max_by("etime", "_chunk").alias("etime"),
        F.max_by("last", "_chunk").alias("last"),
    )
    return numbered.where("not _border").select("id", "seg", "stime", "site", "etime", "last").unionByName(merged)


# Longest stretch of copies made by a single task.
COPY_PIECE = 100_000


def expand_copies(segments: DataFrame, piece: int = COPY_PIECE) -> DataFrame:
    """Segments and, after each, the copies of the inverted interval it ends with; cut into pieces that
    are spread over tasks."""
    k = F.lit(piece).cast("long")
    zero, extra = F.lit(0).cast("long"), F.col("extra")
    flat = segments.select("id", "seg", "stime", "site", "etime", F.col("last.stime").alias("cstime"),
                           F.col("last.site").alias("csite"), F.col("last.extra").alias("extra"))
    pieces = (flat.select("*", F.explode(F.sequence(zero, F.ceil(extra / k).cast("long"))).alias("_p"))
              .repartition("id", "seg", "_p"))
    copy = F.explode(F.sequence(F.when(F.col("_p") == 0, zero).otherwise((F.col("_p") - 1) * k + 1),
                                F.when(F.col("_p") == 0, zero).otherwise(F.least(F.col("_p") * k, extra))))
    own = F.col("_j") == 0
    return pieces.select("*", copy.alias("_j")).select(
        "id", (F.col("seg") + F.col("_j")).alias("seg"), F.when(own, F.col("stime")).otherwise(F.col("cstime")).alias("stime"),
        F.when(own, F.col("site")).otherwise(F.col("csite")).alias("site"), "etime")
