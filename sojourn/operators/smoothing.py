"""Smoothing a run of short stays.

Both operators reduce a run to per-``(run, site)`` aggregates first (partial
aggregation, so a run of any length costs one small row per site) and finish
with a window over the sites of one run -- bounded by the number of distinct
sites, never by the number of rows.  No row-level join back is needed.

A run over very many different sites is still one window.  ``slices=`` cuts the
sites of all runs into that many slices of equal size instead: each slice is
scanned on its own, and a slice's place in its run comes from the totals of
the slices before it -- of numbers of sites for the equal split, and of
``(sum, max-plus)`` pairs for the re-lay.  Both forms give the same rows.

``split_equal``  : the run's span, first start to last end, is cut into equal
                   slices, one per distinct site (case-sensitive) in first-seen
                   order; the step is the span integer-divided (toward zero) by
                   the number of sites and the remainder seconds are dropped.
                   A one-segment run comes out unchanged.
``relay_by_dwell``: runs of fewer than ``min_run`` segments pass through;
                   otherwise one slice per site carrying that site's total
                   dwell, sites ordered by their earliest start (ties: first
                   seen), each slice starting at the later of its own earliest
                   start and the previous slice's end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.stage import materialize
from .sequence import join_on_slice, range_slices

# Fixed value: runs shorter than this many segments are not re-laid.
MIN_RELAY_RUN = 3


def _site_aggregates() -> list:
    # Numeric buffers only (min_by/max_by keyed on seg instead of struct
    # minima), so Spark can hash-aggregate without sorting the rows.
    return [
        F.count(F.lit(1)).cast("long").alias("cnt"),
        F.min("stime").alias("m"),
        F.sum(F.col("etime") - F.col("stime")).cast("long").alias("d"),
        F.min("seg").alias("fp"),
        F.max("seg").alias("lp"),
        F.min_by("stime", "seg").alias("fs"),
        F.min_by("etime", "seg").alias("fe"),
        F.max_by("stime", "seg").alias("ls"),
        F.max_by("etime", "seg").alias("le"),
    ]


def site_stats(rows: DataFrame, key: Sequence[str], extra: Sequence[str] = (), flags: Sequence[str] = ()) -> DataFrame:
    """Per ``(id, *key, site)``: segment count ``cnt``, earliest start ``m``,
    total dwell ``d``, first/last segment number ``fp``/``lp`` and that
    segment's start/end (``fs``, ``fe`` / ``ls``, ``le``), and whether any row
    has each of ``flags``.  A partial aggregate (combined map-side)."""
    return rows.groupBy("id", *extra, *key, "site").agg(*_site_aggregates(), *[F.max(f).alias(f) for f in flags])


def merge_site_stats(parts: DataFrame, key: Sequence[str]) -> DataFrame:
    """Merge :func:`site_stats` computed on pieces of a run."""
    return parts.groupBy("id", *key, "site").agg(
        F.sum("cnt").cast("long").alias("cnt"), F.min("m").alias("m"), F.sum("d").cast("long").alias("d"),
        F.min("fp").alias("fp"), F.max("lp").alias("lp"),
        F.min_by("fs", "fp").alias("fs"), F.min_by("fe", "fp").alias("fe"),
        F.max_by("ls", "lp").alias("ls"), F.max_by("le", "lp").alias("le"))


def split_from_stats(stats: DataFrame, key: Sequence[str], slices: int | None = None) -> DataFrame:
    """Equal split from per-site statistics -> ``(id, *key, stime, site, etime)``."""
    k = ["id", *key]
    sized = _sized_in_slices(stats, k, slices) if slices else _sized(stats, k)
    step = F.expr("(hi - lo) div k")
    return sized.select(
        *k,
        (F.col("lo") + F.col("r") * step).alias("stime"),
        "site",
        (F.col("lo") + (F.col("r") + 1) * step).alias("etime"),
    )


def _sized(stats: DataFrame, k: Sequence[str]) -> DataFrame:
    """Each run's bounds ``lo`` and ``hi``, its sites ``k``, and the site's place ``r`` from 0."""
    seen = Window.partitionBy(*k).orderBy("fp")
    # Whole-run aggregates use the same order with a full frame: one sort serves both.
    whole = seen.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return stats.select(
        *k, "site",
        F.min_by("fs", "fp").over(whole).alias("lo"),
        F.max_by("le", "lp").over(whole).alias("hi"),
        F.count(F.lit(1)).over(whole).cast("long").alias("k"),
        (F.row_number().over(seen) - 1).cast("long").alias("r"),
    )


def _sized_in_slices(stats: DataFrame, k: Sequence[str], slices: int) -> DataFrame:
    """As :func:`_sized`, scanned slice by slice."""
    cut = range_slices(stats, [*k[1:], "fp"], slices=slices)
    local = F.row_number().over(Window.partitionBy(*k, "_chunk").orderBy("fp"))
    rows = materialize(cut.select(*k, "_chunk", "site", "fp", "fs", "lp", "le", local.cast("long").alias("r")), "split-slices")
    each = rows.groupBy(*k, "_chunk").agg(
        F.count(F.lit(1)).alias("c"), F.min("fp").alias("fp"), F.min_by("fs", "fp").alias("fs"),
        F.max("lp").alias("lp"), F.max_by("le", "lp").alias("le"))
    order = Window.partitionBy(*k).orderBy("_chunk")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    places = each.select(
        *k, "_chunk", F.min_by("fs", "fp").over(whole).alias("lo"), F.max_by("le", "lp").over(whole).alias("hi"),
        F.sum("c").over(whole).alias("k"),
        (F.sum("c").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("c")).alias("before"))
    met = join_on_slice(rows.select(*k, "_chunk", "site", "r"), places, [*k, "_chunk"])
    return met.select(*k, "site", "lo", "hi", "k", (F.col("before") + F.col("r") - 1).alias("r"))


def relay_from_stats(stats: DataFrame, key: Sequence[str] = ("run",), min_run: int = MIN_RELAY_RUN,
                     slices: int | None = None) -> DataFrame:
    """Re-lay from per-site statistics -> ``(id, *key, ord, stime, site, etime)``.

    ``ord`` orders the output inside its run: the slice position for re-laid
    runs, the segment number for runs passed through.

    The chain ``end_k = max(end_{k-1}, m_k) + d_k`` (with ``end_0 = m_1``) has
    the closed form ``end_k = S_k + max_{j<=k}(m_j - S_{j-1})`` where ``S`` is
    the running total dwell, i.e. two running windows.
    """
    k = ["id", *key]
    staged = _laid_in_slices(stats, k, slices) if slices else _laid(stats, k)

    def piece(order, start, end):
        return F.struct(order.cast("long").alias("ord"), start.cast("long").alias("stime"),
                        end.cast("long").alias("etime"))

    relaid = F.array(piece(F.col("pos"), F.col("X") - F.col("d"), F.col("X")))
    first = piece(F.col("fp"), F.col("fs"), F.col("fe"))
    last = piece(F.col("lp"), F.col("ls"), F.col("le"))
    kept = F.when(F.col("cnt") >= 2, F.array(first, last)).otherwise(F.array(first))
    out = staged.select(*k, "site", F.explode(F.when(F.col("n") >= min_run, relaid).otherwise(kept)).alias("p"))
    return out.select(*k, F.col("p.ord").alias("ord"), F.col("p.stime").alias("stime"), "site",
                      F.col("p.etime").alias("etime"))


_STATS = ("site", "cnt", "m", "d", "fp", "fs", "fe", "lp", "ls", "le")


def _laid(stats: DataFrame, k: Sequence[str]) -> DataFrame:
    """The statistics with the run's segments ``n``, the site's place ``pos`` from 1 and its end ``X``."""
    ordered = Window.partitionBy(*k).orderBy("m", "fp")
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Whole-run total with the same order and a full frame: one sort serves both.
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    staged = stats.select(
        *k, *_STATS,
        F.sum("cnt").over(whole).alias("n"),
        F.row_number().over(ordered).cast("long").alias("pos"),
        F.sum("d").over(upto).alias("S"),
    )
    return staged.withColumn("X", F.col("S") + F.max(F.col("m") - (F.col("S") - F.col("d"))).over(upto))


def _laid_in_slices(stats: DataFrame, k: Sequence[str], slices: int) -> DataFrame:
    """As :func:`_laid`, scanned slice by slice.

    A slice that follows a total dwell of ``off`` adds ``off`` to each of its
    sums, so its local maxima of ``m_j - S_{j-1}`` count less by ``off``; what
    it takes over from earlier slices is that pair (sum, largest start).
    """
    cut = range_slices(stats, [*k[1:], "m", "fp"], slices=slices)
    inside = Window.partitionBy(*k, "_chunk").orderBy("m", "fp")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = cut.select(*k, "_chunk", *_STATS, F.row_number().over(inside).cast("long").alias("pos"),
                        F.sum("d").over(upto).alias("S"))
    rows = materialize(summed.withColumn("M", F.max(F.col("m") - (F.col("S") - F.col("d"))).over(upto)), "relay-slices")
    each = rows.groupBy(*k, "_chunk").agg(F.count(F.lit(1)).alias("c"), F.sum("cnt").alias("n"), F.sum("d").alias("d"),
                                          F.max("M").alias("M"))
    order = Window.partitionBy(*k).orderBy("_chunk")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = each.select(
        *k, "_chunk", "M", F.sum("n").over(whole).alias("n"),
        (F.sum("c").over(so_far) - F.col("c")).alias("before"), (F.sum("d").over(so_far) - F.col("d")).alias("off"))
    carried = F.max(F.col("M") - F.col("off")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    met = join_on_slice(rows, sums.select(*k, "_chunk", "n", "before", "off", carried.alias("carried")), [*k, "_chunk"])
    # greatest() passes over the null that a run's first slice takes over
    end = F.col("off") + F.col("S") + F.greatest("carried", F.col("M") - F.col("off"))
    return met.select(*k, *_STATS, "n", (F.col("before") + F.col("pos")).alias("pos"), end.alias("X"))


def split_equal(rows: DataFrame, key: Sequence[str], slices: int | None = None) -> DataFrame:
    """``(id, seg, stime, site, etime, *key)`` -> ``(id, *key, stime, site, etime)``."""
    return split_from_stats(site_stats(rows, key), key, slices)


def relay_by_dwell(rows: DataFrame, key: Sequence[str] = ("run",), min_run: int = MIN_RELAY_RUN,
                   slices: int | None = None) -> DataFrame:
    """``(id, seg, stime, site, etime, *key)`` -> ``(id, *key, ord, stime, site, etime)``."""
    return relay_from_stats(site_stats(rows, key), key, min_run, slices)
