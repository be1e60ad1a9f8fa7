"""Re-merge and de-duplication of output segments.

``remerge``: walk rows in a given order per id; a row joins the current
segment when its site equals the segment's ignoring case and its *end* is less
than ``gap`` seconds after the previous row's end (end-to-end, unlike the
start-to-end rule of :func:`segments.dwell_segments`).  Start and site come
from the first row, end from the last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import same_site
from ..plans.stage import materialize
from .segments import DWELL_GAP


def remerge(rows: DataFrame, order: Sequence[str], chunk: str, gap: int = DWELL_GAP) -> DataFrame:
    """``(id, *order, stime, site, etime, chunk)`` -> ``(id, stime, site, etime)``.

    ``order`` is a total order per id and ``chunk`` a slice key that does not
    decrease along it.  One sorted pass per slice finds the merges *inside*
    the slice and reads parts off the ordered rows; the parts are written.
    Only a slice's first and last part can be a piece of a longer segment: they
    alone are walked again, in one window per id over two rows a slice, and
    merged on the same partitioning.  All other parts stay where they lie.
    """
    order = list(order)

    def breaks(prev, cur):
        return ~same_site(cur["site"], prev["site"]) | (cur["etime"] - prev["etime"] >= gap)

    rows = rows.where(F.col("id").isNotNull())
    w = Window.partitionBy("id", chunk).orderBy(*order)
    first = F.lag(F.lit(1)).over(w).isNull()
    prev = {"site": F.lag("site").over(w), "etime": F.lag("etime").over(w)}
    opens = first | F.coalesce(breaks(prev, {"site": F.col("site"), "etime": F.col("etime")}), F.lit(True))
    walked = rows.select("*", first.alias("_first"), opens.alias("_opens"))
    walked = walked.select("*", F.coalesce(F.lead("_opens").over(w), F.lit(True)).alias("_last"))
    edges = walked.where(F.col("_opens") | F.col("_last"))
    edges = edges.select("*", F.lead("etime").over(w).alias("_next_etime"))
    parts = edges.where("_opens").select(
        "id", F.col(chunk).alias("_c"), "stime", "site", F.col("etime").alias("_hetime"),
        F.when(F.col("_last"), F.col("etime")).otherwise(F.col("_next_etime")).alias("etime"),
        "_first", F.lead(F.lit(1)).over(w).isNull().alias("_end"))
    parts = materialize(parts, "remerge-parts")

    border = F.col("_first") | F.col("_end")
    # A slice's first part follows the previous slice's last part (rows of a part share the site up to
    # case; ``etime`` is its last end, ``_hetime`` its first row's); a last part that is not also the first opened there.
    ws = Window.partitionBy("id").orderBy("_c", F.col("_first").desc())
    prev = {"site": F.lag("site").over(ws), "etime": F.lag("etime").over(ws)}
    continues = F.coalesce(F.col("_first") & ~breaks(prev, {"site": F.col("site"), "etime": F.col("_hetime")}), F.lit(False))
    ends = parts.where(border).select("id", "_c", "stime", "site", "etime", (~continues).cast("long").alias("_new"), "_first")
    upto = ws.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = ends.withColumn("_m", F.sum("_new").over(upto)).groupBy("id", "_m").agg(
        F.min_by("stime", "_c").alias("stime"), F.min_by("site", "_c").alias("site"), F.max_by("etime", "_c").alias("etime"))
    return parts.where(~border).select("id", "stime", "site", "etime").unionByName(merged.drop("_m"))


def dedupe_segments(df: DataFrame) -> DataFrame:
    """Exact duplicates of ``(id, stime, site, etime)`` removed (a partial
    aggregate: duplicates fold map-side before the shuffle)."""
    return df.select("id", "stime", "site", "etime").distinct()
