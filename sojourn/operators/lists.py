"""Per-id event lists, kept flat.

The original groups each id's events into one in-memory list sorted by time.
Here the list is a table: every distinct ``(id, t, site)`` carries its
multiplicity ``n`` and the position ``pos`` of its first copy in the id's
time-ordered list (1-based).  No array ever holds a whole id, and the
positions are a sliced running total (``sequence.running_total``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sequence import day_chunk, running_total

# Longest stretch of copies of one event expanded by a single task.
EXPAND_PIECE = 1_000_000


def events_per_id(points: DataFrame, slice_seconds: int = 86400) -> DataFrame:
    """Points ``(id, t, site)`` -> ``(id, pos, t, site, n)``; order is ``(t, site)``."""
    counted = (points.select("id", "t", "site")
               .where(F.col("id").isNotNull() & F.col("t").isNotNull() & F.col("site").isNotNull())
               .groupBy("id", "t", "site").agg(F.count(F.lit(1)).cast("long").alias("n"))
               .withColumn("_chunk", day_chunk("t", slice_seconds)))
    ranked = running_total(counted, ["id"], "_chunk", ["t", "site"], "n", "_end")
    return ranked.select("id", (F.col("_end") - F.col("n") + 1).alias("pos"), "t", "site", "n")


def flatten_events(listed: DataFrame, piece: int = EXPAND_PIECE) -> DataFrame:
    """``(id, pos, t, site, n)`` -> one row per event ``(id, pos, t, site)``.

    Every entry is cut into pieces of at most ``piece`` copies, the pieces are
    spread over tasks and then expanded, so no task expands an unbounded entry.
    """
    k = F.lit(piece).cast("long")
    last = F.floor((F.col("n") - 1) / k).cast("long")
    pieces = (listed.select("id", "t", "site", "pos", "n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_p"))
              .select("id", "t", "site", (F.col("pos") + F.col("_p") * k).alias("pos"),
                      F.least(k, F.col("n") - F.col("_p") * k).alias("n"))
              .repartition("id", "pos"))
    return pieces.select("id", F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("n") - 1)).alias("pos"), "t", "site")
