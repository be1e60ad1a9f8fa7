"""Skew-tolerant ordered walks per id.

The original job walks each id's whole, time-sorted list in one task
(``groupByKey`` then a loop).  On Spark the obvious rewrite,
``Window.partitionBy(id)``, has the same flaw: one id that holds a third of
all rows is sorted and scanned by one task.

Every walk here runs over bounded *slices* ``(id, chunk)`` -- a chunk column
that does not decrease along the walk order, e.g. the day of an event or
``(rank - 1) div K`` -- so a hot id is spread over many tasks.  Two forms:

``halo_walk`` + ``number_parts``
    For rules with a bounded look-back.  The rows a slice's first row can
    depend on (its *halo*) are copied into that slice in the same pass; one
    sorted window pass per slice then decides every break.  Blocks are
    summarized into per-slice parts, and ``number_parts`` gives them dense
    per-id numbers from a window per id over slices only; where only the
    order matters, ``key_parts`` gives sparse ones without joining most parts.

``range_slices`` + a per-slice summary (``segments.interval_segments``, ``merge.remerge``)
    For rules whose look-back has no bound.  Slices are cut by a range
    partitioning over the whole order, so they hold about as many rows each
    whatever an id, a day or a second holds.  One sorted window pass per
    slice decides the breaks inside it; whether a slice's first row breaks
    from the last row before it is decided on one row per slice.

Both equal a single ordered walk over the whole id: block numbers are
1-based and dense per id.  ``running_total`` is the same idea for a running
sum.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Row = Mapping[str, Column]
BreakRule = Callable[[Row, Row], Column]


def _rows(cols: Sequence[str], get: Callable[[str], Column]) -> dict[str, Column]:
    return {c: get(c) for c in cols}


def _keys_present(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows with a null key are dropped (they cannot be walked); stating it
    once here also tells the optimizer, so later joins add no filters."""
    cond = None
    for k in key:
        e = F.col(k).isNotNull()
        cond = e if cond is None else cond & e
    return df.where(cond)


def join_on_slice(rows: DataFrame, summary: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Join a per-slice summary back to the slice's rows on plain equality.

    Keys are never null here (ids are filtered before every walk and slice
    numbers are built non-nullable), so the optimizer infers no ``isnotnull``
    filter that would reach only one of the two branches reading the same
    input -- that would stop them sharing its shuffle.  Plain keys also keep
    the row side's ``(id, slice)`` partitioning usable by a sort-merge join
    when the summary is too large to broadcast.
    """
    s = summary.select(*[F.col(c).alias(f"_s_{c}") for c in cols],
                       *[c for c in summary.columns if c not in cols])
    cond = None
    for c in cols:
        e = rows[c] == s[f"_s_{c}"]
        cond = e if cond is None else cond & e
    return rows.join(s, on=cond, how="inner").drop(*[f"_s_{c}" for c in cols])


def day_chunk(seconds_col: str, width: int = 86400) -> Column:
    """Slice key for time-ordered scans: the ``width``-second bucket of a time.

    After exact duplicates are folded, a one-day slice of one id holds at most
    86,400 distinct seconds times the sites seen in one second.
    """
    c = F.col(seconds_col).cast("long")
    return F.coalesce(((c - F.pmod(c, F.lit(width))) / F.lit(width)).cast("long"), F.lit(0).cast("long"))


#: Slices made by ``range_slices`` for each shuffle partition: hashing this many evens tasks out.
SLICES_PER_TASK = 8


def range_slices(df: DataFrame, order: Sequence[str], out: str = "_chunk", slices: int | None = None) -> DataFrame:
    """Add a slice key that rises along ``order`` within each id and has about equal numbers of rows:
    the partition of a range partitioning over ``(id, *order)``, whose bounds Spark samples."""
    n = slices or SLICES_PER_TASK * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, "id", *order).withColumn(out, F.spark_partition_id().cast("long"))


def slice_offsets(ends: DataFrame, chunk: str, local: str, breaks: BreakRule, before: Sequence[str],
                  after: Sequence[str]) -> DataFrame:
    """``_s_id``, ``_s_chunk``, ``_fb`` (1 if the slice's first row breaks from the row before it) and
    ``_off`` (blocks opened in earlier slices), from each slice's first and last part (``_first``; ``_n``:
    on the last part the blocks opened inside the slice, else 0): one window per id over two rows a slice."""
    ws = Window.partitionBy("id").orderBy(chunk, local)
    prev = {c: F.lag(c).over(ws) for c in before}
    opens = F.when(F.lag(F.lit(1)).over(ws).isNull(), F.lit(True)).otherwise(
        F.coalesce(breaks(prev, {c: F.col(c) for c in after}), F.lit(True)))
    rows = ends.select("*", F.when(F.col("_first"), opens.cast("long")).otherwise(0).alias("_fb"))
    total = F.sum(F.col("_fb") + F.col("_n")).over(ws.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.select("*", (total - F.col("_fb") - F.col("_n")).alias("_off"))
    return rows.where("_first").select(F.col("id").alias("_s_id"), F.col(chunk).alias("_s_chunk"), "_fb", "_off")


def rank_chunk(rank_col: str, size: int) -> Column:
    """Slice key for scans over a dense 1-based rank: exactly ``size`` rows per slice."""
    return F.coalesce(((F.col(rank_col).cast("long") - 1) / F.lit(size)).cast("long"), F.lit(0).cast("long"))


def running_total(df: DataFrame, key: Sequence[str], chunk: str, order: Sequence[str], value: str,
                  out: str) -> DataFrame:
    """Running sum of ``value`` per ``key`` in ``order``, computed per slice.

    Slice totals come from a hash aggregate of the input (no sort), their
    offsets from a window per key over slices only, then one join back on the
    slice key.
    """
    key = list(key)
    df = _keys_present(df, key)
    w = Window.partitionBy(*key, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding,
                                                                   Window.currentRow)
    staged = df.withColumn("_ls", F.sum(value).over(w))
    totals = df.groupBy(*key, chunk).agg(F.sum(value).alias("_tot"))
    ws = Window.partitionBy(*key).orderBy(chunk).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = totals.select(*key, chunk, (F.sum("_tot").over(ws) - F.col("_tot")).alias("_off"))
    joined = join_on_slice(staged, offsets, [*key, chunk])
    return joined.select(*[staged[c] for c in df.columns], (F.col("_off") + F.col("_ls")).alias(out))


def with_halo(df: DataFrame, chunk: str, in_halo: Column, flag: str = "_halo") -> DataFrame:
    """Rows for which ``in_halo`` holds are emitted twice: in their own slice
    and, flagged read-only, in slice ``chunk + 1``.  One pass (``explode``),
    no union, so the input is read once."""
    own = F.struct(F.col(chunk).alias("c"), F.lit(False).alias("h"))
    copy = F.struct((F.col(chunk) + 1).alias("c"), F.lit(True).alias("h"))
    others = [c for c in df.columns if c != chunk]
    return (df.select(*others, F.explode(F.when(in_halo, F.array(own, copy)).otherwise(F.array(own))).alias("_s"))
            .select(*others, F.col("_s.c").alias(chunk), F.col("_s.h").alias(flag)))


def halo_walk(df: DataFrame, key: Sequence[str], chunk: str, order: Sequence[str], in_halo: Column | None,
              carry: Sequence[str], breaks: BreakRule, out: str, halo_flag: str | None = None) -> DataFrame:
    """One sorted pass per slice for rules with a bounded look-back.

    Rows for which ``in_halo`` holds are also emitted, read-only, into slice
    ``chunk + 1`` (or the input already carries such copies, flagged by the
    boolean column ``halo_flag``).  The caller guarantees that whenever a
    slice's first row depends on the previous slice, the row it depends on is
    in that halo (for a dense rank sliced in blocks, the block's last row; for
    a time gap rule, the last ``gap`` seconds of the slice).  Every break is
    then decided inside one window pass; no summary is joined back to rows.

    Returns the slice's own rows with ``opens`` (bool) and ``out`` = number of
    blocks opened so far inside the slice (0 = rows that continue the block
    open at the end of the previous slice).  :func:`number_parts` turns
    per-slice parts into dense per-key numbers.
    """
    key = list(key)
    carry = list(carry)
    df = _keys_present(df, key)
    if halo_flag is None:
        rows, halo_flag = with_halo(df, chunk, in_halo), "_halo"
    else:
        rows = df
    w = Window.partitionBy(*key, chunk).orderBy(*order)
    prev = _rows(carry, lambda c: F.lag(c).over(w))
    first = F.lag(F.lit(1)).over(w).isNull()
    opens = F.when(first, F.lit(True)).otherwise(F.coalesce(breaks(prev, _rows(carry, F.col)), F.lit(True)))
    walked = rows.select("*", opens.alias("opens")).where(~F.col(halo_flag)).drop(halo_flag)
    return walked.withColumn(out, F.sum(F.col("opens").cast("long")).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def number_parts(parts: DataFrame, key: Sequence[str], chunk: str, local: str, out: str,
                 last: str | None = None) -> DataFrame:
    """Dense per-key numbers for per-slice parts: ``out = local + (blocks
    opened in earlier slices)``.

    ``last`` names a flag of each slice's last part, if the walk has set one.
    ``parts`` is read twice: for the per-slice maxima and for the parts
    themselves.  When it is a written table (``plans/stage.py``) both reads
    are scans.  Otherwise Spark runs the sorted pass that produced the parts
    once per reader -- a second sort of bounded slices, but no extra shuffle,
    since both readers share the walk's input exchange.  At small sizes that
    is cheaper than writing a table, and the pipelines write only the larger
    boundaries.  The offsets come from a window per key over slices only and
    are joined back on plain ``(key, chunk)`` keys.
    """
    key = list(key)
    parts = _keys_present(parts, key)
    if last is None:
        per_slice = parts.groupBy(*key, chunk).agg(F.max(local).alias("_n"))
    else:  # the slice's last part has the largest number: no aggregate, no shuffle by slice
        per_slice = parts.where(F.col(last)).select(*key, chunk, F.col(local).alias("_n"))
    ws = Window.partitionBy(*key).orderBy(chunk).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = per_slice.select(*key, chunk, (F.sum("_n").over(ws) - F.col("_n")).alias("_off"))
    joined = join_on_slice(parts, offsets, [*key, chunk])
    return joined.select(*[parts[c] for c in parts.columns], (F.col("_off") + parts[local]).alias(out))


def key_parts(parts: DataFrame, key: Sequence[str], chunk: str, local: str, out: str, size: int, last: str) -> DataFrame:
    """Sparse per-key numbers for per-slice parts, in the order of the dense ones.

    A block is named by the slice where it opens and its place there,
    ``chunk * size + local`` (a slice opens at most ``size`` blocks), so most parts
    know their number without looking at any other slice.  Only parts that
    continue an earlier slice (``local`` = 0) meet a summary, one row a slice with
    the newest number before it; the others are neither joined nor shuffled.
    ``last`` flags one part of each slice that holds its largest ``local``.
    ``parts`` should be a written table: it is scanned three times.
    """
    key = list(key)
    parts = _keys_present(parts, key)
    number = F.col(chunk) * F.lit(size).cast("long") + F.col(local)
    slices = parts.where(F.col(last)).select(*key, chunk, F.when(F.col(local) > 0, number).alias("_n"))
    earlier = Window.partitionBy(*key).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    newest = slices.select(*key, chunk, F.max("_n").over(earlier).alias("_before"))
    going_on = parts.where(F.col(local) == 0)
    joined = join_on_slice(going_on, newest, [*key, chunk])
    joined = joined.select(*[going_on[c] for c in parts.columns], F.col("_before").alias(out))
    return parts.where(F.col(local) > 0).withColumn(out, number).unionByName(joined)
