"""Bounded scans of an event log.

A job reads one time slice ``[start, end)`` (or ``[start, end]``) of a table
partitioned by day.  Every predicate here is a plain comparison or ``IN`` on a
scanned column, so Catalyst turns the day test into partition pruning and the
time test into a Parquet pushed filter.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import day_of_epoch


def days_between(start: int, end: int) -> list[str]:
    """``yyyyMMdd`` of every UTC day from ``start``'s to ``end``'s, both included."""
    first = _dt.datetime.strptime(day_of_epoch(start), "%Y%m%d")
    last = _dt.datetime.strptime(day_of_epoch(end), "%Y%m%d")
    out = []
    while first <= last:
        out.append(first.strftime("%Y%m%d"))
        first += _dt.timedelta(days=1)
    return out


def range_predicate(time_col: str | Column, start: int, end: int, inclusive_end: bool = False) -> Column:
    t = F.col(time_col) if isinstance(time_col, str) else time_col
    upper = t <= F.lit(end) if inclusive_end else t < F.lit(end)
    return (t >= F.lit(start)) & upper


def scan_range(df: DataFrame, time_col: str, start: int, end: int, inclusive_end: bool = False,
               day_col: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """Rows with ``start <= time < end`` (``<= end`` when ``inclusive_end``).

    With ``day_col`` exactly the day partitions that the range touches are
    selected: from ``start``'s day to that of the range's last second.
    """
    if start >= end:
        raise ValueError("end must be greater than start")
    cond = range_predicate(time_col, start, end, inclusive_end)
    if day_col is not None:
        days = days_between(start, end if inclusive_end else end - 1)
        cond = F.col(day_col).isin(days) & cond
    out = df.where(cond)
    return out.select(*columns) if columns else out


def point_events(df: DataFrame, id_col: str, time_col: str, site_col: str) -> DataFrame:
    """``(id, t, site)`` from configurable column names."""
    return df.select(F.col(id_col).alias("id"), F.col(time_col).alias("t"), F.col(site_col).alias("site"))


def endpoint_events(df: DataFrame, id_col: str = "id", stime_col: str = "stime",
                    etime_col: str = "etime", site_col: str = "site") -> DataFrame:
    """Each interval row yields a start event and, when the end is not null, an
    end event: ``(id, t, site)``.  One pass over the input (no self-union).

    Note the range filter (if any) applies to the start column only, so an end
    event may lie outside the scanned range -- as in the original job.
    """
    start = F.struct(F.col(id_col).alias("id"), F.col(stime_col).alias("t"), F.col(site_col).alias("site"))
    stop = F.struct(F.col(id_col).alias("id"), F.col(etime_col).alias("t"), F.col(site_col).alias("site"))
    both = F.when(F.col(etime_col).isNull(), F.array(start)).otherwise(F.array(start, stop))
    return df.select(F.inline(both))
