"""Readers for the benchmark tables and adapters onto the shapes the jobs read.

The jobs consume a point log ``(id, t, site)``, an interval log
``(id, stime, site, etime)``, a generic log with a ``day`` partition column, a
keyed control table and text lines.  The test data ships one generic
``events`` table (and ``documents``), so each shape is derived from it by a
plain projection -- every row of the source is kept.

The derivation rules are the contract shared with the SQL oracle; keep both in
step (see ``sojourn/oracle.py``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed values of the derived test shapes.
ID_PREFIX = "device-"
ID_DIGITS = 6
POINT_IDS = 2          # ids are user_id % 2: two dense ids, so runs of three or more occur


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def epoch_seconds(ts: str | Column = "ts") -> Column:
    """Whole epoch seconds of a TIMESTAMP_NTZ column (zone-free)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_timestamp(c).cast("long")


def _ntz(seconds: int) -> Column:
    text = _dt.datetime.fromtimestamp(seconds, tz=_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(text).cast("timestamp_ntz")


def events_in_range(events: DataFrame, start: int, end: int, inclusive_end: bool = False) -> DataFrame:
    """Restrict the raw table to the seconds ``[start, end)`` (or ``[start, end]``)
    with a predicate on the stored ``ts`` column, which reaches the Parquet
    reader as a pushed filter.  Exactly equivalent to the same test on whole
    seconds, since ``t = floor(ts)``."""
    upper = _ntz(end + 1) if inclusive_end else _ntz(end)
    return events.where((F.col("ts") >= _ntz(start)) & (F.col("ts") < upper))


def device_id(n_ids: int = POINT_IDS) -> Column:
    return F.concat(F.lit(ID_PREFIX), F.lpad((F.col("user_id") % n_ids).cast("string"), ID_DIGITS, "0"))


def points(events: DataFrame, n_ids: int = POINT_IDS) -> DataFrame:
    return events.select(device_id(n_ids).alias("id"), epoch_seconds().alias("t"),
                         F.col("event_type").alias("site"))


def points_mixed(events: DataFrame, n_ids: int = POINT_IDS) -> DataFrame:
    """As ``points``; every even event's site is upper-cased."""
    site = F.when(F.col("event_id") % 2 == 0, F.upper("event_type")).otherwise(F.col("event_type"))
    return events.select(device_id(n_ids).alias("id"), epoch_seconds().alias("t"), site.alias("site"))


def points_dirty(events: DataFrame, n_ids: int = POINT_IDS) -> DataFrame:
    """Raw-looking points: quoted ids, short ids, millisecond times, short sites."""
    base = device_id(n_ids)
    ident = (F.when(F.col("event_id") % 11 == 0, F.lit("d1"))
             .when(F.col("event_id") % 5 == 0, F.concat(F.lit('"'), base, F.lit('"')))
             .otherwise(base))
    t = F.when(F.col("event_id") % 97 == 0, epoch_seconds() * 1000).otherwise(epoch_seconds())
    padded = F.rpad("event_type", 14, "_")
    site = (F.when(F.col("event_type") == "error", F.col("event_type"))
            .when(F.col("event_id") % 7 == 0, F.concat(F.lit('"'), padded, F.lit('"')))
            .otherwise(padded))
    return events.select(ident.alias("id"), t.alias("t"), site.alias("site"))


def intervals(events: DataFrame, n_ids: int = POINT_IDS, null_ends: bool = False) -> DataFrame:
    """``(id, stime, site, etime)``: the stay lasts ``floor(value)`` seconds.
    With ``null_ends`` every third event has no end."""
    stime = epoch_seconds()
    etime = stime + F.floor("value").cast("long")
    if null_ends:
        etime = F.when(F.col("event_id") % 3 == 0, F.lit(None).cast("long")).otherwise(etime)
    return events.select(device_id(n_ids).alias("id"), stime.alias("stime"),
                         F.col("event_type").alias("site"), etime.alias("etime"))


def intervals_dirty(events: DataFrame, n_ids: int = POINT_IDS) -> DataFrame:
    """Raw-looking intervals: as ``intervals`` with null ends, sites padded to 14
    characters (``error`` is not) and quoted on every seventh event."""
    padded = F.rpad("event_type", 14, "_")
    site = (F.when(F.col("event_type") == "error", F.col("event_type"))
            .when(F.col("event_id") % 7 == 0, F.concat(F.lit('"'), padded, F.lit('"')))
            .otherwise(padded))
    return intervals(events.withColumn("event_type", site), n_ids, null_ends=True)


LOG_COLUMNS = ["event_id", "t", "user_id", "event_type", "props"]


def log(events: DataFrame) -> DataFrame:
    """A generic log with a ``day`` (``yyyyMMdd``) partition column; ``user_id``
    is null on every fourth event and ``props`` carries JSON with quotes."""
    return events.select(
        "event_id",
        epoch_seconds().alias("t"),
        F.when(F.col("event_id") % 4 == 0, F.lit(None).cast("long")).otherwise(F.col("user_id")).alias("user_id"),
        "event_type",
        "props",
        F.date_format("ts", "yyyyMMdd").alias("day"),
    )


def control(events: DataFrame) -> DataFrame:
    """Keyed control rows ``(id, type, name, value)``, values padded with blanks."""
    return events.select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("job"), F.col("user_id").cast("string")).alias("type"),
        F.col("event_type").alias("name"),
        F.concat(F.lit(" "), F.col("event_id").cast("string"), F.lit(" ")).alias("value"),
    )


def lines(documents: DataFrame) -> DataFrame:
    """One text line per document: line feeds become blanks, or carriage returns in every second document."""
    other = F.when(F.col("doc_id") % 2 == 0, F.lit("\r")).otherwise(F.lit(" "))
    return documents.select(F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), other).alias("line"))
