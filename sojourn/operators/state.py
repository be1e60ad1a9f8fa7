"""Keyed control state ``(id, type, name, value)`` as table operators.

The original keeps job parameters and high-water marks in a small SQL table
and touches it one key at a time (exists? update : insert; latest by id;
delete).  Here each operation is a set operation over whole tables: keys and
values are trimmed, duplicates of a key are reduced to the newest row by a
partial aggregate, and the joins run on unique keys, so no key -- however many
rows it had -- becomes a hot join partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["type", "name"]


def normalized(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("id").cast("long").alias("id"), F.trim("type").alias("type"),
                       F.trim("name").alias("name"), F.trim("value").alias("value"))


def keys_of(rows: DataFrame) -> DataFrame:
    return rows.select(F.trim("type").alias("type"), F.trim("name").alias("name")).distinct()


def state_latest(rows: DataFrame) -> DataFrame:
    """Newest value per ``(type, name)``: the row with the largest id."""
    return normalized(rows).groupBy(*KEY).agg(F.max("id").alias("id"), F.max_by("value", "id").alias("value"))


def state_upsert(base: DataFrame, updates: DataFrame) -> DataFrame:
    """Update the value of every base row whose key has an update, keep all
    other base rows, and insert keys the base lacks.  The newest update of a key
    wins; an updated row keeps its id, an inserted row brings its own.

    The update side is unique per key; a base key with very many rows is a
    skewed left side, which Spark's skew-join handling splits."""
    rows = normalized(base)
    new = state_latest(updates)
    fresh = new.select(*KEY, F.struct("value").alias("_u"))
    kept = rows.join(fresh, on=KEY, how="left").select(
        "id", *KEY, F.when(F.col("_u").isNotNull(), F.col("_u.value")).otherwise(F.col("value")).alias("value"))
    added = new.join(keys_of(base), on=KEY, how="left_anti").select("id", *KEY, "value")
    return kept.unionByName(added)


def state_delete(base: DataFrame, doomed: DataFrame) -> DataFrame:
    """Rows of ``base`` whose key is not in ``doomed``."""
    return normalized(base).join(keys_of(doomed), on=KEY, how="left_anti")


def state_exists(base: DataFrame, probes: DataFrame) -> DataFrame:
    """One row per distinct probe key with ``exists``."""
    present = keys_of(base).withColumn("_hit", F.lit(True))
    return (keys_of(probes).join(present, on=KEY, how="left")
            .select(*KEY, F.coalesce(F.col("_hit"), F.lit(False)).alias("exists")))
