"""Run audit: an append-only table of ``(ts, title, content)`` lines, with the
optional import columns ``path, bytes, duration_ms``.  Its files are folded into
few as they grow (``append.fold``); every line stays."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from .append import append_rows, fold, read_appended

AUDIT_SCHEMA = "ts string, title string, content string, path string, bytes bigint, duration_ms bigint"


def audit_append(spark: SparkSession, table_path: str, title: str, content: str, ts: str | None = None,
                 path: str | None = None, nbytes: int | None = None, duration_ms: int | None = None) -> None:
    """Append one audit line; ``ts`` defaults to now (UTC, ``yyyy-MM-dd HH:mm:ss``)."""
    ts = ts or _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    append_rows(spark, table_path, [(ts, title, content, path, nbytes, duration_ms)], AUDIT_SCHEMA)
    fold(spark, table_path, AUDIT_SCHEMA)


def read_audit(spark: SparkSession, table_path: str) -> DataFrame:
    return read_appended(spark, table_path, AUDIT_SCHEMA)
