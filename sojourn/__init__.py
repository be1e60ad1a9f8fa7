"""sojourn: dwell histories from timestamped logs, as plain Spark DataFrame jobs.

Every public operator is a DataFrame -> DataFrame function built from Spark's
own window, aggregate and join primitives (no Python UDF on the hot path), so
Catalyst and adaptive execution plan the work.

Layout
------
``sources``    reading: range scans, point/endpoint events, adapters for the test tables
``functions``  column-level helpers: cleaning rules, epoch -> day, TSV lines
``operators``  per-id sequence operators (segments, runs, split, re-lay, re-merge),
               lists, keyed control state, the high-water mark
``plans``      the composed trace pipelines and the end-to-end jobs
``sinks``      line sink with staging, run audit, small-file compaction
``streaming``  the incremental runner (bounded batches driven by the saved mark)
"""

from .session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
