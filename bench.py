"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is forced to completion with the ``noop`` sink (full computation, no
driver collect) and timed once, after every headline query has run once on the
smallest tables (JIT and generated code warm).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sojourn.catalog import QUERIES  # noqa: E402
from sojourn.session import get_session  # noqa: E402

HEADLINE = [
    "trace_relay",
    "trace_split_excl",
    "trace_split_incl",
    "trace_interval",
    "dwell_segments",
    "events_per_id",
    "job_trace_points",
    "job_trace_endpoints",
    "job_log_export",
    "next_watermark",
    "state_upsert",
    "publish_lines",
    "compact_lines",
]


def run(name: str, spark, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    names = sys.argv[1:] or HEADLINE
    spark = get_session()
    warm = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    for name in names:
        try:
            run(name, spark, warm if os.path.isdir(warm) else sf_dir)
        except Exception as e:  # reported below when the timed run fails too
            print(f"warm-up {name}: {type(e).__name__}: {e}", file=sys.stderr)
    times: dict[str, float | None] = {}
    for name in names:
        try:
            times[name] = round(run(name, spark, sf_dir), 3)
        except Exception as e:  # a failed query is reported as null, never as a time
            print(f"{name}: {type(e).__name__}: {e}", file=sys.stderr)
            times[name] = None
    sf = sf_dir.rsplit("sf", 1)[-1]
    total = round(sum(t for t in times.values() if t is not None), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": times,
                      "failed": [n for n, t in times.items() if t is None],
                      "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}))


if __name__ == "__main__":
    main()
