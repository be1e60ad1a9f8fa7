"""Incremental runs resume from the saved mark; the stream equals the batch job."""

import pytest
from pyspark.sql import functions as F

from sojourn.plans import jobs
from sojourn.session import shared_dir
from sojourn.sinks import publish_lines, published, read_audit
from sojourn.sources import tables as tb
from sojourn.streaming import incremental, run_increment, saved_value, start_trace_stream
from tests.conftest import SF_SMALL

START, MID, END = 1704067200, 1705276800, 1706745600


def test_increments_cover_the_range_once(spark):
    events = tb.read_table(spark, SF_SMALL, "events")
    raw = tb.points(events)
    control, audit = shared_dir(spark, "t-control"), shared_dir(spark, "t-audit")
    target = shared_dir(spark, "t-out")

    def run(a, b):
        return jobs.job_log_export(tb.log(tb.events_in_range(events, a, b)), tb.LOG_COLUMNS, "t", a, b)

    first = run_increment(spark, "logjob", run, [target], control, MID, START, audit)
    assert first["start"] == START and first["stop_time"] == MID
    again = run_increment(spark, "logjob", run, [target], control, MID, START, audit)
    assert again["rows"] == 0                      # nothing new before MID
    second = run_increment(spark, "logjob", run, [target], control, END, START, audit)
    assert second["start"] == MID and saved_value(spark, control, "logjob", "stopTime") == str(END)
    assert first["rows"] + second["rows"] == events.count()
    empty = run_increment(spark, "LogJob", run, [target], control, END + 86400, START, audit)   # names match without case
    assert empty == {"start": END, "end": END + 86400, "rows": 0, "stop_time": END + 86400}
    assert published(spark, [target]).count() == events.count()
    assert read_audit(spark, audit).count() == 3
    assert raw.count() == events.count()


def test_stream_matches_batch(spark):
    src = shared_dir(spark, "t-src")
    tb.points_dirty(tb.read_table(spark, SF_SMALL, "events")).write.parquet(src)
    out = shared_dir(spark, "t-stream-out")

    def to_lines(batch):
        return jobs.job_trace_points(batch, START, END)

    q = start_trace_stream(spark, src, "id string, t bigint, site string", to_lines, out)
    q.awaitTermination(300)
    got = sorted(r[0] for r in spark.read.text(out).select(F.col("value")).collect())
    want = sorted(r[0] for r in to_lines(spark.read.parquet(src)).select("line").collect())
    assert got == want and len(got) > 0


def test_a_storage_error_does_not_reset_the_mark(spark, tmp_path):
    control = str(tmp_path / "control")
    incremental.save_values(spark, control, "job", {"stopTime": "7"})
    assert saved_value(spark, control, "JOB", "STOPTIME") == "7"
    for f in (tmp_path / "control").glob("*.parquet"):
        f.write_bytes(b"not parquet")
    with pytest.raises(Exception):
        saved_value(spark, control, "job", "stopTime")
    assert saved_value(spark, str(tmp_path / "none"), "job", "stopTime") is None


def test_a_slice_committed_before_its_mark_is_not_published_again(spark, tmp_path):
    """A crash between publishing and saving the mark: the rerun adds no line."""
    control, target = str(tmp_path / "control"), str(tmp_path / "out")
    run = lambda a, b: spark.range(a, b).selectExpr("id AS t", "cast(id AS string) AS line")
    publish_lines(run(0, 10), [target], run_id="job-0-10")
    got = run_increment(spark, "job", run, [target], control, 10, 0)
    assert got["rows"] == 10 and published(spark, [target]).count() == 10
