"""Hand-computed cases (FIXTURES.md section 3): boundaries, ties, tiny runs."""

from pyspark.sql import functions as F

from sojourn.functions import csv_index, epoch_to_day, is_epoch_seconds, tsv_line
from sojourn.operators.merge import remerge
from sojourn.operators.runs import mark_runs
from sojourn.operators.segments import dwell_segments, interval_segments
from sojourn.operators.smoothing import relay_by_dwell, split_equal
from sojourn.operators.watermark import next_watermark, next_watermark_value
from tests.conftest import rows

SEG = "id string, seg long, stime long, site string, etime long"


def _run(spark, triples, run=1):
    data = [("device-000001", i + 1, s, site, e, run) for i, (site, s, e) in enumerate(triples)]
    return spark.createDataFrame(data, SEG + ", run long")


def test_relay_by_dwell_demo(spark):
    df = _run(spark, [("A", 100, 102), ("B", 104, 108), ("A", 50, 60), ("C", 48, 50),
                      ("B", 112, 120), ("A", 130, 140), ("C", 142, 150), ("A", 160, 180)])
    got = rows(relay_by_dwell(df).select("site", "stime", "etime"), order=["stime"])
    assert got == [("C", 48, 58), ("A", 58, 100), ("B", 104, 116)]


def test_relay_two_rows_unchanged(spark):
    df = _run(spark, [("A", 10, 20), ("B", 30, 35)])
    assert rows(relay_by_dwell(df).select("site", "stime", "etime")) == [("A", 10, 20), ("B", 30, 35)]


def test_split_equal(spark):
    got = rows(split_equal(_run(spark, [("A", 0, 10), ("B", 20, 30), ("A", 40, 50)]), ["run"])
               .select("site", "stime", "etime"))
    assert got == [("A", 0, 25), ("B", 25, 50)]
    got = rows(split_equal(_run(spark, [("A", 0, 10), ("B", 20, 30), ("C", 40, 50)]), ["run"])
               .select("site", "stime", "etime"))
    assert got == [("A", 0, 16), ("B", 16, 32), ("C", 32, 48)]


def _points(spark, pts):
    return spark.createDataFrame([("device-000001", t, s) for t, s in pts], "id string, t long, site string")


def _segs(df):
    return rows(df.select("stime", "site", "etime"))


def test_dwell_gap_boundary_and_case(spark):
    assert _segs(dwell_segments(_points(spark, [(0, "A"), (7199, "a"), (14399, "A")]))) == [
        (0, "A", 7199), (14399, "A", 14399)]


def test_dwell_site_change_and_duplicates(spark):
    assert _segs(dwell_segments(_points(spark, [(0, "A"), (10, "B"), (20, "A")]))) == [
        (0, "A", 0), (10, "B", 10), (20, "A", 20)]
    assert _segs(dwell_segments(_points(spark, [(0, "A"), (0, "A"), (5, "A")]))) == [(0, "A", 5)]


def test_interval_gap_from_last_end(spark):
    df = spark.createDataFrame([("device-000001", 0, "A", 100), ("device-000001", 50, "A", 60),
                                ("device-000001", 7259, "A", 7300)], "id string, stime long, site string, etime long")
    assert _segs(interval_segments(df)) == [(0, "A", 7300)]


def _marked(spark, triples, dur, gap):
    data = [("device-000001", i + 1, s, site, e) for i, (site, s, e) in enumerate(triples)]
    return rows(mark_runs(spark.createDataFrame(data, SEG), dur, gap).select("site", "short", "run"))


def test_runs_head_excluded_boundaries(spark):
    got = _marked(spark, [("A", 0, 1000), ("B", 2799, 2800), ("C", 4600, 4601)], 300, 1800)
    assert got == [("A", False, 1), ("B", True, 1), ("C", False, 2)]


def test_runs_head_included_boundaries(spark):
    got = _marked(spark, [("A", 0, 500), ("B", 679, 680), ("C", 860, 861)], 60, 180)
    assert got == [("A", False, 1), ("B", True, 1), ("C", False, 2)]


def test_remerge_end_to_end_gap(spark):
    def merged(second_end):
        df = spark.createDataFrame([("device-000001", 1, 0, "A", 100), ("device-000001", 2, 5000, "A", second_end)],
                                   "id string, k long, stime long, site string, etime long")
        return rows(remerge(df.withColumn("c", F.lit(0)), ["k"], "c").select("stime", "site", "etime"))
    assert merged(7299) == [(0, "A", 7299)]
    assert merged(7300) == [(0, "A", 100), (5000, "A", 7300)]


def test_scalars(spark):
    df = spark.createDataFrame([(999999999,), (1000000000,), (9999999999,), (10000000000,)], "t long")
    assert [r[0] for r in df.where(is_epoch_seconds("t")).orderBy("t").collect()] == [1000000000, 9999999999]
    txt = spark.createDataFrame([("1000000000\n",), ("1000000000",)], "s string")
    assert txt.where(is_epoch_seconds("s", text=True)).count() == 1
    line = spark.createDataFrame([(1, None, 'a"b')], "a long, b string, c string").select(tsv_line("a", "b", "c"))
    assert line.first()[0] == "1\tnull\tab"
    days = spark.createDataFrame([(1704067199,), (1704067200,), (1704067200000,)], "t long")
    assert [r[0] for r in days.select(epoch_to_day("t")).collect()] == ["20231231", "20240101", "20240101"]
    idx = spark.createDataFrame([("b", "a,b"), ("z", "a,b")], "n string, l string").select(csv_index("n", "l"))
    assert [r[0] for r in idx.collect()] == [1, -1]


def test_next_watermark(spark):
    cases = [(5, 90, 5, 90, 100), (5, 90, 4, 90, 100), (5, 90, 4, 80, 81), (5, 120, 4, 100, 100)]
    stats = spark.createDataFrame([(f"j{i}", *c[:4]) for i, c in enumerate(cases)],
                                  "job string, count_in long, max_in long, count_out long, max_out long")
    got = dict((j, s) for j, s, _ in next_watermark(stats, 100).collect())
    assert [got[f"j{i}"] for i in range(4)] == [c[4] for c in cases]
    assert [next_watermark_value(ci, mi, co, mo, 100) for ci, mi, co, mo, _ in cases] == [c[4] for c in cases]


def test_interval_duplicates(spark):
    def segs(data):
        df = spark.createDataFrame([("device-000001", *r) for r in data], "id string, stime long, site string, etime long")
        return _segs(interval_segments(df))
    assert segs([(0, "A", 100), (0, "A", 100)]) == [(0, "A", 100)]
    # An inverted interval does not absorb its twin: stime - etime >= 7200 breaks.
    assert segs([(10000, "A", 100), (10000, "A", 100)]) == [(10000, "A", 100), (10000, "A", 100)]


def test_flatten_expands_large_entries_in_pieces(spark):
    from sojourn.operators.lists import events_per_id, flatten_events
    pts = spark.createDataFrame([("device-000001", 5, "A")] * 7 + [("device-000001", 9, "B")] * 2
                                + [("device-000001", 3, "A")], "id string, t long, site string")
    listed = events_per_id(pts)
    assert rows(listed.select("pos", "t", "site", "n")) == [(1, 3, "A", 1), (2, 5, "A", 7), (9, 9, "B", 2)]
    flat = rows(flatten_events(listed, piece=3).select("pos", "t", "site"))
    assert flat == [(1, 3, "A")] + [(p, 5, "A") for p in range(2, 9)] + [(9, 9, "B"), (10, 9, "B")]
