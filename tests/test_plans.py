"""Physical-plan properties that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from sojourn.catalog import QUERIES
from sojourn.operators.segments import dwell_segment_parts, interval_segment_parts
from sojourn.session import shared_dir
from sojourn.sources import tables as tb
from sojourn.sources.scans import days_between, scan_range
from tests.conftest import SF_SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_range_reaches_parquet_reader(no_aqe):
    plan = plan_of(QUERIES["log_scan_half_open"](no_aqe, SF_SMALL))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


def _walk(spark):
    return dwell_segment_parts(tb.points(tb.read_table(spark, SF_SMALL, "events")))


def _interval_walk(spark):
    return interval_segment_parts(tb.intervals(tb.read_table(spark, SF_SMALL, "events")))


def test_only_needed_columns_are_read(no_aqe):
    plan = plan_of(_walk(no_aqe))
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", plan).group(1)
    assert schema == "struct<ts:timestamp_ntz,user_id:bigint,event_type:string>"


def test_day_partitions_are_pruned(no_aqe):
    path = shared_dir(no_aqe, "test-log")
    tb.log(tb.read_table(no_aqe, SF_SMALL, "events")).write.partitionBy("day").parquet(path)
    df = scan_range(no_aqe.read.parquet(path), "t", 1704477600, 1704520800, day_col="day")
    plan = plan_of(df)
    assert re.search(r"PartitionFilters: \[[^\]]*day", plan)
    assert df.count() == tb.log(tb.read_table(no_aqe, SF_SMALL, "events")).where(
        (F.col("t") >= 1704477600) & (F.col("t") < 1704520800)).count()


def test_registered_day_scan_reads_two_days(no_aqe):
    plan = plan_of(QUERIES["day_pruned_scan"](no_aqe, SF_SMALL))
    days = set(re.findall(r"2024\d{4}", re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)))
    assert days == {"20240105", "20240106"}


def test_a_half_open_range_that_ends_at_midnight_stays_in_its_day():
    assert days_between(1704412800, 1704499200 - 1) == ["20240105"]


@pytest.mark.parametrize("walk", [_walk, _interval_walk])
def test_sliced_walk_reads_its_input_once(no_aqe, walk):
    plan = plan_of(walk(no_aqe))
    assert plan.count("FileScan") == 1


@pytest.mark.parametrize("walk", [_walk, _interval_walk])
def test_single_branch_walks_sort_rows_once(no_aqe, walk):
    assert plan_of(walk(no_aqe)).count("Sort [") == 1


@pytest.mark.parametrize("name", ["trace_relay", "trace_split_excl", "trace_interval", "job_trace_points"])
def test_no_python_on_the_hot_path(no_aqe, name):
    plan = plan_of(QUERIES[name](no_aqe, SF_SMALL))
    assert "EvalPython" not in plan and "PythonUDF" not in plan


@pytest.mark.parametrize("walk", [_walk, _interval_walk])
def test_row_windows_partition_by_slice(no_aqe, walk):
    """Row-level windows partition by (id, slice); only the slice summary is
    windowed per id, and it reads one row per slice."""
    plan = plan_of(walk(no_aqe))
    specs = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[", plan)
    assert specs and all("_chunk" in s or "_c#" in s or s.strip().startswith("id#") for s in specs)
    assert any("_chunk" in s for s in specs)


def test_relay_pipeline_jobs_and_row_shuffles(spark, monkeypatch):
    """Four row-sized shuffles: the duplicate fold, the day slices, the segment blocks and the run blocks
    (which serve statistics, re-lay and re-merge alike).  All others are of per-slice summaries."""
    from sojourn.operators import merge, runs
    from sojourn.plans import stage, traces

    plans = {}

    def kept(df, name):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plans[name] = plan_of(df)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        return stage.materialize(df, name)

    for module in (merge, runs, traces):
        monkeypatch.setattr(module, "materialize", kept)
    spark.sparkContext.setJobGroup("relay-jobs", "relay")
    try:
        traces.trace_relay(tb.points(tb.read_table(spark, SF_SMALL, "events"))).toPandas()
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("relay-jobs")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 14

    def shuffles(plan):
        return re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", re.sub(r"#\d+L?", "", plan))

    by_row = [s for name in ("segment-parts", "run-parts", "remerge-parts") for s in shuffles(plans[name]) if s != "id"]
    assert sorted(by_row) == ["id, _chunk", "id, _rb", "id, _sc", "id, t, site"]
