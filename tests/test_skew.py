"""A hot id is spread over many tasks and still gives the sequential result."""

import random

from pyspark.sql import functions as F

from sojourn.operators.segments import (dwell_segment_parts, even_dwell_segments, interval_segment_parts, interval_segments, merge_segment_parts,
                                        number_segment_parts)
from sojourn.operators.sequence import range_slices
from sojourn.operators.smoothing import relay_by_dwell, split_equal
from sojourn.plans import traces
from sojourn.plans.stage import materialize
from tests import model
from tests.conftest import rows

DAY = 86400


def skewed_points(days=20, step=30, cold_ids=4):
    rnd = random.Random(7)
    hot = [("device-hot0001", 1_700_006_400 + i * step + rnd.choice([0, 1, 2]), rnd.choice(["A", "B", "a", "C"]))
           for i in range(days * DAY // step)]
    cold = [(f"device-cold{k:03d}", 1_700_006_400 + rnd.randint(0, days * DAY), rnd.choice(["A", "B"]))
            for k in range(cold_ids) for _ in range(50)]
    return hot + cold


def test_hot_id_walk_spreads_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        data = skewed_points()
        pts = spark.createDataFrame(data, "id string, t long, site string")
        parts = dwell_segment_parts(pts)
        hot = parts.where(F.col("id") == "device-hot0001").select(F.spark_partition_id().alias("p"), "_chunk")
        per_part = {r["p"]: r["n"] for r in hot.groupBy("p").agg(F.countDistinct("_chunk").alias("n")).collect()}
        # 20 day slices of one id land in many of the 16 partitions, not one.
        assert len(per_part) >= 8 and max(per_part.values()) <= 5
        segs = merge_segment_parts(number_segment_parts(materialize(parts, "t-parts")))
        assert rows(segs.select("id", "stime", "site", "etime")) == model.pipeline(data, "segments")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_hot_id_pipeline_matches_model(spark):
    data = skewed_points(days=6, step=45)
    pts = spark.createDataFrame(data, "id string, t long, site string")
    assert rows(traces.trace_relay(pts, slice_segments=500, slice_runs=200)) == model.pipeline(data, "relay")


def test_hot_interval_day_spreads_evenly(spark):
    """One id, one day, 500,000 different intervals: no task walks over twice the mean."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        iv = spark.range(500_000).selectExpr("'device-hot0001' AS id", "1700006400 + id % 80000 AS stime", "'A' AS site",
                                             "1700006400 + id % 80000 + id div 80000 * 7 AS etime")
        order = ["stime", "site", "etime"]
        tasks = [r["count"] for r in range_slices(iv, order).repartition("id", "_chunk").groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(tasks) == 500_000 and len(tasks) == 8 and max(tasks) <= 2 * 500_000 / 8
        got = interval_segments(iv)
        assert rows(got.select("seg", "stime", "etime"))[0][1] == 1_700_006_400
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_dense_day_of_one_id_spreads_evenly(spark):
    """One id, one day, 500,000 points, up to seven sites a second: no task walks over twice the mean, also
    where the two hours before a point span several slices."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        pts = spark.range(500_000).selectExpr("'device-hot0001' AS id", "1700006400 + id % 80000 AS t", "concat('S', id div 80000) AS site")
        flat = pts.selectExpr("id", "t AS stime", "site", "t AS etime")
        sliced = range_slices(flat, ["stime", "site", "etime"], slices=64)
        assert sliced.groupBy("_chunk").agg((F.max("stime") - F.min("stime")).alias("s")).agg(F.max("s")).first()[0] < 7200
        tasks = [r["count"] for r in sliced.repartition("id", "_chunk").groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(tasks) == 500_000 and len(tasks) == 8 and max(tasks) <= 2 * 500_000 / 8
        few = [tuple(r) for r in pts.where("t < 1700006400 + 9000").collect()]
        got = even_dwell_segments(pts.where("t < 1700006400 + 9000"), slices=64)
        assert rows(got.select("id", "stime", "site", "etime")) == model.pipeline(few, "segments")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_copies_of_an_inverted_interval(spark):
    """Repeated inverted intervals are carried as a number and come out as single segments."""
    data = [("device-a", 10_000, "A", 100)] * 5 + [("device-a", 9_000, "A", 9_500), ("device-a", 10_050, "A", 10_060)]
    iv = spark.createDataFrame(data, "id string, stime long, site string, etime long")
    want = sorted((i, *s) for i, r in model.by_id(data).items() for s in model.segments_from_intervals(r))
    for slices in (1, 3, 50):
        got = interval_segments(iv, slices=slices)
        assert rows(got.select("id", "stime", "site", "etime")) == want
        assert sorted(r.seg for r in got.collect()) == list(range(1, len(want) + 1))
    many = spark.range(300_000).selectExpr("'d' AS id", "20000L AS stime", "'A' AS site", "0L AS etime")
    parts = interval_segment_parts(many).collect()
    assert len(parts) == 1 and parts[0].last.extra == 299_999
    assert interval_segments(many).count() == 300_000


def test_run_over_a_million_sites_spreads_evenly(spark):
    """One run of 1,000,000 sites: no task scans over twice the mean, and the rows are those of one sequential scan."""
    n = 1_000_000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        start = "id * 7 - id % 1000 * 5"
        segs = spark.range(n).selectExpr("'device-hot0001' AS id", "id + 1 AS seg", f"{start} AS stime", "concat('S', id) AS site",
                                         f"{start} + id % 11 AS etime", "1L AS run")
        order = ["run", "stime", "seg"]
        tasks = [r["count"] for r in range_slices(segs, order).repartition("id", "run", "_chunk").groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(tasks) == n and len(tasks) == 8 and max(tasks) <= 2 * n / 8

        sites = sorted((k * 7 - k % 1000 * 5, k) for k in range(n))
        end, total, ends = sites[0][0], 0, 0
        for m, k in sites:
            end = max(end, m) + k % 11
            total += end
            ends ^= end * (k + 1)
        got = relay_by_dwell(segs, slices=64)
        key = F.col("etime") * (F.substring("site", 2, 9).cast("long") + 1)
        assert tuple(got.agg(F.count("*"), F.max("ord"), F.max("etime"), F.sum("etime"), F.bit_xor(key)).first()) == (n, n, end, total, ends)

        lo, hi = 0, (n - 1) * 7 - (n - 1) % 1000 * 5 + (n - 1) % 11
        cut = split_equal(segs, ["run"], slices=64).withColumn("k", F.substring("site", 2, 9).cast("long"))
        step = (hi - lo) // n
        assert cut.where((F.col("stime") == lo + F.col("k") * step) & (F.col("etime") == lo + (F.col("k") + 1) * step)).count() == n
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
