"""Sliced Spark operators against the sequential model on random data.

Slices are made tiny (minutes of time, a few segments or runs) so that almost
every block crosses a slice border and the stitching is exercised.
"""

import random

import pytest

from sojourn.operators.segments import dwell_segments, interval_segments
from sojourn.plans import traces
from tests import model
from tests.conftest import rows

STEPS = [0, 0, 1, 5, 30, 59, 60, 100, 179, 180, 250, 299, 300, 1000, 1799, 1800, 5000, 7199, 7200, 9000]
SITES = ["A", "a", "B", "C", "c", "D"]


def random_points(seed, n_ids=5, n=160):
    rnd = random.Random(seed)
    out = []
    for i in range(n_ids):
        t = 1_700_000_000 + rnd.randint(0, 5000)
        for _ in range(rnd.randint(1, n)):
            t += rnd.choice(STEPS)
            out.append((f"device-{seed:03d}{i:04d}", t, rnd.choice(SITES)))
            if rnd.random() < 0.05:
                out.append(out[-1])           # exact duplicate
    return out


def random_intervals(seed, n_ids=4, n=120):
    rnd = random.Random(seed)
    out = []
    for i in range(n_ids):
        t = 1_700_000_000
        for _ in range(rnd.randint(1, n)):
            t += rnd.choice(STEPS)
            out.append((f"device-{seed:03d}{i:04d}", t, rnd.choice(SITES), t + rnd.choice([0, 10, 59, 299, 400, 8000])))
            if rnd.random() < 0.05:
                out.append(out[-1])
    return out


SLICES = dict(slice_seconds=900, slice_segments=3)        # narrower than the gap: widened to it
HALO = dict(slice_seconds=7200, slice_segments=3)          # gap-wide slices: halo walk


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_segments_and_pipelines_match_model(spark, seed):
    data = random_points(seed)
    pts = spark.createDataFrame(data, "id string, t long, site string")
    segs = dwell_segments(pts, slice_seconds=SLICES["slice_seconds"]).select("id", "stime", "site", "etime")
    assert rows(segs) == model.pipeline(data, "segments")
    assert rows(traces.trace_split_excl(pts, **SLICES)) == model.pipeline(data, "split_excl")
    assert rows(traces.trace_split_incl(pts, **SLICES)) == model.pipeline(data, "split_incl")
    assert rows(traces.trace_relay(pts, **SLICES, slice_runs=2)) == model.pipeline(data, "relay")
    even = dwell_segments(pts, slices=23)
    assert rows(even.select("id", "stime", "site", "etime")) == model.pipeline(data, "segments")
    assert all(a == b for a, b in zip(sorted(even.select("id", "seg").collect()), sorted(dwell_segments(pts).select("id", "seg").collect())))
    assert rows(traces.trace_relay(pts, slice_segments=3, slice_runs=2, slices=11)) == model.pipeline(data, "relay")
    assert rows(traces.trace_split_excl(pts, slice_segments=3, slices=11)) == model.pipeline(data, "split_excl")
    assert rows(traces.trace_split_incl(pts, slice_segments=3, slices=90)) == model.pipeline(data, "split_incl")
    assert rows(traces.trace_relay(pts, slice_segments=3, slice_runs=2, slices=90)) == model.pipeline(data, "relay")
    halo = dwell_segments(pts, slice_seconds=HALO["slice_seconds"]).select("id", "stime", "site", "etime")
    assert rows(halo) == model.pipeline(data, "segments")
    assert rows(traces.trace_relay(pts, **HALO, slice_runs=2)) == model.pipeline(data, "relay")
    assert rows(traces.trace_split_excl(pts, **HALO)) == model.pipeline(data, "split_excl")


@pytest.mark.parametrize("seed", [4, 5])
def test_interval_pipeline_matches_model(spark, seed):
    data = random_intervals(seed)
    iv = spark.createDataFrame(data, "id string, stime long, site string, etime long")
    segs = interval_segments(iv, slices=16).select("id", "stime", "site", "etime")
    want = sorted((i, *s) for i, r in model.by_id(data).items() for s in model.segments_from_intervals(r))
    assert rows(segs) == want
    assert rows(traces.trace_interval(iv, slices=7, slice_segments=3)) == model.pipeline(data, "interval")


def test_default_slices_match_tiny_slices(spark):
    data = random_points(9, n_ids=3, n=300)
    pts = spark.createDataFrame(data, "id string, t long, site string")
    want = rows(traces.trace_relay(pts, **SLICES, slice_runs=1))
    assert rows(traces.trace_relay(pts)) == want
    assert rows(traces.trace_relay(pts, slice_seconds=10800, slice_segments=7, slice_runs=3)) == want


@pytest.mark.parametrize("seed", [6, 7])
def test_remerge_matches_model_across_slices(spark, seed):
    from sojourn.operators.merge import remerge
    from sojourn.operators.sequence import range_slices

    data = sorted(set(random_intervals(seed)))
    iv = spark.createDataFrame(data, "id string, stime long, site string, etime long")
    order = ["stime", "site", "etime"]
    got = remerge(range_slices(iv, order, slices=20), order, "_chunk")
    want = sorted((i, *s) for i, r in model.by_id(data).items() for s in model.remerge(sorted(r)))
    assert rows(got.select("id", "stime", "site", "etime")) == want


def random_runs(seed, n_runs=6, sites=40):
    """Segments in long runs over many sites, with equal starts and dwells of zero and less."""
    rnd = random.Random(seed)
    out = []
    for run in range(1, n_runs + 1):
        for _ in range(rnd.choice([1, 2, 3, 50, 200])):
            t = rnd.randint(0, 400)
            out.append(("device-run", len(out) + 1, t, f"S{rnd.randint(0, sites)}", t + rnd.choice([-5, 0, 3, 40]), run))
    return out


@pytest.mark.parametrize("slices", [1, 3, 40, 300])
def test_sliced_runs_equal_whole_windows(spark, slices):
    from sojourn.operators.smoothing import relay_by_dwell, split_equal

    segs = spark.createDataFrame(random_runs(slices), "id string, seg long, stime long, site string, etime long, run long")
    for whole, cut in ((relay_by_dwell(segs), relay_by_dwell(segs, slices=slices)), (split_equal(segs, ["run"]), split_equal(segs, ["run"], slices=slices))):
        assert whole.schema.names == cut.schema.names and [f.dataType for f in whole.schema] == [f.dataType for f in cut.schema]
        assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, cut.collect()))
    assert relay_by_dwell(segs.limit(0), slices=slices).count() == 0 and split_equal(segs.limit(0), ["run"], slices=slices).count() == 0
