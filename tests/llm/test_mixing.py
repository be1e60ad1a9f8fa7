import random
from collections import defaultdict
from fractions import Fraction

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sojourn.llm import mixing as M
from sojourn.llm.common import read_table


def brute_targets(sizes):
    """``sizes``: source -> words; exact water filling."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        share = sum(weight[s] for s in order if s not in full)
        level = Fraction(rest, share) if share else 0
        more = {s for s in order if s not in full and 3 * sizes[s] < weight[s] * level}
        if not more:
            return {s: Fraction(3 * sizes[s]) if s in full else weight[s] * level for s in order}
        full |= more


def frame(spark, rows, parts=3):
    return (spark.createDataFrame(rows, "doc_id long, source string, text string")
            .selectExpr("*", "'x' AS g", "1 AS size", "2 AS chunk", "3 AS n", "4 AS rank", "5 AS taken").repartition(parts))


def text(n):
    return " ".join(["w"] * n)


def some(n=400, seed=3):
    rng = random.Random(seed)
    sources = ["b", "a", "é", None, "", "B", "c"]
    return [(i, sources[min(6, int(rng.expovariate(0.8)))], text(int(rng.lognormvariate(3.5, 1)))) for i in range(n)]


def check(rows, got, near=0.03):
    sizes, taken = defaultdict(int), defaultdict(int)
    for (_, source, t), r in zip(sorted(rows, key=lambda r: r[0]), sorted(got, key=lambda r: r.doc_id)):
        assert r.size == len((t or "").split())
        sizes[source] += r.size
        taken[source] += r.taken
    want = brute_targets(sizes)
    for (_, source, _t), r in zip(sorted(rows, key=lambda r: r[0]), sorted(got, key=lambda r: r.doc_id)):
        assert r.source_size == sizes[source] and r.target == pytest.approx(float(want[source]))
        times = want[source] / sizes[source] if sizes[source] else 0
        assert r.taken == r.copies * r.size and r.taken <= 3 * r.size
        assert not r.size or int(times) <= r.copies <= int(times) + (times != int(times))
    for source, t in want.items():
        assert abs(taken[source] - t) <= max(near * t, 60), (source, float(t), taken[source])


@pytest.mark.parametrize("chunk,fan,near", [(1 << 16, 1024, 0.03), (16, 2, 0.08), (50, 3, 0.05)])
def test_sources_come_near_their_targets(spark, monkeypatch, chunk, fan, near):
    """Chunks of a few documents hand on larger ones."""
    monkeypatch.setattr(M, "CHUNK", chunk)
    monkeypatch.setattr(M, "FAN", fan)
    rows = some()
    check(rows, M.mix(frame(spark, rows)).collect(), near)


def test_reruns_agree_whatever_the_partitions(spark, monkeypatch):
    monkeypatch.setattr(M, "CHUNK", 40)
    rows = some(300, 8) + [(7, "a", text(30))] * 5
    runs = [sorted(tuple(r) for r in M.mix(frame(spark, rows, p)).collect()) for p in (1, 5)]
    assert runs[0] == runs[1]


@pytest.mark.parametrize("level", [0, 1])
def test_every_document_is_taken_as_often_as_its_fraction(level):
    """Over many seeds the mean of the rounded fractions is the fraction."""
    rng = random.Random(4)
    sizes = sorted((rng.choice((1, 5, 9, 40, 200)) for _ in range(60)), reverse=True)
    x = [0.3] * 60 if level == 0 else [rng.random() for _ in sizes]
    names = [f.split()[0] for f in M.OPEN.split(", ")] + ["words"]
    k = len(sizes)
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in (list(range(k)), ["=a"] * k, sizes, [1] * k, [1.0] * k, [0] * k, x, [0] * k, [sum(sizes)] * k)], names)
    mean, worth, n = [0.0] * k, sum(s * f for s, f in zip(sizes, x)), 3000
    for seed in range(n):
        got = [r for b in M._meet(level, seed)(iter([batch])) for r in b.to_pylist()]
        assert len(got) == k and sum(0 < r["x"] < 1 for r in got) <= 1
        assert sum(r["size"] * r["x"] for r in got) == pytest.approx(worth)
        for r in got:
            mean[r["doc_id"]] += r["x"] / n
    assert max(abs(m - f) for m, f in zip(mean, x)) < 5 * 0.5 / n**0.5


def test_a_transfer_keeps_words_and_expectation():
    rng = random.Random(2)
    for _ in range(300):
        sa, sb, a, b = rng.randint(1, 50), rng.randint(1, 50), rng.random() * 0.98 + 0.01, rng.random() * 0.98 + 0.01
        up, down = min(sa * (1 - a), sb * b), min(sa * a, sb * (1 - b))
        (a1, b1), (a2, b2) = M.transfer(sa, a, sb, b, 0.0), M.transfer(sa, a, sb, b, 1 - 1e-12)
        for x, y in ((a1, b1), (a2, b2)):
            assert sa * x + sb * y == pytest.approx(sa * a + sb * b) and (x in (0, 1) or y in (0, 1))
        p = down / (up + down)
        assert p * a1 + (1 - p) * a2 == pytest.approx(a) and p * b1 + (1 - p) * b2 == pytest.approx(b)


def test_the_rest_makes_up_for_a_large_document():
    rng = random.Random(5)
    for _ in range(300):
        words, fraction, size, x = rng.randint(100, 900), rng.random(), rng.randint(20, 60), rng.random()
        up, down = M.Rest(words, fraction), M.Rest(words, fraction)
        if up.rounds(size, x, 0.0) == 1 and down.rounds(size, x, 1.0) == 0:
            assert size + words * up.fraction == pytest.approx(size * x + words * fraction) == pytest.approx(words * down.fraction)
            assert x * up.fraction + (1 - x) * down.fraction == pytest.approx(fraction)
    assert M.Rest(1000, 0.5).rounds(30, 0.5, 0.1) is None and M.Rest(100, 0.1).rounds(30, 0.5, 0.1) is None and M.Rest(0, 0.1).rounds(30, 0.5, 0.1) is None


def test_nulls_empty_texts_and_tables(spark):
    rows = [(1, None, None), (2, None, ""), (3, "a", "x y z"), (4, "a", None), (None, "b", "one two"), (5, "z", None)]
    got = {r.doc_id: r for r in M.mix(frame(spark, rows)).collect()}
    assert len(got) == 6 and got[1].taken == got[2].taken == got[5].taken == 0 and got[5].source_size == 0 and got[5].target == 0
    assert got[3].target == pytest.approx(5 / 3) and got[None].target == pytest.approx(10 / 3)
    assert M.mix(frame(spark, [])).collect() == []
    assert [(r.target, r.taken) for r in M.mix(frame(spark, [(1, "a", None), (2, "b", " \t")])).collect()] == [(0, 0), (0, 0)]


def test_targets_stop_at_three_times_the_size(spark):
    rows = [(i, "big", text(100)) for i in range(30)] + [(100 + i, "c", text(10)) for i in range(5)] + [(200, "d", text(2))]
    got = M.mix(frame(spark, rows)).collect()
    check(rows, got)
    assert {r.copies for r in got if r.doc_id >= 100} == {3}


def test_very_long_text(spark):
    rows = [(1, "a", text(500_000)), (2, "a", text(3)), (3, "b", text(2))]
    got = {r.doc_id: r for r in M.mix(frame(spark, rows)).collect()}
    assert got[1].size == 500_000 and got[3].copies == 3


def test_op13_on_the_test_tables(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.source, r.text) for r in docs.select("doc_id", "source", "text").collect()]
    check(rows, M.op13_pivotal_mix(spark, "/root/testdata/sf0.01").collect(), near=0.06)


def test_the_plan_has_no_window_over_a_source(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents").withColumn("source", F.lit("one"))
    plan = M.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
