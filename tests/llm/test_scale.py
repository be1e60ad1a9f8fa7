"""Plans and bounds that matter at scale."""

import numpy as np

from sojourn.llm import bitmap, common, lines, ngrams, simhash, winnow
from sojourn.llm.common import read_table, small_batches

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cross_joins(spark):
    docs, items = read_table(spark, SF, "documents"), read_table(spark, SF, "benchmark")
    for df in (simhash.near_duplicates(docs), winnow.decontaminate(docs, items), lines.dedup(docs), ngrams.train_and_score(docs)):
        plan = plan_of(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_only_needed_columns_are_read(spark):
    plan = plan_of(simhash.fingerprints(read_table(spark, SF, "documents")))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_bitmaps_have_a_bound_and_no_false_negatives(spark):
    assert bitmap.bitmap_bits(1 << 60) == bitmap.MAX_BITS
    rng = np.random.default_rng(1)
    h = rng.integers(-2**63, 2**63 - 1, 5000)
    made = bitmap.bitmap(spark.createDataFrame([(int(x),) for x in h], "h long"), bitmap.bitmap_bits(16 * 5000))
    assert made.has(h.view(np.uint64)).all()
    assert made.has(rng.integers(0, 2**63, 100_000).astype(np.uint64)).mean() < 0.1


def test_batches_are_cut_by_bytes():
    import pyarrow as pa

    texts = ["x" * 10] * 500 + ["y" * 300_000] * 20 + ["z" * 5_000_000, ""] + [None] * 50
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["k", "t"])
    parts = list(small_batches(iter([batch]), 1 << 20))
    assert sum(p.num_rows for p in parts) == len(texts)
    assert [k for p in parts for k in p.column(0).to_pylist()] == list(range(len(texts)))
    assert all(p.num_rows == 1 or p.nbytes <= 5 << 20 for p in parts)
    assert [len(x) for x in common.text_bytes(pa.array([None, "é"]))] == [0, 2]


def test_a_very_long_text_goes_through_every_pass(spark):
    text = " ".join(f"word{i % 977}" for i in range(400_000))
    docs = spark.createDataFrame([(1, text, "en"), (2, "short text", "en")], "doc_id long, text string, lang string")
    items = spark.createDataFrame([(7, " ".join(f"word{i}" for i in range(12)))], "item_id long, text string")
    found = {r.doc_id: r for r in winnow.decontaminate(docs, items).collect()}
    assert found[1].n_words == 400_000 and found[1].n_hit == 12 * (400_000 // 977 + 1)
    assert {r.doc_id: r.n_tokens for r in ngrams.train_and_score(docs).collect()} == {1: 400_001, 2: 3}
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()} == {1: 1, 2: 2}
