import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from sojourn.llm import bitsliced as B
from sojourn.llm.common import read_table
from tests.harness import compare, duck

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    held = [(d, Counter(words(t))) for d, t in docs if words(t)]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in held:
            m = 25 + 75 * sum(c.values()) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w in words(text) if c[w])
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(item, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scored)[:k])]
    return out


def found(spark, docs, items, k=10):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "doc_id AS item", "'x' AS score", "1 AS terms")
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "2 AS rank", "'y' AS h")
    return [tuple(r) for r in B.search(d.repartition(3), i, k).select("item_id", "rank", "doc_id", "score").collect()]


def some_docs(n=300, seed=4):
    rng = random.Random(seed)
    vocab = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(400)]
    return [(i, " ".join(rng.choice(vocab[: rng.choice((20, 400))]) for _ in range(rng.choice((0, 1, 5, 60, 400))))) for i in range(n)]


def test_search_equals_brute_force(spark):
    docs = some_docs() + [(1000, None), (1001, ""), (1002, " .,!"), (None, "w1 w2 w3 w4 w5"), (1003, "w1 w2 w3 w4 w5")]
    docs += [(2000 + i, "w3 w9 w300 w301 tie") for i in range(30)]  # ties beyond k
    items = [(1, "w3 W9 w300, w301 tie tie"), (2, "w1 w2 w3 w4 w5"), (3, None), (4, "absent-word"), (5, "w7é w14é w0é"), (None, "w11 w12"), (1, "w3 w9")]
    assert sorted(found(spark, docs, items), key=repr) == sorted(brute(docs, items), key=repr)


def test_more_items_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(B, "ITEM_TERMS", 12)
    docs, rng = some_docs(120, 9), random.Random(1)
    items = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(5))) for i in range(9)]
    assert len(list(B._item_blocks(spark.createDataFrame(items, "item_id long, text string")))) > 3
    assert sorted(found(spark, docs, items, 3)) == sorted(brute(docs, items, 3))


def test_repeated_documents_each_take_a_rank(spark):
    docs = [(7, "alpha beta gamma")] * 4 + [(8, "alpha delta")] + [(i, "other text here") for i in range(10, 40)]
    got = sorted(found(spark, docs, [(1, "alpha beta")], 4))
    assert [(r, d) for _, r, d, _ in got] == [(1, 7), (2, 7), (3, 7), (4, 7)] and len({s for *_, s in got}) == 1


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == [] and found(spark, [(1, "a b")], []) == [] and found(spark, [(1, None)], [(1, "a")]) == []


@pytest.mark.parametrize("bits", [512, 768, 4096])
def test_bounds_are_never_below_the_score(bits):
    """Also with signatures far too small for their entries."""
    docs = [c for c in (Counter(w.encode() for w in words(t)) for _, t in some_docs(200, bits)) if c]
    n_docs, total = len(docs), sum(sum(c.values()) for c in docs)
    held = sorted({w for c in docs for w in c})
    weight = np.array([1 + i % 50 for i in range(len(held))], np.float64)
    query = B.Query(B.hashes(held), {w: i for i, w in enumerate(held)}, [(np.arange(j, len(held), 9), weight[j::9]) for j in range(9)], n_docs, total)
    entries = []
    for c in docs:
        levels = np.searchsorted(B.THRESHOLDS, list(c.values()), side="right")
        entries.append(np.concatenate([B.entries(B.hashes([w]), np.arange(n)) for w, n in zip(c, levels)]))
    got = B.bounds(query, bits, np.array([sum(c.values()) for c in docs]), B._packed(bits, entries))
    for row, c in enumerate(docs):
        m = query.norm(np.int64(sum(c.values())))
        gain = B.impact(np.array([c[w] for w in held], np.int64), m)
        for q, (at, w) in enumerate(query.items):
            assert got[q, row] >= w @ gain[at]


def test_signatures_exclude_most_documents(spark):
    """On the test tables most pairs of item and document are never scored."""
    docs, items = read_table(spark, "/root/testdata/sf0.01", "documents"), read_table(spark, "/root/testdata/sf0.01", "benchmark")
    seen = []
    real = B._reaching
    try:
        B._reaching = lambda *a: seen.append(real(*a)) or seen[-1]
        B.search(docs, items).count()
    finally:
        B._reaching = real
    pairs = sum(bin(r[c] & (1 << 64) - 1).count("1") for r in seen[0].collect() for c in B.MASKS)
    assert pairs < 0.2 * docs.count() * items.count()


def test_op11_equals_its_sql(spark):
    ok, why = compare(B.op11_bitsliced_bloom(spark, SF), duck(SF), B.ORACLE)
    assert ok, why


def test_very_long_text_and_size_classes(spark):
    assert B.size_of(1) == 512 and B.size_of(30) == 768 and B.size_of(40) == 1024 and all(n * B.BITS_PER_ENTRY <= B.size_of(n) for n in range(1, 5000))
    text = " ".join(f"t{i}" for i in range(300_000))
    assert found(spark, [(1, text), (2, "t5 x"), (3, "y z")], [(9, "t5 t299999")]) == brute([(1, text), (2, "t5 x"), (3, "y z")], [(9, "t5 t299999")])
