import collections
import math
import re
import zlib

import numpy as np
import pytest

from sojourn.llm import ngrams as N

ROWS = [(0, "The cat the dog"), (1, "the cat\tTHE"), (2, None), (3, ""), (None, "a\x0bb a b é"), (4, "zzz yyy the"), (5, "the cat"), (5, "the cat"), (9, "long " * 3000), (13, "the dog a")]


def brute(rows, discount=N.DISCOUNT):
    token = [re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    count, after = collections.Counter(), collections.defaultdict(collections.Counter)
    for ws, out in zip(token, held):
        if not out:
            count.update(ws)
            for a, b in zip(["<s>", *ws], ws):
                after[a][b] += 1
    n, v = sum(count.values()), len(count)
    rows_out = []
    for (i, _), ws, out in zip(rows, token, held):
        base = score = 0.0
        for a, w in zip(["<s>", *ws], ws):
            p = (count[w] + 1) / (n + v + 1)
            base += math.log10(p)
            f = after.get(a)
            if f:
                total = sum(f.values())
                p = max(f[w] - discount, 0) / total + discount * len(f) / total * p
            score += math.log10(p)
        rows_out.append((i, out, len(ws), sum(count[w] > 0 for w in ws), n, base, score))
    return rows_out


def check(got, want):
    key = lambda r: (repr(r[0]), r[2], round(r[5], 6))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        assert abs(g[6] - w[6]) <= 0.02 * w[2]  # codes of 8 bits


def test_scores_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(N, "CODES", N.CODES)
    docs = spark.createDataFrame([(i, t, True) for i, t in ROWS], "doc_id long, text string, held_out boolean").repartition(3)
    check(N.train_and_score(docs).collect(), brute(ROWS))
    assert N.train_and_score(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in N.read_table(spark, sf, "documents").collect()]
    check(N.op3_elias_fano_lm(spark, sf).collect(), brute(rows))


@pytest.mark.parametrize("n,bits", [(1, 10), (2, 64), (1000, 64), (5000, 20), (3000, 13), (100, 7), (40_000, 40)])
def test_elias_fano(n, bits):
    rng = np.random.default_rng(n)
    draw = lambda k: rng.integers(0, 2**63 if bits == 64 else 2**bits, k, dtype=np.uint64) * np.uint64(2 if bits == 64 else 1)
    v = np.unique(draw(n))
    e = N.EliasFano(*N.EliasFano.pack(v, bits).values())
    assert (e.get(np.arange(len(v))) == v).all()
    at = {int(x): i for i, x in enumerate(v)}
    q = np.concatenate([v, v + np.uint64(1), draw(1000)])
    assert e.find(q).tolist() == [at.get(int(x), -1) for x in q]
    lo, hi = np.full(len(q), len(v) // 3), np.full(len(q), 2 * len(v) // 3)
    assert e.find(q, lo, hi).tolist() == [i if len(v) // 3 <= (i := at.get(int(x), -1)) < 2 * len(v) // 3 else -1 for x in q]
    packed = N.EliasFano.pack(v, bits)
    if n >= 1000:  # close to 2 + log2(universe / n) bits a value, with the directory
        assert 8 * sum(a.nbytes for k, a in packed.items() if k in ("low", "high")) < len(v) * (3.5 + max(0, bits - math.log2(len(v)))) + 400


def test_pointers_may_repeat():
    v = np.array([0, 0, 3, 3, 3, 9], np.uint64)
    e = N.EliasFano(*N.EliasFano.pack(v, 4).values())
    assert e.get(np.arange(6)).tolist() == v.tolist()
    empty = N.EliasFano(*N.EliasFano.pack(v[:0], 4).values())
    assert empty.find(v).tolist() == [-1] * 6


def test_codes():
    x = 10 ** -np.linspace(0, 7.9, 500)
    assert (np.abs(np.log10(N.VALUE[N.code(x)]) - np.log10(x)) <= 8 / 254 / 2 + 1e-9).all()


def test_shards_follow_the_data(spark, monkeypatch):
    """More words or tokens make more shards, not larger ones, and no other scores."""
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    blocks = N.write_blocks(docs, N.shared_dir(spark, "llm", "blocks"))
    tokens = sum(len((t or "").split()) + 1 for _, t in ROWS)
    assert blocks.agg(N.F.sum("tokens")).first()[0] == tokens and N.shard_count(blocks, 8) == 8
    monkeypatch.setattr(N, "SHARD_TOKENS", 200)
    assert N.shard_count(blocks, 8) == -(-tokens // 200) > 8
    monkeypatch.setattr(N, "SHARD_WORDS", 1)
    assert N.shard_count(blocks, 8) >= 9
    assert N.shard_count(blocks.limit(0), 8) == 8
    check(N.train_and_score(docs).collect(), brute(ROWS))
