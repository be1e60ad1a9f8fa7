import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from sojourn.llm import components as C
from sojourn.llm import simhash as S
from sojourn.llm.components import components


def brute_print(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    if not words:
        return 0
    runs = [" ".join(words[i: i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(prints):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(prints))]


def test_golay_code_is_perfect():
    table = S.decoder()
    assert (np.bincount(table.astype(np.int64)) == 2048).all()


def test_every_pair_within_three_bits_shares_a_key():
    rng = random.Random(5)
    a = np.array([rng.getrandbits(64) for _ in range(400)], np.uint64)
    for bits in (1, 2, 3):
        b = np.array([int(x) ^ sum(1 << k for k in rng.sample(range(64), bits)) for x in a], np.uint64)
        filed, _ = S.keys(a.view(np.int64))
        _, probed = S.keys(b.view(np.int64))
        mine = {(k, r) for key, row in filed for k, r in zip(key.tolist(), row.tolist())}
        hit = {r for key, row in probed for k, r in zip(key.tolist(), row.tolist()) if (k, r) in mine}
        assert len(hit) == len(a)


def test_components_equal_brute_force(spark):
    rng = random.Random(2)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(200):  # chains and dense balls
        prints.append(rng.choice(prints) ^ sum(1 << k for k in rng.sample(range(64), rng.randint(1, 4))))
    prints += [0, 1, (1 << 64) - 1, 1 << 63]
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = components(S.links(spark.createDataFrame([(p,) for p in signed], "fp long").repartition(3)))
    root = {r.node: r.root for r in found.collect()}
    want = brute_groups(prints)
    groups = {}
    for p, g in zip(signed, want):
        groups.setdefault(g, set()).add(root.get(p, p))
    assert all(len(x) == 1 for x in groups.values()) and len({next(iter(x)) for x in groups.values()}) == len(groups)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = S.read_table(spark, sf, "documents").collect()
    prints = [brute_print(r.text) for r in docs]
    group = brute_groups(prints)
    least = {}
    for r, g in zip(docs, group):
        least[g] = min(least.get(g, r.doc_id), r.doc_id)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.op4_simhash_golay(spark, sf).collect()}
    assert got == {r.doc_id: (f"{p:016x}", least[g]) for r, p, g in zip(docs, prints, group)}


def test_odd_rows(spark):
    texts = [(3, None), (1, ""), (None, " \n"), (7, "One two"), (7, "one  TWO"), (None, "other words here now"), (9, "other words here now"), (5, "É é"), (6, "é é")]
    docs = spark.createDataFrame([(i, t, "k") for i, t in texts], "doc_id long, text string, fp string")
    got = sorted(((r.doc_id or -1), r.component_id) for r in S.near_duplicates(docs).collect())
    assert got == sorted([(3, 1), (1, 1), (-1, 1), (7, 7), (7, 7), (-1, 9), (9, 9), (5, 5), (6, 6)])
    kept = S.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 5, 6, 7, 9]
    assert S.near_duplicates(docs.limit(0)).count() == 0 and S.one_of_each(docs.limit(0)).count() == 0


def test_one_of_each_whatever_the_bitmap_lists(spark, monkeypatch):
    """Copies, repeated rows, one id with two texts and rows without an id; with few and with all rows in doubt."""
    rows = [(i, f"text number {i % 40} of " + " ".join(f"w{i % 40 * k}" for k in range(30)), i) for i in range(60)]
    rows += [(5, "quite other words under a known id", 100), (5, rows[5][1], 101), (None, rows[7][1], 102), (None, "a text that no other row has at all", 103),
             (None, "a text that no other row has at all", 104)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").repartition(4)
    group = brute_groups([brute_print(t) for _, t, _ in rows])
    least = {}
    for (i, _, _), g in zip(rows, group):
        least[g] = min(least.get(g, (True, 0)), (i is None, i or 0))
    want = sorted({(i or -1, t) for (i, t, _), g in zip(rows, group) if least[g] == (i is None, i or 0)})
    for bits in (S.bitmap_bits, lambda wanted: 64):
        monkeypatch.setattr(S, "bitmap_bits", bits)
        kept = S.one_of_each(docs)
        assert kept.columns == docs.columns
        assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == want


def test_groups_cut_by_batches(spark, monkeypatch):
    key = np.repeat(np.arange(50), 8)
    probe = np.tile(np.arange(8) >= 4, 50)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**62, 50)
    fp = np.repeat(base, 8) ^ (1 << rng.integers(0, 62, 400))
    whole = S._links(key, probe, fp, 3)
    monkeypatch.setattr(S, "BLOCK_PAIRS", 5)
    parts = S._links(key, probe, fp, 3)
    assert len(whole[0]) == len(parts[0]) > 0
    assert (np.bitwise_count((parts[0] ^ parts[1]).view(np.uint64)) <= 3).all()


def test_the_edges_of_a_hub_are_spread(spark, monkeypatch):
    """One node with four fifths of all edge ends: no task has over twice the mean."""
    monkeypatch.setattr(C, "HUB", 1000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        n = 100_000
        edges = spark.range(n, numPartitions=8).selectExpr("if(id % 5 < 4, 7, id + 1000000) AS u", "id + 5000000 AS v")
        both = edges.unionByName(edges.selectExpr("v AS u", "u AS v"))
        got = C._star(both, 2 * n)
        tasks = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(tasks) == 2 * n and max(tasks) <= 2 * 2 * n / len(tasks)
        assert got.where("u = 7").select("m").distinct().collect() == [(7,)]
        roots = {r.node: r.root for r in components(edges).collect()}
        assert len(roots) == n + 1 + n // 5 and all(r == (7 if (node - 5000000) % 5 < 4 else node - 4000000) for node, r in roots.items() if node >= 5000000)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
