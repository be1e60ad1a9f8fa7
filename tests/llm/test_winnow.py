import hashlib
import random
import re

import numpy as np

from sojourn.llm import winnow as W
from tests.harness import compare, duck

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[k: k + n]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                owners = windows.get(tuple(w[k: k + n]))
                if owners is not None:
                    hit |= set(range(k, k + n))
                    found |= owners
        found = sorted(str(x) for x in found if x is not None)
        out.append((d, len(w), len(hit), found))
    return out


def order(rows):
    return sorted(rows, key=repr)


def check(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, n_words int")
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, len string")
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in W.decontaminate(d, b).collect()]
    want = brute(docs, items)
    assert order(got) == order(want)
    kept = W.drop_contaminated(d, b)
    assert kept.columns == d.columns
    clean = [(i, t) for (i, t), w in zip(docs, want) if w[2] == 0]
    assert order((r.doc_id, r.text) for r in kept.collect()) == order(clean)


def test_random_texts(spark):
    rng = random.Random(4)
    items = [(i, " ".join(rng.choice("abcdefg") for _ in range(rng.choice([0, 1, 2, 3, 9, 10, 11, 14, 30])))) for i in range(30)]
    items += [(3, items[-1][1]), (None, "N U L L a a a a a a"), (7, None)]
    docs = []
    for i in range(60):
        parts = [" ".join(rng.choice("abcdefghij") for _ in range(rng.randint(0, 12))) for _ in range(4)]
        parts.insert(rng.randint(0, 4), (rng.choice(items)[1] or "").upper())
        docs.append((i, " ; ".join(parts)))
    check(spark, docs + [(None, docs[0][1]), (5, "a"), (5, None), (8, ""), (8, "ü2é x")], items)


def test_long_windows_only(spark):
    rng = random.Random(9)
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(10, 40)))) for i in range(12)]
    docs = [(i, " ".join(rng.choice("abc") for _ in range(300))) for i in range(20)] + [(99, items[0][1] + ", " + items[1][1])]
    check(spark, docs, items)


def test_empty_tables(spark):
    check(spark, [(1, "a b c")], [])
    d = spark.createDataFrame([], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert W.decontaminate(d, b).count() == 0


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in W.read_table(spark, sf, "documents").collect()]
    items = [(r.item_id, r.text) for r in W.read_table(spark, sf, "benchmark").collect()]
    want = {d: (n, h, len(f), hashlib.sha256(",".join(f).encode()).hexdigest(), h > 0) for d, n, h, f in brute(docs, items)}
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in W.op2_winnowing(spark, sf).collect()}
    assert got == want and any(v[4] for v in want.values())
    ok, message = compare(W.op2_winnowing(spark, sf), duck(sf), W.ORACLE)
    assert ok, message


def test_winnowing_keeps_a_common_print_of_every_shared_window():
    rng = np.random.default_rng(1)
    for _ in range(200):
        shared = rng.integers(0, 3, 10).astype(np.uint64)  # few words: many equal hashes
        kept = []
        for _ in range(2):
            w = np.concatenate([rng.integers(0, 3, rng.integers(0, 9)).astype(np.uint64), shared, rng.integers(0, 3, rng.integers(0, 9)).astype(np.uint64)])
            g = W.gram_hashes(w, W.GRAM)
            kept.append(set(g[W.winnow(g, 6)].tolist()))
        assert kept[0] & kept[1]
