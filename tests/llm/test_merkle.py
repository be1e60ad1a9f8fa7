import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from sojourn.llm import merkle as M
from sojourn.llm.ranks import ranked
from tests.harness import compare, duck

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(r, more=0):
    doc_id, text, lang, source, n = r
    values = [doc_id, source, lang, None if n is None else n + more, text]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i: i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, order = {}, {}
    for lang in langs:
        order[lang] = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = levels([leaf(r) for r in order[lang]])
    top = levels([trees[lang][-1][0] for lang in langs])
    out = []
    for at, lang in enumerate(langs):
        for i, r in enumerate(order[lang]):
            now = leaf(r, 1 if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 else 0)
            proof = ""
            for tree, k in ((trees[lang], i), (top, at)):
                for level in tree[:-1]:
                    other = level[k ^ 1] if k ^ 1 < len(level) else ""
                    proof += other
                    now = h(other, now) if k & 1 else h(now, other)
                    k >>= 1
            out.append((r[0], leaf(r), trees[lang][-1][0], top[-1][0], h(proof), now, now == top[-1][0]))
    return out


def found(spark, rows, parts=3):
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS g", "1 AS lo", "'d' AS digest", "2 AS rank", "3 AS n", "4 AS level").repartition(parts)
    return [tuple(r) for r in M.Manifest(docs, given=M.tampered(docs)).proofs().collect()]


def same(a, b):
    return sorted(a, key=repr) == sorted(b, key=repr)


def some(n, seed=1):
    rng = random.Random(seed)
    lang = lambda i: "en" if i % 3 else rng.choice(["de", "é", None, "", "one%d" % rng.randrange(4)])
    return [(rng.choice((i, i, None)), rng.choice(("text é", "", None, "x" * i)), lang(i), rng.choice(("a", None)), rng.choice((i, None))) for i in range(n)]


@pytest.mark.parametrize("band", [1, 2, 12])
def test_proofs_equal_brute_force(spark, monkeypatch, band):
    monkeypatch.setattr(M, "BAND", band)
    rows = some(75)
    assert same(found(spark, rows + rows[:5] * 3), brute(rows + rows[:5] * 3))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9])
def test_small_groups(spark, monkeypatch, n):
    monkeypatch.setattr(M, "BAND", 2)
    rows = [(i, f"t{i}", "en", "s", i) for i in range(n)]
    assert same(found(spark, rows), brute(rows))


def test_empty_table(spark):
    assert found(spark, []) == []


def test_nodes_are_nested_intervals(spark, monkeypatch):
    monkeypatch.setattr(M, "BAND", 2)
    rows = [(i, "t", "en" if i % 4 else "de", "s", 1) for i in range(50)]
    m = M.Manifest(spark.createDataFrame(rows, SCHEMA))
    nodes = {(r.g, r.level, r.lo): r for r in m.nodes().collect()}
    sizes = {"=en": 37, "=de": 13}
    assert {(k[0], k[1]) for k in nodes} == {(g, level) for g, n in sizes.items() for level in range(1, (n - 1).bit_length() + 1)}
    for (g, level, lo), r in nodes.items():
        assert lo == lo >> level << level and r.hi == min(lo + (1 << level), sizes[g]) - 1
        if level > 1:
            left, right = nodes[g, level - 1, lo], nodes.get((g, level - 1, lo + (1 << level - 1)))
            assert r.digest == h(left.digest, right.digest if right else "")
    assert all(r[0] for r in m.proofs().select("verified").collect())


def test_a_changed_byte_is_found(spark):
    rows = [(i, f"text {i}", "en", "s", 5) for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    other = M.leaf([F.when(F.col("doc_id") == 17, F.lit("text 17 ")).otherwise(F.col(c)) if c == "text" else F.col(c) for c in M.COLUMNS])
    bad = [r.doc_id for r in M.Manifest(docs, given=other).proofs().where("not verified").collect()]
    assert bad == [17]


def test_ranks_of_a_hot_group(spark):
    df = spark.range(20000).select((F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7))).alias("g"), F.xxhash64("id").alias("v"))
    got = ranked(df, "g", ["v"], "t-ranks").toPandas().sort_values(["g", "v"])
    assert (got["rank"] == got.groupby("g").cumcount()).all() and (got["n"] == got.groupby("g")["v"].transform("size")).all()


def test_very_long_text(spark):
    rows = [(1, "long text é " * 400_000, "en", "s", 1), (2, "short", "en", "s", 2)]
    assert same(found(spark, rows), brute(rows))


def test_op12_equals_its_sql(spark):
    ok, why = compare(M.op12_merkle_intervals(spark, SF), duck(SF), M.ORACLE)
    assert ok, why
