import collections
import math

import pytest

from sojourn.llm import kneser as K


def tokens(text):
    return ["<", "<", *(c.lower() if "A" <= c <= "Z" else c for c in text or ""), ">>"]


def level(counts):
    n = [0, *(sum(v == k for v in counts.values()) for k in (1, 2, 3, 4))]
    y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0.5
    d = {k: min(float(k), max(0.1, k - (k + 1) * y * n[k + 1] / n[k] if n[k] else k / 2)) for k in (1, 2, 3)}
    total, left = collections.Counter(), collections.Counter()
    for g, v in counts.items():
        total[g[:-1]] += v
        left[g[:-1]] += d[min(v, 3)]
    return {g: (v - d[min(v, 3)]) / total[g[:-1]] for g, v in counts.items()}, {c: left[c] / total[c] for c in total}


def brute(trusted, text):
    three = collections.Counter()
    for t in trusted:
        w = tokens(t)
        three.update(zip(w, w[1:], w[2:]))
    two = collections.Counter(g[1:] for g in three)
    one = collections.Counter(g[1:] for g in two)
    (a3, g3), (a2, g2), (a1, g1) = level(three), level(two), level(one)
    w, out = tokens(text), 0.0
    for a, b, c in zip(w, w[1:], w[2:]):
        p = a1.get((c,), 0) + g1[()] / (len(one) + 1)
        p = a2.get((b, c), 0) + g2.get((b,), 1) * p
        out += math.log10(a3.get((a, b, c), 0) + g3.get((a, b), 1) * p)
    return out, len(w) - 2


def test_probabilities_equal_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = K.read_table(spark, sf, "documents")
    labels = K.read_table(spark, sf, "labels")
    good = {r.doc_id for r in labels.collect() if r.quality and not r.toxic}
    rows = docs.collect()
    trusted = collections.defaultdict(list)
    for r in rows:
        if r.doc_id in good:
            trusted[r.lang].append(r.text)
    got = {r.doc_id: r for r in K.classify(docs, labels).collect()}
    assert len(got) == len(rows)
    for r in rows[:60]:
        if r.lang in trusted and len(r.text) < 6000:
            log, n = brute(trusted[r.lang], r.text)
            assert got[r.doc_id].n_tokens == n and got[r.doc_id].log10_prob == pytest.approx(log, rel=1e-9)
            assert got[r.doc_id].perplexity == pytest.approx(10 ** (-log / n), rel=1e-9)


def test_query_keeps_good_text(spark):
    sf = "/root/testdata/sf0.01"
    got = K.op7_kneser_ney(spark, sf).toPandas().merge(K.read_table(spark, sf, "labels").toPandas(), on="doc_id")
    assert got[(got.quality == 1) & (got.toxic == 0)].kept.mean() > 0.995
    assert got[got.quality == 0].kept.mean() < 0.3


def test_odd_rows(spark):
    rows = [(1, "en", "hello there"), (2, "en", "hello here"), (3, None, "x"), (4, "xx", "no trusted text"), (5, "en", None), (5, "en", ""), (None, "en", "😀#%"), (6, "a\n\\n=", "lines")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, lang string, text string, perplexity double").repartition(2)
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, None), (3, 1, 1), (None, 1, 0), (4, None, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    got = K.classify(docs, labels).collect()
    assert sorted(repr((r.doc_id, r.lang)) for r in got) == sorted(repr((i, x)) for i, x, _ in rows)
    by = {r.doc_id: r for r in got}
    assert by[3].perplexity is None and by[3].kept and by[4].threshold is None and by[4].kept
    assert by[1].kept and by[2].kept and not by[None].kept
    log, n = brute(["hello there", "hello here"], "")
    assert [(r.log10_prob, r.n_tokens) for r in got if r.doc_id == 5] == [(pytest.approx(log), n)] * 2
    assert all(r.kept for r in K.classify(docs, labels.limit(0)).collect())
    assert K.classify(docs.limit(0), labels).count() == 0


def test_trusted_rows_are_bounded(spark):
    labels = spark.range(100).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    assert K.trusted_ids(labels, 7).count() == 7


def test_every_trusted_row_counts(spark):
    """A rare language among more than 20,000 trusted rows has its model and threshold from all its trusted documents."""
    labels = spark.range(20_010).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    first = K.trusted_ids(labels, 20_000)
    a, b, c = (r.doc_id for r in labels.join(first, "doc_id", "left_anti").orderBy("doc_id").limit(3).collect())
    rare = [(a, "rr", "hello there"), (b, "rr", "hello here"), (c, "rr", "well then"), (30_000, "rr", "0#%0#%"), (30_001, "rr", None)]
    docs = first.selectExpr("doc_id", "'en' AS lang", "concat('w', doc_id % 10) AS text").union(spark.createDataFrame(rare, "doc_id long, lang string, text string"))
    assert K.trusted_ids(labels).count() == 20_010
    got = {r.doc_id: r for r in K.classify(docs, labels).where("lang = 'rr'").collect()}
    for i, _, text in rare:
        log, size = brute(["hello there", "hello here", "well then"], text)
        assert got[i].n_tokens == size and got[i].log10_prob == pytest.approx(log, rel=1e-9)
    assert [got[i].kept for i, _, _ in rare[:4]] == [True, True, True, False]
    worst = max(got[i].perplexity for i in (a, b, c))
    assert worst <= got[a].threshold <= worst * K.MARGIN * 10 ** (1 / K.BINS)
