import re

import numpy as np

from sojourn.llm import rules as R
from sojourn.llm.common import read_table


def brute(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i: i + 8]) for i in range(len(words) - 7)]
    many = {w for w in windows if windows.count(w) > 1} if len(words) < 400 else None
    if many is None:
        from collections import Counter
        many = {w for w, n in Counter(windows).items() if n > 1}
    hit = {k for i, w in enumerate(windows) if w in many for k in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_stats_equal_brute_force(spark):
    texts = ["", " \n\t ", "one", "a b c é😀 #*", "x\ny\nx\n\n\nx ", "a b c d e f g h " * 3, "w " * 9, "a\x1cb \x0b c\x85d", "l one\r\nl one\r\n", None,
             " ".join(str(i % 13) for i in range(60)), "<p>|&$%"]
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    got = {r.doc_id: tuple(r)[1:] for r in R.rule_stats(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_stats_on_the_table(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    got = {r.doc_id: tuple(r)[1:] for r in R.rule_stats(docs).collect()}
    assert got == {r.doc_id: brute(r.text) for r in docs.collect()}


def test_query_keeps_good_and_drops_junk(spark):
    rows = R.op10_quality_rules(spark, "/root/testdata/sf0.01").toPandas()
    labels = read_table(spark, "/root/testdata/sf0.01", "labels").toPandas()
    met = rows.merge(labels, on="doc_id")
    met = met[~met.base_failed]
    assert len(rows) == 1000
    assert (rows.base_failed == ((rows.n_words < 20) | (100 * rows.n_repeat_words > 30 * rows.n_words))).all()
    assert not rows[rows.base_failed].kept.any()
    assert met[met.quality == 1].kept.mean() > 0.995
    assert met[met.quality == 0].kept.mean() < 0.3


def test_no_labels_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "word " * 5), (None, " ".join(f"w{i}" for i in range(30))), (1, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = sorted((r.n_words, r.base_failed, r.kept) for r in R.quality_rules(docs, labels).collect())
    assert got == [(0, True, False), (5, True, False), (30, False, True)]
    assert R.quality_rules(docs.limit(0), labels).count() == 0
    kept = R.keep_good(docs.selectExpr("*", "1 AS kept", "'x' AS n_words"), labels)
    assert kept.columns == ["doc_id", "text", "kept", "n_words"] and kept.count() == 1


def test_threshold_keeps_good_rows():
    assert R.calibrate([(10, 100, 0), (90, 0, 5)]) * R.SCORE_BINS > 10
    assert R.calibrate([(10, 100, 0), (90, 0, 5)]) * R.SCORE_BINS < 90
    assert R.calibrate([]) > 1
    at = R.calibrate([(10, 10000, 0), (50, 5, 9), (90, 1, 5)])
    assert 0.0011 <= at <= 0.005


def test_forest_scores_far_points_higher():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 2))
    f = R.fit_forest(x, 100, 64, 1)
    s = f.score(np.array([[0.0, 0.0], [8.0, 8.0]]))
    assert s[1] > s[0] + 0.2
    same = R.fit_forest(np.ones((5, 2)), 10, 4, 1).score(np.ones((3, 2)))
    assert np.isfinite(same).all()
