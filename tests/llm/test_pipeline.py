import corpus_pipeline as C
from sojourn.llm import rules, secrets, simhash, winnow
from sojourn.llm.common import read_table, stage_table

SF = "/root/testdata/sf0.01"


def test_stages_take_effect(spark):
    docs = read_table(spark, SF, "documents")
    columns, names = docs.columns, [n for n, _ in C.STAGES]
    assert names == ["quality rules", "near duplicates", "decontamination", "secret scan", "encoding"]
    kept = []
    for _, stage in C.STAGES[:-1]:
        docs = stage_table(stage(spark, docs, SF), "pipeline_test")
        assert docs.columns == columns
        kept.append({r.doc_id: r.text for r in docs.collect()})
    whole = {r.doc_id: r.text for r in read_table(spark, SF, "documents").collect()}
    judged = {r.doc_id: r.kept for r in rules.op10_quality_rules(spark, SF).collect()}
    assert set(kept[0]) == {i for i, ok in judged.items() if ok} and all(whole[i] == t for i, t in kept[0].items())
    groups = simhash.near_duplicates(spark.createDataFrame(list(kept[0].items()), "doc_id long, text string"))
    assert set(kept[1]) == {r.component_id for r in groups.collect()}
    found = winnow.decontaminate(spark.createDataFrame(list(kept[1].items()), "doc_id long, text string"), read_table(spark, SF, "benchmark"))
    assert set(kept[2]) == {r.doc_id for r in found.collect() if not r.n_hit}
    assert set(kept[3]) == set(kept[2])
    spans = {r.blob: r.found for r in secrets.scan_versions(spark.createDataFrame([(t,) for t in kept[2].values()], "content string"))[1].collect()}
    import hashlib
    for i, t in kept[2].items():
        assert (kept[3][i] != t) == bool(spans[hashlib.sha256(t.encode()).hexdigest()])
    last = C.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in last} == set(kept[3]) and all(len(r.ids) > 0 for r in last)


def test_stages_take_odd_documents(spark):
    text = " ".join(f"word{i} of this text" for i in range(20))
    rows = [(1, text, "en", "s", 3, "k"), (1, text, "en", "s", None, "k"), (None, text + " more", None, None, 1, None), (2, None, "en", "s", 0, "k"), (3, "", "en", "s", 0, "k"),
            (4, text.replace("word", "term") + " token = 'abcdefgh12'", "xx", "s", 9, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp string")
    for data in (docs, docs.limit(0)):
        for _, stage in C.STAGES[:-1]:
            data = stage_table(stage(spark, data, SF), "pipeline_test")
            assert data.columns == docs.columns
        out = C.STAGES[-1][1](spark, data, SF)
        assert out.count() == data.count()


def test_run(spark):
    assert C.run(spark, "/root/testdata/sf0.001").count() > 0
