"""Append-only tables that are folded while readers go on."""

import os
from concurrent.futures import ThreadPoolExecutor

from sojourn.session import shared_dir
from sojourn.sinks import append, audit
from sojourn.streaming import incremental
from sojourn.streaming.incremental import CONTROL_SCHEMA, newest_rows, save_values, saved_value

SCHEMA = "id bigint, type string, name string, value string"


def put(spark, path, *rows):
    append.append_rows(spark, path, list(rows), SCHEMA)


def ids(df):
    return sorted(r.id for r in df.collect())


def test_folding_keeps_the_newest_rows_and_few_files(spark, monkeypatch):
    monkeypatch.setattr(append, "FOLD_FILES", 4)
    path = shared_dir(spark, "t-control")
    assert saved_value(spark, path, "job", "stopTime") is None
    for k in range(11):
        save_values(spark, path, "Job" if k % 2 else " job", {"stopTime": str(k), "resultNums": str(10 * k)})
        assert saved_value(spark, path, "job", "STOPTIME") == str(k) and saved_value(spark, path, "JOB", "resultNums") == str(10 * k)
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(parts) <= 2 * 4 and len(os.listdir(f"{path}/_bases")) <= 2 and incremental.read_control(spark, path).count() <= 2 + 2 * 4


def test_readers_that_began_before_a_fold_go_on(spark):
    path = shared_dir(spark, "t-readers")
    for k in range(5):
        put(spark, path, (k, "a", "n", str(k)))
    before = append.read_appended(spark, path, SCHEMA)
    assert append.fold(spark, path, SCHEMA, least=2) and ids(before) == ids(append.read_appended(spark, path, SCHEMA)) == list(range(5))
    put(spark, path, (5, "a", "n", "5"), (6, "b", "n", "6"))
    between = append.read_appended(spark, path, SCHEMA)
    assert append.fold(spark, path, SCHEMA, newest_rows, least=1)
    assert ids(between) == list(range(7)) and ids(append.read_appended(spark, path, SCHEMA)) == [5, 6]
    assert not append.fold(spark, path, SCHEMA, least=1)  # nothing new
    assert ids(append.read_appended(spark, path, SCHEMA)) == [5, 6]


def test_of_two_folds_at_a_time_one_counts(spark):
    path = shared_dir(spark, "t-two-folds")
    for k in range(6):
        put(spark, path, (k, "a", "n", str(k)))
    with ThreadPoolExecutor(3) as pool:
        won = [f.result() for f in [pool.submit(append.fold, spark, path, SCHEMA, None, 2) for _ in range(3)]]
    assert sum(won) >= 1 and ids(append.read_appended(spark, path, SCHEMA)) == list(range(6))


def test_rows_appended_during_a_fold_stay(spark):
    path = shared_dir(spark, "t-during")
    put(spark, path, (1, "a", "n", "1"))

    def keep(rows):
        put(spark, path, (2, "a", "m", "2"))  # after the fold has listed its files
        return newest_rows(rows)

    assert append.fold(spark, path, SCHEMA, keep, least=1)
    assert ids(append.read_appended(spark, path, SCHEMA)) == [1, 2]


def test_an_audit_keeps_every_line(spark, monkeypatch):
    monkeypatch.setattr(append, "FOLD_FILES", 3)
    monkeypatch.setattr(append, "FOLD_BASES", 2)
    path = shared_dir(spark, "t-audit-fold")
    for k in range(14):
        audit.audit_append(spark, path, "t", str(k), nbytes=k)
    assert sorted(int(r.content) for r in audit.read_audit(spark, path).collect()) == list(range(14))
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) <= 6
    assert CONTROL_SCHEMA == SCHEMA
