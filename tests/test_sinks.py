"""Line publishing, compaction, the audit table and the folders they use."""

import os
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from sojourn import session
from sojourn.catalog import _points
from sojourn.plans import jobs, stage, traces
from sojourn.session import shared_dir
from sojourn.sinks import audit_append, compact_lines, files, groups, lines, publish_lines, published, read_audit
from sojourn.sinks.files import listing
from sojourn.sinks.lines import read_lines, staged_bytes
from tests.conftest import SF_SMALL


def _lines(spark, n=500):
    return spark.range(n).select(F.col("id").alias("t"), F.concat(F.lit("line-"), F.col("id").cast("string")).alias("line"))


def _files(folder):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(folder) for f in fs if not f.startswith((".", "_")) and "/_" not in d)


def _texts(df):
    return sorted(r[0] for r in df.select("line").collect())


def test_publish_makes_the_asked_number_of_files(spark):
    df = _lines(spark)
    targets = [shared_dir(spark, "t-lib", str(i)) for i in range(3)]
    assert publish_lines(df, targets, num_files=4) == {"rows": 500, "max_t": 499}
    assert _texts(published(spark, targets)) == _texts(df)
    assert sum(len(_files(t)) for t in targets) == 4 and all(_files(t) for t in targets)
    assert not os.path.exists(f"{targets[0]}/_staging/x") and os.listdir(f"{targets[0]}/_staging") == []


def test_more_lines_than_the_asked_files_hold_make_more_files(spark):
    """No task writes more than about ``file_bytes``; a line may be null or hold longer characters."""
    df = _lines(spark, 4000).withColumn("line", F.when(F.col("t") % 9 != 0, F.concat("line", F.lit("é"))))
    for rows, files_made in ((df, 11), (df.where("t < 40"), 3)):
        texts = [r.line or "" for r in rows.collect()]
        size = sum(len(x.encode()) + 1 for x in texts)
        targets = [shared_dir(spark, "t-grow", str(i)) for i in range(2)]
        assert publish_lines(rows, targets, num_files=3, file_bytes=4000)["rows"] == len(texts)
        made = [os.path.getsize(f) for t in targets for f in _files(t)]
        assert _texts(published(spark, targets)) == sorted(texts)
        assert sum(made) == size and len(made) == files_made == max(3, -(-size // 4000)) and max(made) <= 5000


def test_a_run_that_failed_half_way_resumes_without_duplicates(spark, monkeypatch):
    df = _lines(spark)
    targets = [shared_dir(spark, "t-half", str(i)) for i in range(3)]
    real, calls = lines._move, []

    def second_fails(fs, src, dest):
        calls.append(dest)
        if len(calls) == 2:
            raise RuntimeError("refused")
        real(fs, src, dest)

    monkeypatch.setattr(lines, "_move", second_fails)
    with pytest.raises(RuntimeError):
        publish_lines(df, targets, num_files=5, run_id="job/1")
    monkeypatch.setattr(lines, "_move", real)
    assert 0 < len(_texts(published(spark, [t for t in targets if os.path.exists(t)]))) < 500
    assert publish_lines(df, targets, num_files=5, run_id="job/1") == {"rows": 500, "max_t": 499}
    assert publish_lines(_lines(spark, 7), targets, num_files=5, run_id="job/1") == {"rows": 500, "max_t": 499}
    assert _texts(published(spark, targets)) == _texts(df)


def test_an_empty_run_publishes_no_file(spark):
    target = shared_dir(spark, "t-empty")
    assert publish_lines(_lines(spark, 0), [target], run_id="e") == {"rows": 0, "max_t": None}
    assert publish_lines(_lines(spark).where("t < 0"), [target], run_id="f") == {"rows": 0, "max_t": None}
    assert _files(target) == []


def test_runs_whose_names_look_alike_both_publish(spark):
    ids = ["job/a-0-10", "job_a-0-10", "job%2Fa-0-10", ".x", "_x", "%2Ex", "..", "é", "x" * 400, "x" * 401]
    assert len({lines.run_name(i) for i in ids}) == len(ids)
    assert all(len(lines.run_name(i)) <= lines.NAME_BYTES and lines.run_name(i)[0] not in "._" for i in ids)
    target = shared_dir(spark, "t-clash")
    for k, i in enumerate(ids[:4] + ids[8:]):
        row = spark.createDataFrame([(k, f"line of run {k}")], "t long, line string")
        assert publish_lines(row, [target], run_id=i) == {"rows": 1, "max_t": k}
    assert _texts(published(spark, [target])) == [f"line of run {k}" for k in range(6)]


def test_of_two_runs_at_a_time_one_publishes(spark, monkeypatch):
    """Both stage their files before either claims the run."""
    targets = [shared_dir(spark, "t-two", str(i)) for i in range(2)]
    both, real = threading.Barrier(2), lines._stage

    def together(*args):
        stats = real(*args)
        both.wait(120)
        return stats

    monkeypatch.setattr(lines, "_stage", together)
    with ThreadPoolExecutor(2) as pool:
        got = [f.result() for f in [pool.submit(publish_lines, _lines(spark, n), targets, 3, "one") for n in (400, 500)]]
    assert got[0] == got[1] and got[0]["rows"] in (400, 500)
    assert _texts(published(spark, targets)) == _texts(_lines(spark, got[0]["rows"]))
    assert os.listdir(f"{targets[0]}/_staging") == [] and len(os.listdir(f"{targets[0]}/_committed")) <= 2


def test_an_exclusive_file_is_made_once(spark):
    path = f"{shared_dir(spark, 't-claim')}/marker"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: files.create_exclusive(spark, path, f"by {k}"), range(8)))
    assert sum(won) == 1 and files.read_small(spark, path) == f"by {won.index(True)}"


def test_an_attempt_without_a_claim_is_dropped_when_stale(spark, monkeypatch):
    target = shared_dir(spark, "t-stale")
    with monkeypatch.context() as m:
        m.setattr(lines, "create_exclusive", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            publish_lines(_lines(spark, 50), [target], run_id="r")
    assert len(os.listdir(f"{target}/_staging/r")) == 1
    monkeypatch.setattr(lines, "STALE_SECONDS", -10)
    assert publish_lines(_lines(spark, 60), [target], run_id="r")["rows"] == 60
    assert published(spark, [target]).count() == 60 and os.listdir(f"{target}/_staging") == []


def test_a_target_in_another_store_is_copied_by_tasks_and_resumes(spark, monkeypatch):
    targets = [shared_dir(spark, "t-store", str(i)) for i in range(2)]
    df = _lines(spark, 900)
    monkeypatch.setattr(lines, "same_store", lambda s, a, b: targets[1] not in b)
    real = lines._move

    def refused(fs, src, dest):
        if targets[1] in str(dest):
            raise RuntimeError("refused")
        real(fs, src, dest)

    monkeypatch.setattr(lines, "_move", refused)
    with pytest.raises(RuntimeError):
        publish_lines(df, targets, num_files=6, run_id="far")
    assert len(_files(targets[0])) == 3 and not os.path.exists(f"{targets[1]}/run=far")
    monkeypatch.setattr(lines, "_move", real)
    stats = publish_lines(df, targets, num_files=6, run_id="far")
    assert stats["rows"] == 900 and _texts(published(spark, targets)) == _texts(df) and all(_files(t) for t in targets)


def test_copied_files_are_not_copied_again(spark, tmp_path):
    (tmp_path / "in/a b").mkdir(parents=True)
    for k in range(20):
        (tmp_path / ("in" if k % 2 else "in/a b") / f"f{k}%.txt").write_bytes(b"\r\n\x00" * k)
    assert files.copy_tree(spark, str(tmp_path / "in"), str(tmp_path / "out")) == 20
    first = {f: os.stat(f).st_mtime_ns for f in _files(tmp_path / "out")}
    (tmp_path / "out/f1%.txt").write_bytes(b"cu")
    os.remove(tmp_path / "out/a b/f2%.txt")
    assert files.copy_tree(spark, str(tmp_path / "in"), str(tmp_path / "out")) == 20
    same = [f for f in first if os.stat(f).st_mtime_ns == first[f]]
    assert len(same) == 18
    assert {os.path.relpath(f, tmp_path / "out"): open(f, "rb").read() for f in _files(tmp_path / "out")} == \
        {os.path.relpath(f, tmp_path / "in"): open(f, "rb").read() for f in _files(tmp_path / "in")}


def test_listing_walks_the_levels(spark, tmp_path):
    want = []
    for d in ("", "a", "a/b c", "a/b c/é%20", "z=1"):
        (tmp_path / d).mkdir(exist_ok=True)
        for k in range(3):
            (tmp_path / d / f"f{k}").write_bytes(b"x" * k)
            want.append((f"file:{tmp_path / d / f'f{k}'}", k))
    (tmp_path / "_hidden").mkdir()
    (tmp_path / "_hidden/f").write_bytes(b"x")
    (tmp_path / "a/.part").write_bytes(b"x")
    assert sorted((r.path, r.length) for r in listing(spark, str(tmp_path)).collect()) == sorted(want)
    assert listing(spark, str(tmp_path / "absent")).count() == 0


@pytest.mark.parametrize("limit", [1000, 200_000])
def test_one_directory_of_many_files_is_cut_by_many_tasks(spark, monkeypatch, limit):
    monkeypatch.setattr(groups, "SLICE_FILES", 10_000)
    n = 200_000
    size = (F.pmod(F.xxhash64("id"), F.lit(300)) + 1).cast("long")
    found = spark.range(n, numPartitions=4).select(F.concat(F.lit("/in/"), F.when(F.col("id") % 50 == 0, F.concat(F.lit("d"), F.col("id") % 20_000)).otherwise("hot"), F.lit("/f"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("path"),
                                                  size.alias("length"), F.timestamp_millis(F.when(F.col("id") % 40 == 0, 0).otherwise(10**12)).alias("modificationTime"))
    got = groups.groups(found, limit, 1000, 10**12 + 5).toPandas()
    assert got["path"].is_unique
    each = got.groupby(["directory", "group"])["length"].agg(["sum", "size"])
    assert (each["sum"] < limit + 300).all()
    young = found.where(F.col("modificationTime") > F.timestamp_millis(F.lit(1))).toPandas()
    young["directory"] = young["path"].str.rsplit("/", n=1).str[0]
    left = young[~young["path"].isin(set(got["path"]))].groupby("directory")["length"].sum()
    assert (left < limit).all()  # what stays does not fill a group
    small = each[each["sum"] < limit].reset_index()
    assert small.groupby("directory").size().max() == 1  # the last of the old files only
    first = got[got["group"].str.startswith("0-")]
    per_task = first.groupby(first["group"].str.split("-").str[1]).size()
    assert len(per_task) >= 20 and per_task.max() <= 2 * per_task.mean()


def test_failed_rename_raises():
    class RefusingFS:
        def rename(self, src, dest):
            return False

    with pytest.raises(RuntimeError):
        lines._move(RefusingFS(), "staged/part-0", "library/part-0")


def test_compaction_publishes_full_groups_then_old_files(spark):
    staging, library = shared_dir(spark, "t-stage"), shared_dir(spark, "t-library")
    df = _lines(spark, 2000)
    df.select("line").repartition(20).write.text(staging)
    total = staged_bytes(spark, staging)
    first = compact_lines(spark, staging, library, limit_bytes=total // 4, limit_seconds=10 ** 9)
    assert 0 < first["files_in"] < 20 and first["files_out"] <= 4
    assert _texts(read_lines(spark, [library, staging])) == _texts(df)
    second = compact_lines(spark, staging, library, limit_bytes=total // 4, limit_seconds=0)
    assert first["files_in"] + second["files_in"] == 20 and _files(staging) == []
    assert read_lines(spark, [library]).count() == 2000


@pytest.mark.parametrize("aqe,parts", [("true", 1), ("false", 40)])
def test_compaction_keeps_bytes_and_sizes(spark, tmp_path, aqe, parts):
    """Carriage returns survive, one line may fill half the input, and sizes do not depend on the session."""
    staging, libraries = tmp_path / "in", [str(tmp_path / "lib0"), str(tmp_path / "lib1")]
    staging.mkdir()
    hot, want = b"the same line\n", []
    for k in range(60):
        data = hot * 400 + b"".join(b"%d-%d a\rb\r\n" % (k, i) for i in range(500))
        data = data[:-1] if k % 3 == 0 else data  # no final line feed
        (staging / f"f{k:03d}.txt").write_bytes(data)
        want += (data if data.endswith(b"\n") else data + b"\n").split(b"\n")[:-1]
    size = sum(f.stat().st_size for f in staging.iterdir())
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        limit = size // 20
        got = compact_lines(spark, str(staging), libraries, limit_bytes=limit, limit_seconds=0)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    out = [f for lib in libraries for f in _files(lib)]
    sizes = sorted(os.path.getsize(f) for f in out)
    assert got["files_in"] == 60 and got["files_out"] == len(out) >= 15
    assert sizes[1] >= limit and sizes[-1] < 2 * limit + 2  # the last group may be small
    assert all(os.path.isdir(lib) for lib in libraries)
    assert sorted(x for f in out for x in open(f, "rb").read().split(b"\n")[:-1]) == sorted(want)
    assert _files(staging) == []


def test_compaction_resumes_from_its_manifest(spark, monkeypatch):
    staging, library = shared_dir(spark, "t-again"), shared_dir(spark, "t-again-lib")
    df = _lines(spark, 900)
    df.select("line").repartition(9).write.text(staging)
    monkeypatch.setattr(lines, "_delete_sources", lines._merge_groups)  # outputs stand, sources stay
    monkeypatch.setattr(lines, "_delete", lambda spark, path: None)
    compact_lines(spark, staging, library, limit_bytes=1, limit_seconds=0)
    assert len(_files(staging)) == 9
    monkeypatch.undo()
    assert compact_lines(spark, staging, library, limit_bytes=10 ** 9, limit_seconds=0)["files_out"] == 9
    assert _files(staging) == [] and _texts(read_lines(spark, [library])) == _texts(df)
    assert compact_lines(spark, staging, library, limit_bytes=1, limit_seconds=0) == {"files_in": 0, "files_out": 0, "bytes": 0}


def test_compaction_mirrors_subdirectories(spark):
    staging, library = shared_dir(spark, "t-stage-nested"), shared_dir(spark, "t-library-nested")
    for sub, n in (("a", 300), ("b/c", 200), ("d e%", 100)):
        _lines(spark, n).select("line").repartition(5).write.text(f"{staging}/{sub}")
    assert compact_lines(spark, staging, library, limit_bytes=10 ** 9, limit_seconds=0)["files_in"] == 15
    for sub, n in (("a", 300), ("b/c", 200), ("d e%", 100)):
        assert read_lines(spark, [f"{library}/{sub}"]).count() == n
    assert listing(spark, staging).count() == 0


def test_audit_append(spark):
    path = shared_dir(spark, "t-audit")
    audit_append(spark, path, "job1", "app,1,2", ts="2024-01-01 00:00:00")
    audit_append(spark, path, "import", "ok", path="/x", nbytes=10, duration_ms=5)
    got = sorted((r.title, r.content, r.bytes) for r in read_audit(spark, path).collect())
    assert got == [("import", "ok", 10), ("job1", "app,1,2", None)]


def test_stage_tables_go_when_the_result_is_written(spark):
    made = []
    real = stage.shared_dir

    def noted(s, *parts):
        made.append(real(s, *parts))
        return made[-1]

    stage.shared_dir = noted
    try:
        target = shared_dir(spark, "t-scope")
        with stage.stage_tables(spark):
            publish_lines(jobs.segments_to_lines(traces.trace_relay(_points(spark, SF_SMALL)), "1"), [target])
    finally:
        stage.shared_dir = real
    assert made and not any(os.path.exists(p) for p in made) and _files(target)


def test_a_cluster_without_a_shared_folder_raises():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session(), "x")
    Session.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        session.shared_dir(Session(), "x")
