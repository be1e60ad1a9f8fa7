"""Line sinks: publish ``(t, line)`` rows as text files, and compact small files.

A run is named by its id, percent-encoded, so different ids never share a folder.  Every attempt at a run
stages its files in a folder of its own beside the first target.  An attempt that is complete claims the
run: it makes the commit marker, which holds the attempt and its statistics, by an exclusive create.  Of
several attempts at a time one gets the marker, the others drop what they staged.  Then one folder for each
target is renamed to ``<target>/run=<id>``; whoever finds a marker whose folders are still staged finishes
that.  Row count and newest time for the high-water mark are collected in the same pass as the write
(``observe``).  To a target in another store the files are copied by tasks first.

A file is one task's work, so an asked number of files holds only while they stay small: the lines are
measured before they are dealt, and a run too large for that many files of ``file_bytes`` makes more.

Compaction works on bytes: the listing is a table that tasks make, groups are cut over slices of it, and
every task streams the files of its groups into one output file.  No line is parsed, hashed or shuffled, so
a line's bytes (carriage returns too) and the size of an output depend on neither the shuffle setting nor
the lines.  A manifest written before the first output makes it restartable.

The driver handles one folder for each target, a marker and one manifest, never single files.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..plans.stage import stage_tables
from ..session import ship_code
from .files import COPY_BYTES, copy_tree, create_exclusive, delete_if_empty, done, listing, open_store, qualified, read_small, same_store
from .files import delete as _delete
from .files import exists as _exists
from .files import file_system as _fs
from .groups import groups

#: Attempts that staged files and were never finished are deleted by a later run after this many seconds.
STALE_SECONDS = 86400
#: A longer name is cut and carries its digest.
NAME_BYTES = 180
#: Bytes of a published file, and so of a writing task, before a run makes more files than asked (about).
FILE_BYTES = 128 << 20


def _move(fs, src, dest) -> None:
    """Rename; Hadoop reports failure by returning false, so check it."""
    if not fs.rename(src, dest):
        raise RuntimeError(f"could not move {src} to {dest}; staging left in place")


def run_name(run_id: str) -> str:
    """A file name for the run; different ids have different names."""
    name = quote(run_id, safe="")
    if name.startswith((".", "_")):  # hidden from readers of a folder
        name = f"%{ord(name[0]):02X}{name[1:]}"
    if len(name) > NAME_BYTES:  # "+" is no character of an encoded id
        name = f"{name[:NAME_BYTES - 65]}+{hashlib.sha256(run_id.encode()).hexdigest()}"
    return name


def staged_bytes(spark: SparkSession, root: str) -> int:
    """Total size of the data files under ``root`` (file metadata only)."""
    return int(listing(spark, root).agg(F.sum("length")).first()[0] or 0)


def read_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines of all files under ``paths``; only a line feed ends a line."""
    return (spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(list(paths))
            .select(F.col("value").alias("line")))


def published(spark: SparkSession, targets: Sequence[str]) -> DataFrame:
    """The lines that :func:`publish_lines` has put under ``targets``."""
    return read_lines(spark, targets)


def publish_lines(df: DataFrame, targets: Sequence[str], num_files: int | None = None, run_id: str | None = None,
                  file_bytes: int = FILE_BYTES) -> dict:
    """Write the ``line`` column of ``df`` under the ``targets`` directories.

    Each output partition goes to one target, so a run makes ``num_files`` files
    in all (fewer if there are fewer rows; more where these would be larger than
    ``file_bytes`` on average; without it, one per partition of ``df``).  With
    ``num_files`` the lines are evaluated twice, to measure and to write them: give
    a costly ``df`` as a stored table.  An empty run makes none.  ``run_id`` names the run: repeating it
    resumes or skips, and of runs at the same time one publishes, see the module
    notes.  Returns ``{"rows", "max_t"}``.
    """
    spark = df.sparkSession
    targets = [t.rstrip("/") for t in targets]
    run = run_name(run_id or uuid.uuid4().hex)
    marker, staging = f"{targets[0]}/_committed/{run}", f"{targets[0]}/_staging/{run}"
    if not _exists(spark, marker):
        _drop_stale(spark, staging)
        attempt = uuid.uuid4().hex
        stats = _stage(df, f"{staging}/{attempt}", len(targets), num_files, file_bytes)
        if not create_exclusive(spark, marker, json.dumps({**stats, "attempt": attempt})):
            _delete(spark, f"{staging}/{attempt}")
    committed = json.loads(read_small(spark, marker))
    staged = f"{staging}/{committed.get('attempt')}"
    if _exists(spark, staged):  # not yet promoted, or not wholly
        for k, target in enumerate(targets):
            _promote(spark, f"{staged}/_lib={k}", target, run)
        _delete(spark, staged)
    delete_if_empty(spark, staging)
    return {"rows": committed["rows"], "max_t": committed["max_t"]}


def _file_count(df: DataFrame, num_files: int, file_bytes: int) -> int:
    """The asked number of files, or as many as the lines fill (a null line is written as an empty one)."""
    size = df.agg(F.sum(F.coalesce(F.octet_length("line"), F.lit(0)) + 1)).first()[0] or 0
    return max(num_files, -(-size // file_bytes))


def _stage(df: DataFrame, staged: str, n_targets: int, num_files: int | None, file_bytes: int) -> dict:
    """Write the lines, a folder for each target; rows and newest time are observed on the way."""
    spark = df.sparkSession
    obs = Observation("publish")
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"), F.max("t").alias("max_t")).select("line")
    if num_files:
        out = out.repartition(_file_count(df, num_files, file_bytes))
    (out.withColumn("_lib", F.spark_partition_id() % n_targets)
        .write.partitionBy("_lib").option("lineSep", "\n").text(staged))
    fs, folders = _fs(spark, f"{staged}/_lib=*")
    got = obs.get if len(fs.globStatus(folders)) else {}  # Spark drops the observation of a plan it proves empty
    return {"rows": int(got.get("rows") or 0), "max_t": got.get("max_t")}


def _drop_stale(spark: SparkSession, staging: str) -> None:
    """Attempts at the run that were given up; one that may still be at work is let alone."""
    fs, p = _fs(spark, staging)
    if fs.exists(p):
        for s in fs.listStatus(p):
            if s.getModificationTime() < (time.time() - STALE_SECONDS) * 1000:
                fs.delete(s.getPath(), True)


def _promote(spark: SparkSession, staged: str, target: str, run: str) -> None:
    """Rename a staged folder to ``<target>/run=<run>``; in another store it is copied beside first."""
    fs, src = _fs(spark, staged)
    if not fs.exists(src):  # no partition of this target, or promoted by an earlier attempt
        return
    tfs, dest = _fs(spark, f"{target}/run={run}")
    if tfs.exists(dest):  # copied and promoted; only the staged original was left
        return
    if not same_store(spark, staged, target):
        beside = f"{target}/_staging/{run}"
        copy_tree(spark, staged, beside)
        if tfs.exists(dest):  # another run of the same id was faster
            _delete(spark, beside)
            return
        tfs, src = _fs(spark, beside)
    tfs.mkdirs(dest.getParent())
    try:
        _move(tfs, src, dest)
    except Exception:
        if tfs.exists(src) or not tfs.exists(dest):  # else another run of the same id has moved it
            raise


def compact_lines(spark: SparkSession, staging: str, library: str | Sequence[str], limit_bytes: int,
                  limit_seconds: float, now_ms: int | None = None) -> dict:
    """Merge small staged line files into files of at least ``limit_bytes``, less than that plus one file.

    Per staging directory, files older than ``limit_seconds`` are published; younger files are taken into
    groups that reach ``limit_bytes`` and full groups are published; the rest stay staged for a later run.  A group becomes one file under the same relative path of one of the ``library``
    folders (dealt by a hash of the group).  A file without a final line feed gets one, so it does not
    fuse with the next.  Sources are deleted only after all outputs stand; a run that stopped half-way is
    finished first by the next call.
    """
    ship_code(spark)
    now_ms = int(time.time() * 1000) if now_ms is None else now_ms
    libraries = [library.rstrip("/")] if isinstance(library, str) else [x.rstrip("/") for x in library]
    plan = f"{staging.rstrip('/')}/_compaction"
    if not _exists(spark, f"{plan}/_SUCCESS"):
        _delete(spark, plan)
        root = qualified(spark, staging)
        run = uuid.uuid4().hex
        folders = [qualified(spark, x) for x in libraries]
        key = F.xxhash64("directory", "group")
        lib = F.element_at(F.array(*map(F.lit, folders)), (F.pmod(key, F.lit(len(folders))) + 1).cast("int"))
        with stage_tables(spark):
            (groups(listing(spark, staging), limit_bytes, limit_seconds, now_ms)
             .groupBy("directory", "group").agg(F.array_sort(F.collect_list("path")).alias("paths"), F.sum("length").alias("bytes"))
             .select(F.concat(lib, F.substring(F.col("directory"), len(root) + 1, 1 << 30), F.lit(f"/merged-{run}-"), F.hex(key), F.lit(".txt")).alias("out"),
                     "paths", "bytes")
             .write.parquet(plan))
    manifest = spark.read.schema("out string, paths array<string>, bytes long").parquet(plan)
    n_out, n_in, size = manifest.agg(F.count("*"), F.sum(F.size("paths")), F.sum("bytes")).first()
    if n_out:
        tasks = min(n_out, 10 * spark.sparkContext.defaultParallelism)
        dealt = manifest.select("out", "paths").repartition(tasks)
        for step in (_merge_groups, _delete_sources):
            dealt.mapInArrow(step, "n long").agg(F.sum("n")).first()
    _delete(spark, plan)
    return {"files_in": int(n_in or 0), "files_out": int(n_out), "bytes": int(size or 0)}


def _merge_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for out, paths in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            fs, final = open_store(out)
            if fs.get_file_info(final).type == pafs.FileType.NotFound:  # else made by an earlier attempt
                folder, name = final.rsplit("/", 1)
                fs.create_dir(folder, recursive=True)
                part = f"{folder}/.{name}.{uuid.uuid4().hex}"
                with fs.open_output_stream(part, compression=None) as sink:
                    for path in paths:
                        sfs, source = open_store(path)
                        end = b"\n"
                        with sfs.open_input_stream(source, compression=None) as f:
                            while data := f.read(COPY_BYTES):
                                sink.write(data)
                                end = data[-1:]
                        if end != b"\n":
                            sink.write(b"\n")
                fs.move(part, final)
        yield done(b.num_rows)


def _delete_sources(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for paths in b.column(1).to_pylist():
            for path in paths:
                fs, source = open_store(path)
                if fs.get_file_info(source).type != pafs.FileType.NotFound:
                    fs.delete_file(source)
        yield done(b.num_rows)
