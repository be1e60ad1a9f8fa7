"""Files of the sinks: small driver-side notes, and listings and copies that tasks make.

The driver touches folders and single small files only.  ``listing`` walks a directory tree level by level:
the directories of a level are a table, tasks list them, and only the number of directories below reaches
the driver.  ``copy_tree`` copies a folder to another store by a manifest that tasks work through.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.stage import materialize
from ..session import ship_code

COPY_BYTES = 4 << 20
#: Directories, and files, that a task is given at once (about).
DIRS_PER_TASK = 32
FILES_PER_TASK = 64
#: Entries of a directory listing that a task hands on at a time.
LISTED_ROWS = 10_000
LISTING = "path string, length long, modificationTime timestamp, is_dir boolean"


def file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def delete_if_empty(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    if fs.exists(p) and not len(fs.listStatus(p)):
        fs.delete(p, False)


def qualified(spark: SparkSession, path: str) -> str:
    fs, p = file_system(spark, path)
    return fs.makeQualified(p).toString().rstrip("/")


def same_store(spark: SparkSession, a: str, b: str) -> bool:
    return file_system(spark, a)[0].getUri().equals(file_system(spark, b)[0].getUri())


def read_small(spark: SparkSession, path: str) -> str:
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    fs, p = file_system(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def create_exclusive(spark: SparkSession, path: str, text: str) -> bool:
    """Make the file with all its text, or return False if it is there: of two callers one succeeds.

    The text is written beside and moved into place.  A local rename would replace an existing file, so
    there a hard link is made, which fails on one; HDFS refuses to rename onto a file."""
    fs, p = file_system(spark, path)
    beside = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    write_small(spark, beside, text)
    _, b = file_system(spark, beside)
    try:
        if fs.getUri().getScheme() == "file":
            try:
                os.link(b.toUri().getPath(), p.toUri().getPath())
            except FileExistsError:
                return False
            return True
        return not fs.exists(p) and bool(fs.rename(b, p))
    finally:
        fs.delete(b, False)


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and plain path of a Hadoop path (which is not percent-encoded), for use in tasks."""
    m = re.match(r"([A-Za-z][\w+.-]*):(?://([^/]*))?(/.*)", path)
    if not m or m[1] == "file":
        return pafs.LocalFileSystem(), m[3] if m else path
    fs, root = pafs.FileSystem.from_uri(f"{m[1]}://{m[2] or ''}/")
    return fs, root.rstrip("/") + m[3]


# ---------------------------------------------------------------- listing

def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in LISTING.split(", ")]
    for b in batches:
        for folder in b.column(0).to_pylist():
            fs, plain = open_store(folder)
            found = [x for x in fs.get_file_info(pafs.FileSelector(plain, allow_not_found=True)) if not x.base_name.startswith(("_", "."))]
            for at in range(0, len(found), LISTED_ROWS):
                part = found[at: at + LISTED_ROWS]
                yield pa.RecordBatch.from_arrays([
                    pa.array([f"{folder}/{x.base_name}" for x in part]), pa.array([x.size or 0 for x in part], pa.int64()),
                    pa.array([(x.mtime_ns or 0) // 1000 for x in part], pa.timestamp("us", "UTC")), pa.array([x.type == pafs.FileType.Directory for x in part])], names)


def listing(spark: SparkSession, root: str) -> DataFrame:
    """``path``, ``length`` and ``modificationTime`` of every data file under ``root`` (names that begin
    with ``_`` or ``.`` are skipped); contents are not read.  One job for each level of directories."""
    ship_code(spark)
    files = None
    now, many = spark.createDataFrame([(qualified(spark, root),)], "path string"), 1
    while many:
        level = materialize(now.repartition(min(4096, 1 + many // DIRS_PER_TASK)).mapInArrow(_children, LISTING), "listing")
        here = level.where("not is_dir").drop("is_dir")
        files = here if files is None else files.unionByName(here)
        now = level.where("is_dir").select("path")
        many = now.count()
    return files


# ---------------------------------------------------------------- copies

def done(n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])


def _copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for source, target, length in zip(*(b.column(i).to_pylist() for i in range(3))):
            sfs, s = open_store(source)
            tfs, t = open_store(target)
            there = tfs.get_file_info(t)
            if there.type == pafs.FileType.NotFound or there.size != length:  # else copied by an earlier attempt
                folder, name = t.rsplit("/", 1)
                tfs.create_dir(folder, recursive=True)
                part = f"{folder}/.{name}.{uuid.uuid4().hex}"
                with sfs.open_input_stream(s, compression=None) as f, tfs.open_output_stream(part, compression=None) as sink:
                    while data := f.read(COPY_BYTES):
                        sink.write(data)
                tfs.move(part, t)
        yield done(b.num_rows)


def copy_tree(spark: SparkSession, source: str, target: str) -> int:
    """Copy the data files under ``source`` to ``target``, in tasks; files that stand there whole are left.
    A file appears under its name only when it is complete, so a copy that failed goes on where it was."""
    root, to = qualified(spark, source), qualified(spark, target)
    manifest = listing(spark, source).select("path", F.concat(F.lit(to), F.substring("path", len(root) + 1, 1 << 30)).alias("target"), "length")
    n = manifest.count()
    if n:
        manifest.repartition(1 + n // FILES_PER_TASK).mapInArrow(_copy, "n long").agg(F.sum("n")).first()
    return n
