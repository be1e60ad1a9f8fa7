"""Cutting listed files into groups by size, over slices.

A group is a run of files that reaches the limit with its last file.  Cutting one long list this way is a
walk; here the list is cut into slices of about equal numbers of files, each slice is walked on its own,
and the files that a slice leaves open at one of its ends meet the open files of its neighbours in the next
round, over an eighth as many slices.  A group never has less than the limit (but for the last files of a
directory) and always less than the limit and one file.  A directory that lies inside a slice is done at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.stage import materialize

#: Files of a slice (about).
SLICE_FILES = 20_000
FEWER = 8
GROUPED = "directory string, old boolean, path string, length long, `group` string, open boolean"


def _walk(round_: int, slices: int, limit: int):
    """Files sorted by directory and age: numbered groups; what is left over of the first and the last
    directory of a slice stays open (its other files may be in the next slice), else it is the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        now, number, size, first = None, 0, 0, True
        held: list[tuple] = []  # files of the group that is being filled

        def closed(rows: list[tuple], group: str | None, is_open: bool) -> pa.RecordBatch:
            folder, old = now
            n = len(rows)
            return pa.RecordBatch.from_arrays([
                pa.array([folder] * n), pa.array([old] * n), pa.array([p for p, _ in rows]), pa.array([s for _, s in rows], pa.int64()),
                pa.array([group] * n, pa.string()), pa.array([is_open] * n)], ["directory", "old", "path", "length", "group", "open"])

        def left(last: bool) -> pa.RecordBatch:
            if slices > 1 and (first or last):
                return closed(held, None, True)
            return closed(held, name() if now[1] else None, False)

        def name() -> str:
            return f"{round_}-{part}-{number}"

        for b in batches:
            for folder, old, path, length in zip(*(b.column(i).to_pylist() for i in range(4))):
                if now != (folder, old):
                    if held:
                        yield left(False)
                    first = now is None
                    now, held, size, number = (folder, old), [], 0, number + 1
                held.append((path, length))
                size += length
                if size >= limit:
                    yield closed(held, name(), False)
                    held, size, number = [], 0, number + 1
        if held:
            yield left(True)

    return run


def groups(files: DataFrame, limit_bytes: int, limit_seconds: float, now_ms: int) -> DataFrame:
    """Per directory: files older than ``limit_seconds``, and younger ones as far as they fill groups of
    ``limit_bytes``; ``directory``, ``group``, ``path``, ``length``."""
    old = F.lit(now_ms) - F.unix_millis("modificationTime") >= limit_seconds * 1000
    now = materialize(files.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("directory"), old.alias("old"), "path", "length"), "files")
    slices, round_, out = 1 + now.count() // SLICE_FILES, 0, None
    while True:
        dealt = now.repartitionByRange(slices, "directory", "old", "path") if slices > 1 else now.coalesce(1)
        walked = materialize(dealt.sortWithinPartitions("directory", "old", "path").mapInArrow(_walk(round_, slices, limit_bytes), GROUPED), "groups")
        full = walked.where("`group` is not null").select("directory", "group", "path", "length")
        out = full if out is None else out.unionByName(full)
        if slices == 1:
            return out
        now = walked.where("open").select("directory", "old", "path", "length")
        slices, round_ = max(1, slices // FEWER), round_ + 1
