"""Small append-only tables: one file for each append, folded from time to time while readers go on.

A fold reads the appended files, writes what is to be kept as a *base* and commits by a note that names the
bases and the files they replace.  Notes are numbered and made by an exclusive create, so of two folds at a
time one counts and the other is undone.  A reader takes the newest note: its bases, and the files that the
note does not replace.  What a fold replaces is deleted by the fold after it, so a reader that began
before a fold still finds its files.  Appends go on meanwhile: a file that the fold has
not read is not replaced.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .files import create_exclusive, delete, file_system, read_small

#: Files from which a table is folded, and bases from which these are made one.
FOLD_FILES = 64
FOLD_BASES = 16


def append_rows(spark: SparkSession, path: str, rows: list[tuple], schema: str) -> None:
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def _names(spark: SparkSession, path: str, start: str) -> list[str]:
    fs, p = file_system(spark, path)
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(p)) if n.startswith(start)) if fs.exists(p) else []


def _note(spark: SparkSession, path: str) -> dict:
    """The newest note; number 0 before the first fold."""
    names = _names(spark, f"{path}/_folds", "fold-")
    return json.loads(read_small(spark, f"{path}/_folds/{names[-1]}")) if names else {"number": 0, "bases": [], "replaced": [], "old": []}


def _state(spark: SparkSession, path: str) -> tuple[dict, list[str]]:
    note = _note(spark, path)
    gone = set(note["replaced"])
    return note, [n for n in _names(spark, path, "part-") if n not in gone]


def _rows(spark: SparkSession, path: str, paths: list[str], schema: str) -> DataFrame:
    """The named bases and files (few: a fold bounds them)."""
    return spark.read.schema(schema).parquet(*(f"{path}/{p}" for p in paths)) if paths else spark.createDataFrame([], schema)


def read_appended(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of the table, as far as folds have kept them; empty if it does not exist yet."""
    note, files = _state(spark, path.rstrip("/"))
    return _rows(spark, path.rstrip("/"), [*note["bases"], *files], schema)


def fold(spark: SparkSession, path: str, schema: str, keep: Callable[[DataFrame], DataFrame] | None = None,
         least: int | None = None) -> bool:
    """Fold the appended files if there are ``least``.  ``keep`` picks the rows that stay, over all rows of
    the table; without it all stay, and only the new files are rewritten.  True if this call's fold counts."""
    path = path.rstrip("/")
    note, files = _state(spark, path)
    if len(files) < max(1, FOLD_FILES if least is None else least):
        return False
    whole = keep is not None or len(note["bases"]) >= FOLD_BASES
    merged = note["bases"] if whole else []
    rows = _rows(spark, path, [*merged, *files], schema)
    base = f"_bases/{uuid.uuid4().hex}"
    (keep(rows) if keep else rows).coalesce(1).write.parquet(f"{path}/{base}")
    number, there = note["number"] + 1, set(_names(spark, path, "part-"))
    older = [n for n in note["replaced"] if n in there]  # replaced by the last note; whoever reads that one does not need them
    mine = {"number": number, "bases": [*([] if whole else note["bases"]), base], "replaced": [*older, *files], "old": merged}
    if not create_exclusive(spark, f"{path}/_folds/fold-{number:012d}", json.dumps(mine)):
        delete(spark, f"{path}/{base}")
        return False
    for name in [*older, *note["old"]]:
        delete(spark, f"{path}/{name}")
    for name in _names(spark, f"{path}/_folds", "fold-")[:-2]:
        delete(spark, f"{path}/_folds/{name}")
    return True

