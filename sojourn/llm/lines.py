"""Substring dedup by line hashing.

Units: a line is cut after sentence ends (``.``, ``!`` or ``?`` before a blank or
tab); a sentence of at least ``MIN_WORDS`` words begins a unit, shorter ones
belong to the unit before them (leading ones to the first), and a line without
such a sentence is one unit.  Each unit also has parts: its long sentence, and
the shorter ones before and after it.  A unit goes whole where all of it has
occurred before, else those of its parts that have.  So a repeated sentence is
found whatever stands beside it, and a short one goes only with a repeat of
its surroundings.  A unit or part is normalised (A-Z folded, runs of white space
to one space, trimmed) and counts if it has at least ``MIN_WORDS`` words.  Digests
are grouped over the whole table, the earliest occurrence in rank (``doc_id``,
then offset) is kept and the others are removed; what is left of a text keeps
its original offsets.  A line that has lost something loses trailing blanks, and
a line that has lost all goes entirely.

Digests travel without text.  A first aggregate counts 64-bit digests; a bitmap
of those that occur more than once, of bounded size, then drops most units where
they lie.  The rest are grouped by 128-bit digest, with a partial aggregate, so
a line that fills a third of the table is a few rows a task.  Texts meet their
removed units by row.

Cases: a null text stays null; empty texts stay; rows with a null ``doc_id`` rank
last; rows that repeat a ``doc_id`` are told apart by row; a text of which every
unit is removed becomes empty; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bitmap import bitmap, bitmap_bits
from .common import read_table, small_batches, stage_table

MIN_WORDS = 8
_SPACE = " \t\x0b\x0c\r"
_FOLD = {c: c + 32 for c in range(65, 91)} | {ord(c): " " for c in _SPACE}
_SENTENCE = re.compile(r"[^\n]*?[.!?][ \t]+|[^\n]+")
UNIT = "struct<start:int,end:int,a:long,b:long>"


def line_units(line: str, min_words: int) -> list[tuple[int, int, list[str]]]:
    """Start, end and words of the units of a line, each followed by its parts if it has several."""
    found: list[list[list]] = []  # units of parts [start, end, words, kind]; kind: 0 before, 1 long, 2 after
    kind = 0
    for m in _SENTENCE.finditer(line):
        own = [w for w in m[0].translate(_FOLD).split(" ") if w]
        is_long = len(own) >= min_words
        if not found or is_long and kind:
            found.append([])
        kind = 1 if is_long else 2 if kind else 0
        unit = found[-1]
        if unit and unit[-1][3] == kind:
            unit[-1][1] = m.end()
            unit[-1][2] += own
        else:
            unit.append([m.start(), m.end(), own, kind])
    out = []
    for unit in found:
        out.append((unit[0][0], unit[-1][1], [w for part in unit for w in part[2]]))
        out += [(a, z, words) for a, z, words, _ in unit] if len(unit) > 1 else []
    return out


def units_of(text: str, min_words: int) -> list[tuple[int, int, int, int]]:
    """Start, end (code points) and two halves of the digest of each unit and part that counts."""
    out, at = [], 0
    for line in text.split("\n"):
        for a, z, words in line_units(line, min_words):
            if len(words) >= min_words:
                digest = xxhash.xxh3_128_intdigest(" ".join(words))
                out.append((at + a, at + z, digest >> 64, digest & (1 << 64) - 1))
        at += len(line) + 1
    return out


def outermost(spans: list[dict]) -> list[dict]:
    """The spans, which are nested or apart, without those that lie in another."""
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if not out or s["start"] >= out[-1]["end"]:
            out.append(s)
    return out


def units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``row``, ``doc_id``, ``text`` and ``units``, one row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for b in small_batches(batches):
            found = [units_of(t or "", min_words) for t in b.column(1).to_pylist()]
            flat = [u for us in found for u in us]
            start, end, high, low = zip(*flat) if flat else ((), (), (), ())
            parts = [np.array(start, np.int32), np.array(end, np.int32), np.array(high, np.uint64).view(np.int64), np.array(low, np.uint64).view(np.int64)]
            struct = pa.StructArray.from_arrays([pa.array(x) for x in parts], ["start", "end", "a", "b"])
            offsets = pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(range(row, row + len(found)), pa.int64()), b.column(0).cast(pa.int64()), b.column(1).cast(pa.string()),
                                              pa.ListArray.from_arrays(offsets, struct)], ["row", "doc_id", "text", "units"])
            row += len(found)

    return docs.select("doc_id", "text").mapInArrow(run, f"row long, doc_id long, text string, units array<{UNIT}>")


def repeated_units(table: DataFrame) -> DataFrame:
    """``row``, ``doc_id``, ``start``, ``end``, ``a``, ``b`` of all units that may occur more than once."""
    hashes = stage_table(table.select(F.explode("units.a").alias("h")).groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "unit_hashes")
    seen = bitmap(hashes, bitmap_bits(16 * hashes.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            of = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
            start, end, high, low = (x.to_numpy() for x in lists.flatten().flatten())
            keep = np.flatnonzero(seen.has(high.view(np.uint64)))
            rows = pa.array(of[keep])
            yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), *(pa.array(x[keep]) for x in (start, end, high, low))],
                                             ["row", "doc_id", "start", "end", "a", "b"])

    return table.select("row", "doc_id", "units").mapInArrow(run, "row long, doc_id long, start int, end int, a long, b long")


def removed_units(table: DataFrame) -> DataFrame:
    """``row`` and ``removed``: its units and parts that occur earlier in rank, with the ``doc_id`` that keeps them."""
    u = stage_table(repeated_units(table), "repeated_units")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "start", "row")
    first = u.groupBy("a", "b").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = stage_table(first, "first_units")  # a plain table on this side lets Spark split a frequent unit's rows in the join
    later = u.join(first, ["a", "b"]).where("not (row = first.row and start = first.start)")
    return later.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end", F.col("first.doc_id").alias("first_doc_id")))).alias("removed"))


def without(text: str, spans: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]]:
    """What is left of ``text`` without the units ``spans``, and the spans that are left."""
    out, kept, at, k = [], [], 0, 0
    for line in text.split("\n"):
        end, pieces, pos = at + len(line), [], at
        while k < len(spans) and spans[k][0] < end:
            if spans[k][0] > pos:
                pieces.append((pos, spans[k][0]))
            pos = spans[k][1]
            k += 1
        if pos < end:
            pieces.append((pos, end))
        if pieces and (pos > at):  # the line has lost a unit
            a, z = pieces[-1]
            pieces[-1] = (a, a + len(text[a:z].rstrip(" \t")))
        if pieces or end == at:
            out.append("".join(text[a:z] for a, z in pieces))
            kept += pieces
        at = end + 1
    return "\n".join(out), kept


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id``, ``text`` (what is left), ``removed`` (start, end, first_doc_id) and ``kept`` (start and
    end in the original text of the pieces that are left), one row per input row."""
    table = stage_table(units(docs, min_words), "line_units")
    rows = table.select("row", "doc_id", "text").join(removed_units(table), "row", "left").select("doc_id", "text", "removed")
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    removed = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("first_doc_id", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            out = []
            for text, gone in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                if text is None or not gone:
                    out.append((text, [], [{"start": 0, "end": len(text)}] if text else []))
                else:
                    gone = outermost(gone)
                    left, kept = without(text, [(g["start"], g["end"]) for g in gone])
                    out.append((left, gone, [{"start": a, "end": z} for a, z in kept]))
            text, gone, left = zip(*out)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string()), pa.array(gone, removed), pa.array(left, pa.list_(span))],
                                             ["doc_id", "text", "removed", "kept"])

    return rows.mapInArrow(run, "doc_id long, text string, removed array<struct<start:int,end:int,first_doc_id:long>>, kept array<struct<start:int,end:int>>")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: ``text`` left, ``n_removed`` (units and single parts), ``removed`` as start:end:first_doc_id
    and ``kept`` as start:end of the pieces left, comma-joined."""
    out = dedup(read_table(spark, sf_dir, "documents"))
    listed = F.transform("removed", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"), s["first_doc_id"].cast("string")))
    kept = F.transform("kept", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return out.select("doc_id", "text", F.size("removed").cast("long").alias("n_removed"), F.array_join(listed, ",").alias("removed"),
                      F.array_join(kept, ",").alias("kept"))


_WORDS = r"trim(regexp_replace(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\x0B\x0C\r]+', ' ', 'g'), ' ')"
_ITEM = f"""min(start) AS start, sum(length(piece)) AS len, string_agg(norm, ' ' ORDER BY j) FILTER (norm <> '') AS norm, sum(nw) >= {MIN_WORDS} AS counts"""
ORACLE = rf"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
    l AS (SELECT row, doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS k FROM d),
    o AS (SELECT *, sum(length(line) + 1) OVER (PARTITION BY row ORDER BY k) - length(line) - 1 AS off,
                 regexp_extract_all(line, '[^
]*?[.!?][ 	]+|[^
]+') AS pieces FROM l),
    p AS (SELECT row, doc_id, k, off, unnest(pieces) AS piece, unnest(range(len(pieces))) AS j FROM o),
    w AS (SELECT *, {_WORDS.format('piece')} AS norm, off + sum(length(piece)) OVER (PARTITION BY row, k ORDER BY j) - length(piece) AS start FROM p),
    n AS (SELECT *, CASE WHEN norm = '' THEN 0 ELSE length(norm) - length(replace(norm, ' ', '')) + 1 END AS nw FROM w),
    c AS (SELECT *, sum(CASE WHEN nw >= {MIN_WORDS} THEN 1 ELSE 0 END) OVER (PARTITION BY row, k ORDER BY j) AS longs FROM n),
    m AS (SELECT *, greatest(1, longs) AS u, CASE WHEN nw >= {MIN_WORDS} THEN 1 WHEN longs = 0 THEN 0 ELSE 2 END AS part FROM c),
    q AS (SELECT *, min(part) OVER win < max(part) OVER win AS parted FROM m WINDOW win AS (PARTITION BY row, k, u)),
    i AS (SELECT row, doc_id, k, u, -1 AS part, {_ITEM} FROM q GROUP BY row, doc_id, k, u
          UNION ALL SELECT row, doc_id, k, u, part, {_ITEM} FROM q WHERE parted GROUP BY row, doc_id, k, u, part),
    e AS (SELECT *, counts AND row_number() OVER win > 1 AS gone, first_value(doc_id) OVER win AS first_doc
          FROM i WINDOW win AS (PARTITION BY norm, counts ORDER BY doc_id NULLS LAST, start, row)),
    r AS (SELECT *, bool_or(gone AND part = -1) OVER (PARTITION BY row, k, u) AS unit_gone FROM e),
    z AS (SELECT q.row, q.k, q.j, q.start, q.piece, coalesce(a.gone, false) OR coalesce(b.gone, false) AS lost
          FROM q LEFT JOIN r a ON a.row = q.row AND a.k = q.k AND a.u = q.u AND a.part = -1
                 LEFT JOIN r b ON b.row = q.row AND b.k = q.k AND b.u = q.u AND b.part = q.part),
    g AS (SELECT row, k, bool_or(lost) AS lost, rtrim(string_agg(piece, '' ORDER BY j) FILTER (NOT lost), ' ' || chr(9)) AS left_of FROM z GROUP BY row, k),
    t AS (SELECT row, string_agg(CASE WHEN lost THEN left_of ELSE line END, chr(10) ORDER BY k) FILTER (NOT coalesce(lost AND left_of IS NULL, false)) AS text
          FROM l LEFT JOIN g USING (row, k) GROUP BY row),
    x AS (SELECT row, count(*) AS n_removed, string_agg(concat_ws(':', start::BIGINT, (start + len)::BIGINT, first_doc), ',' ORDER BY start) AS removed
          FROM r WHERE gone AND (part = -1 OR NOT unit_gone) GROUP BY row),
    y AS (SELECT z.row, z.k, z.start, z.piece, z.lost, z.j, sum(CASE WHEN z.lost THEN 1 ELSE 0 END) OVER (PARTITION BY z.row, z.k ORDER BY z.j) AS run
          FROM z JOIN g ON g.row = z.row AND g.k = z.k AND g.lost),
    s AS (SELECT row, k, min(start) AS start, string_agg(piece, '' ORDER BY j) AS whole, run FROM y WHERE NOT lost GROUP BY row, k, run),
    f AS (SELECT row, start::BIGINT AS a, (start + length(CASE WHEN run = max(run) OVER (PARTITION BY row, k) THEN rtrim(whole, ' ' || chr(9)) ELSE whole END))::BIGINT AS b FROM s
          UNION ALL SELECT o.row, off::BIGINT, (off + length(line))::BIGINT FROM o JOIN x USING (row) LEFT JOIN g ON g.row = o.row AND g.k = o.k
                    WHERE NOT coalesce(g.lost, false) AND line <> ''),
    h AS (SELECT row, string_agg(concat_ws(':', a, b), ',' ORDER BY a) AS kept FROM f GROUP BY row)
    SELECT doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(t.text, '') END AS text, coalesce(n_removed, 0) AS n_removed,
           coalesce(removed, '') AS removed,
           CASE WHEN n_removed IS NULL THEN CASE WHEN coalesce(d.text, '') = '' THEN '' ELSE concat_ws(':', 0, length(d.text)) END ELSE coalesce(kept, '') END AS kept
    FROM d LEFT JOIN t USING (row) LEFT JOIN x USING (row) LEFT JOIN h USING (row)"""
