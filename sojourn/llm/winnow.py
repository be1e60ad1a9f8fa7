"""Benchmark decontamination by winnowing.

Words: lower-case A-Z, then ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  A window is
10 consecutive words of an item; an item of fewer words, but not none, is one
window.  A document word inside any occurrence of a window is hit.

* Fingerprints: hashes of 5-word grams; of every 6 consecutive ones the minimum
  is kept (the rightmost of equals).  Two texts that share 10 words share a kept
  fingerprint, so no occurrence of a window is missed.  Items shorter than a
  window are below that guarantee: every gram of their length is kept.
* Training and test fingerprints meet in two steps.  A bitmap of the benchmark's
  fingerprints and one of its windows, whose size has a fixed upper bound, go to
  every task and drop nearly all grams where they lie; each surviving fingerprint
  is extended to the windows around it, and windows that overlap become one run.
  The distinct runs are then joined with the benchmark's windows on their full
  text, so a false hit of a bitmap never reaches the result and a passage that
  many documents share is looked up once.

Cases: a null text has no words; rows with a null or repeated ``doc_id`` each
give a row; an item with a null ``item_id`` marks words but is not counted; an
item_id on several rows counts once; empty tables give zero hits or no rows;
other columns are ignored, and kept by ``drop_contaminated``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bitmap import Bitmap, bitmap, bitmap_bits
from .common import read_table, small_batches, stage_table, text_bytes

WINDOW = 10
GRAM = 5
_WORD_BYTES = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD_BYTES else 0x20 for b in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class _WordHash(dict):
    """XXH64 of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def word_hashes(words: list[bytes], known: _WordHash) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _ODD
    return h ^ (h >> np.uint64(29))


def gram_hashes(w: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` words."""
    n = len(w) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, np.uint64(length))
    for j in range(length):
        h = h * _ODD + w[j: j + n]
    return _mix(h)


def winnow(h: np.ndarray, window: int) -> np.ndarray:
    """Positions kept: of each ``window`` consecutive hashes the minimum, the rightmost of equals."""
    if len(h) < window:
        return np.empty(0, np.int64)
    n = len(h) - window + 1
    best, at = h[:n].copy(), np.arange(n)
    for j in range(1, window):
        here = h[j: j + n]
        better = here <= best
        best = np.where(better, here, best)
        at[better] = np.flatnonzero(better) + j
    return np.unique(at)


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item_id``, ``len`` (in words), ``window`` (words joined by a space): each item's distinct windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            out: list[tuple] = []
            for item, text in zip(b.column(0).to_pylist(), text_bytes(b.column(1))):
                words = words_of(text)
                n = min(window, len(words))
                texts = {b" ".join(words[i: i + n]) for i in range(len(words) - n + 1)} if n else ()
                out += [(item, n, t) for t in texts]
            item, n, text = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(n, pa.int32()), pa.array(text, pa.binary())],
                                             ["item_id", "len", "window"])

    rows = items.select("item_id", "text").mapInArrow(run, "item_id long, len int, window binary")
    return rows.distinct()


def item_sets(windows: DataFrame, window: int = WINDOW, gram: int = GRAM) -> tuple[Bitmap, Bitmap, list[int]]:
    """Bitmaps of the kept fingerprints and of all windows, and the lengths of short items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHash()
        for b in batches:
            prints, whole = [], []
            for text in text_bytes(b.column(0)):
                w = word_hashes(text.split(), known)
                whole.append(gram_hashes(w, len(w)))
                if len(w) == window:
                    g = gram_hashes(w, gram)
                    prints.append(g[winnow(g, window - gram + 1)])
            h = np.concatenate([np.empty(0, np.uint64), *prints, *whole])
            is_print = np.arange(len(h)) < sum(map(len, prints))
            yield pa.RecordBatch.from_arrays([pa.array(is_print), pa.array(h.view(np.int64))], ["is_print", "h"])

    hashes = stage_table(windows.select("window").mapInArrow(run, "is_print boolean, h long").distinct(), "item_hashes")
    n = hashes.count()
    bits = bitmap_bits(64 * n)
    lengths = [r.len for r in windows.where(F.col("len") < window).select("len").distinct().collect()]  # at most window - 1 rows
    return bitmap(hashes.where("is_print").select("h"), bits), bitmap(hashes.where("not is_print").select("h"), bits), lengths


def candidates(w: np.ndarray, prints: Bitmap, whole: Bitmap, lengths: list[int], window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the document's windows that may be the benchmark's, by start."""
    start, length = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    if len(w) >= window:
        g = gram_hashes(w, gram)
        at = winnow(g, window - gram + 1)
        at = at[prints.has(g[at])]
        if len(at):  # extend: the windows that hold the gram
            s = np.unique(at[:, None] - np.arange(window - gram + 1)[None, :])
            s = s[(s >= 0) & (s <= len(w) - window)]
            h = np.full(len(s), np.uint64(window))
            for j in range(window):
                h = h * _ODD + w[s + j]
            s = s[whole.has(_mix(h))]
            start.append(s)
            length.append(np.full(len(s), window))
    for n in lengths:
        s = np.flatnonzero(whole.has(gram_hashes(w, n)))
        start.append(s)
        length.append(np.full(len(s), n))
    s, n = np.concatenate(start), np.concatenate(length)
    order = np.lexsort((n, s))
    return s[order], n[order]


def runs_of(start: np.ndarray, length: np.ndarray) -> list[tuple[int, int]]:
    """Overlapping windows as runs [from, to)."""
    if not len(start):
        return []
    end = np.maximum.accumulate(start + length)
    new = np.concatenate([[True], start[1:] >= end[:-1]])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(start)]]) - 1
    return list(zip(start[first].tolist(), end[last].tolist()))


RUN_SCHEMA = "row long, doc_id long, mark long, n_words long, run binary, run_text binary"


def document_runs(docs: DataFrame, prints: Bitmap, whole: Bitmap, lengths: list[int]) -> DataFrame:
    """A row per run of candidate windows, or one with a null run; ``row`` tells input rows apart and
    ``mark`` is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHash()
        row = TaskContext.get().partitionId() << 40
        for b in small_batches(batches):
            out: list[tuple] = []
            for doc, text, mark in zip(b.column(0).to_pylist(), text_bytes(b.column(1)), b.column(2).to_pylist()):
                words = words_of(text)
                spans = runs_of(*candidates(word_hashes(words, known), prints, whole, lengths))
                row += 1
                for a, z in spans or [(0, 0)]:
                    t = b" ".join(words[a:z])
                    out.append((row, doc, mark, len(words), hashlib.blake2b(t, digest_size=16).digest() if spans else None, t if spans else None))
            names = [f.split()[0] for f in RUN_SCHEMA.split(", ")]
            kinds = [pa.int64()] * 4 + [pa.binary()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names)

    return docs.select("doc_id", "text", F.xxhash64("text").alias("mark")).mapInArrow(run, RUN_SCHEMA)


def verified_runs(runs: DataFrame, windows: DataFrame, whole: Bitmap, lengths: list[int], window: int = WINDOW) -> DataFrame:
    """``run``, ``n_hit`` (words in windows that are the benchmark's, compared in full), ``items``."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHash()
        for b in small_batches(batches, 1 << 18):
            out: list[tuple] = []
            for key, text in zip(b.column(0).to_pylist(), text_bytes(b.column(1))):
                words = text.split()
                w = word_hashes(words, known)
                for n in [window, *lengths]:
                    for s in np.flatnonzero(whole.has(gram_hashes(w, n))).tolist():
                        out.append((key, s, n, b" ".join(words[s: s + n])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), (pa.binary(), pa.int64(), pa.int32(), pa.binary()))],
                                                 ["run", "at", "len", "window"])

    texts = runs.where("run is not null").groupBy("run").agg(F.first("run_text").alias("run_text"))
    spans = texts.mapInArrow(split, "run binary, at long, len int, window binary")
    owners = windows.groupBy("window").agg(F.collect_set("item_id").alias("items"))
    hits = spans.join(owners, "window").groupBy("run").agg(
        F.array_sort(F.collect_list(F.struct("at", "len"))).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    zero = F.lit(0).cast("long")
    covered = F.aggregate("spans", F.struct(zero.alias("end"), zero.alias("n")), lambda a, s: F.struct(
        F.greatest(a["end"], s["at"] + s["len"]).alias("end"),
        (a["n"] + F.greatest(zero, s["at"] + s["len"] - F.greatest(a["end"], s["at"]))).alias("n")), lambda a: a["n"])
    return hits.select("run", covered.alias("n_hit"), "items")


def _matched(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    windows = stage_table(item_windows(items), "item_windows")
    prints, whole, lengths = item_sets(windows)
    runs = stage_table(document_runs(docs, prints, whole, lengths), "document_runs")
    return runs, verified_runs(runs, windows, whole, lengths)


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: ``n_words``, ``n_hit``, ``items`` (ids whose windows occur, sorted as strings)."""
    runs, found = _matched(docs, items)
    hit = (runs.where("run is not null").select("row", "doc_id", "n_words", "run").join(found, "run", "left")
           .groupBy("row", "doc_id", "n_words")
           .agg(F.coalesce(F.sum("n_hit"), F.lit(0)).cast("long").alias("n_hit"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
           .select("doc_id", "n_words", "n_hit", F.array_sort(F.transform("items", lambda x: x.cast("string"))).alias("items")))
    clean = runs.where("run is null").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"))
    return hit.unionByName(clean)


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents in which no window occurs, with all their columns.  The ids to drop are few; Spark
    checks their size before it broadcasts them."""
    runs, found = _matched(docs, items)
    bad = (runs.where("run is not null").join(found.where("n_hit > 0"), "run", "left_semi")
           .select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")).distinct())
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__mark")), "left_anti")


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def _oracle() -> str:
    """The same result in DuckDB: all windows of all documents joined with those of the items."""
    def words(text: str) -> str:
        return (f"regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
                r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

    return f"""WITH iw AS (SELECT item_id, {words('text')} AS w FROM benchmark),
        win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM (
                  SELECT item_id, w, least({WINDOW}, len(w)) AS n, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS i FROM iw WHERE len(w) > 0)),
        dw AS (SELECT row_number() OVER () AS row, doc_id, {words('text')} AS w FROM documents),
        dwin AS (SELECT row, n, i, array_to_string(w[i:i + n - 1], ' ') AS t FROM (
                  SELECT row, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM dw JOIN (SELECT DISTINCT n FROM win) ON len(w) >= n)),
        hit AS (SELECT DISTINCT row, i, n, item_id FROM dwin JOIN win USING (t, n)),
        cov AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS p FROM hit) GROUP BY row),
        own AS (SELECT row, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items FROM (
                  SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS x FROM hit WHERE item_id IS NOT NULL) GROUP BY row)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM dw LEFT JOIN cov USING (row) LEFT JOIN own USING (row)"""


ORACLE = _oracle()
