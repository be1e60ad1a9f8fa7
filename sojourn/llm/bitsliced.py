"""Ranked lexical search over bit-sliced Bloom signatures.

Terms are maximal runs of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]`` of the whole text, A-Z
lower-cased.  With N documents that have a term, L terms in all, n terms of a document and tf
occurrences of a term that df documents hold:

* ``w = floor(1000 * ln((2 N + 2) / (2 df + 1)))``, in doubles; all else is 64-bit, divisions round down;
* ``m = 100 - 75 + (75 n N) div L``;
* a document scores the sum of ``w * ((10^9 tf) div (1000 tf + 8 m))`` over the item's terms, repeats included.

Index (``build``), one pass over the texts:

* A document's signature is a Bloom filter of its terms and of their frequency levels: a term is entered
  once for each of the thresholds 1, 2, 3, 5, 9, ... that its tf reaches.
* Documents of like signature size are gathered into blocks of up to 1,024 rows, stored by bit slices:
  for each bit of the signature the bitmap of the rows that have it.  A block is bounded in bytes.
* Exact n per document lies beside the slices; exact df of every term is a table of its own.

Search (``search``), in blocks of items of bounded size:

* The AND of a term's slices is a row bitmap that contains every document with the term (at that level)
  and a few more; ``w`` times the gain of each level, summed over an item's terms, is never below the score.
* The k rows with the highest bounds are scored exactly; the k-th of these scores is a floor for the item.
* Every row whose bound reaches the floor is scored exactly from its whole text; the others are provably
  not among the k best.  Candidates travel as one row per document, the items as a bit mask.

Cases: null and term-less texts hold no term, are not counted in N and never found; an item without terms
or matches has no rows; repeated item rows are items of their own, and so are repeated documents (ranks
stay unique, the order among equal rows is free); among equal scores the smaller ``doc_id`` is first, null
last; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table, small_batches, stage_table, text_bytes

#: Slices that a term (at a level) sets.
HASHES = 8
#: A signature has at least this many bits for each of its entries, and 1.5 times as many at most from MIN_BITS on.
BITS_PER_ENTRY = 20
MIN_BITS = 512
#: Rows and bytes of a block at most (eight rows at least).
BLOCK_ROWS = 1024
BLOCK_BYTES = 2 << 20
#: Items, and their different terms, that are searched at once (one item at least).
ITEMS = 256
ITEM_TERMS = 1 << 16
#: Different terms whose documents a task counts before it hands them on.
HELD_TERMS = 1 << 17
#: Frequency levels: a term reaches level j if tf is at least THRESHOLDS[j].
THRESHOLDS = np.array([1] + [(1 << j) + 1 for j in range(40)], np.int64)
#: Cells of an unpacked presence matrix held at once.
CELLS = 1 << 21

#: A-Z lower-cased; all ASCII characters but letters and digits become blanks.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
INDEX = "bits int, doc_ids array<long>, lengths array<int>, slices binary, term string, df long"


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(x) for x in words], np.uint64)


def entries(h: np.ndarray, level: np.ndarray | int) -> np.ndarray:
    """The hash of (term, level)."""
    x = h + np.uint64(0x9E3779B97F4A7C15) * np.asarray(level, np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def slots(entry: np.ndarray, bits: int) -> list[np.ndarray]:
    """The ``HASHES`` slices of each entry."""
    low, step = entry & np.uint64(0xFFFFFFFF), entry >> np.uint64(32)
    return [((low + np.uint64(i) * step) % np.uint64(bits)).astype(np.int64) for i in range(HASHES)]


# ---------------------------------------------------------------- index

def size_of(n_entries: int) -> int:
    """Bits of a signature: the first of MIN_BITS, 1.5 MIN_BITS, 2 MIN_BITS, 3 MIN_BITS, ... with enough of them."""
    doubled = MIN_BITS << max(0, (-(-n_entries * BITS_PER_ENTRY // MIN_BITS) - 1).bit_length())
    return doubled * 3 // 4 if MIN_BITS < doubled and n_entries * BITS_PER_ENTRY <= doubled * 3 // 4 else doubled


def _rows_of(bits: int) -> int:
    return max(8, min(BLOCK_ROWS, BLOCK_BYTES * 8 // bits // 8 * 8))


def _packed(bits: int, docs: list[np.ndarray]) -> bytes:
    """Bit slices of the documents' entries: one bitmap of rows for each signature bit."""
    row = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    out = np.zeros((bits, (len(docs) + 7) // 8 * 8), bool)
    for at in slots(np.concatenate(docs), bits):
        out[at, row] = True
    return np.packbits(out, axis=1).tobytes()


def build(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks (``bits``, ``doc_ids``, ``lengths``, ``slices``) and document counts (``term``, ``df``), written."""

    def block(bits: int, held: list[tuple]) -> pa.RecordBatch:
        ids, lengths, found = zip(*held)
        return pa.RecordBatch.from_arrays([
            pa.array([bits], pa.int32()), pa.array([list(ids)], pa.list_(pa.int64())), pa.array([list(lengths)], pa.list_(pa.int32())),
            pa.array([_packed(bits, list(found))], pa.binary()), pa.nulls(1, pa.string()), pa.nulls(1, pa.int64())], names)

    def counted(df: Counter) -> pa.RecordBatch:
        n = len(df)
        empty = [pa.nulls(n, t) for t in (pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary())]
        return pa.RecordBatch.from_arrays([*empty, pa.array(list(df), pa.binary()).cast(pa.string()), pa.array(df.values(), pa.int64())], names)

    names = ["bits", "doc_ids", "lengths", "slices", "term", "df"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        df: Counter = Counter()
        for b in small_batches(batches):
            for doc_id, text in zip(b.column(0).to_pylist(), text_bytes(b.column(1))):
                words = terms(text)
                if not words:
                    continue
                tf = Counter(words)
                df.update(tf.keys())
                levels = np.searchsorted(THRESHOLDS, np.fromiter(tf.values(), np.int64, len(tf)), side="right")
                ahead = np.arange(levels.sum()) - np.repeat(np.cumsum(levels) - levels, levels)
                found = entries(np.repeat(hashes(list(tf)), levels), ahead)
                bits = size_of(len(found))
                mine = held.setdefault(bits, [])
                mine.append((doc_id, len(words), found))
                if len(mine) == _rows_of(bits):
                    yield block(bits, held.pop(bits))
                if len(df) >= HELD_TERMS:
                    yield counted(df)
                    df = Counter()
        for bits, mine in held.items():
            yield block(bits, mine)
        if df:
            yield counted(df)

    made = stage_table(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, INDEX), "bitsliced")
    blocks = made.where("bits is not null").drop("term", "df")
    return blocks, stage_table(made.where("term is not null").groupBy("term").agg(F.sum("df").alias("df")), "bitsliced_terms")


# ---------------------------------------------------------------- queries

@dataclass
class Query:
    """A block of items: its different terms, and per item the places of its terms and their weights."""

    hashes: np.ndarray
    words: dict[bytes, int]
    items: list[tuple[np.ndarray, np.ndarray]]
    n_docs: int
    n_terms: int

    def norm(self, n: np.ndarray) -> np.ndarray:
        return 100 - 75 + 75 * n * self.n_docs // self.n_terms


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def bounds(query: Query, bits: int, lengths: np.ndarray, slices: bytes) -> np.ndarray:
    """Items x rows: a score that the row's document cannot exceed; zero where it holds no term.

    All sums are of integers below 2^53, so the doubles are exact."""
    n = len(lengths)
    table = np.frombuffer(slices, np.uint8).reshape(bits, -1)
    m = query.norm(lengths)
    out = np.zeros((len(query.items), n))
    live = np.arange(len(query.hashes))
    before, reached = np.zeros(n, np.int64), None
    for level in range(len(THRESHOLDS) - 1):
        first, *rest = slots(entries(query.hashes[live], level), bits)
        rows = table[first]
        for at in rest:
            rows &= table[at]
        if reached is not None:
            rows &= reached
        some = rows.any(axis=1)
        if not some.any():
            break
        live, reached = live[some], rows[some]
        most = impact(np.minimum(THRESHOLDS[level + 1] - 1, lengths), m)  # tf is below the next threshold, and n at most
        place = np.full(len(query.hashes), -1)
        place[live] = np.arange(len(live))
        width = max(1, CELLS // len(live) // 8)
        for at in range(0, reached.shape[1], width):
            here = np.unpackbits(reached[:, at: at + width], axis=1)[:, : n - 8 * at].astype(np.float64)
            gain = (most - before)[8 * at: 8 * at + here.shape[1]]
            for q, (mine, weight) in enumerate(query.items):
                p = place[mine]
                has = p >= 0
                if has.any():
                    out[q, 8 * at: 8 * at + here.shape[1]] += gain * (weight[has] @ here[p[has]])
        before = most
    return out


def _each_block(b: pa.RecordBatch) -> Iterator[tuple[pa.Array, int, np.ndarray, bytes]]:
    """Per block: its documents, the bits of a signature, their lengths and the slices."""
    for i in range(b.num_rows):
        yield b.column(0)[i].values, b.column(1)[i].as_py(), b.column(2)[i].values.to_numpy().astype(np.int64), b.column(3)[i].as_py()


def _masks(doc_ids: pa.Array, hit: np.ndarray) -> pa.RecordBatch:
    """Documents with a bit for each item whose row of ``hit`` names them."""
    some = np.flatnonzero(hit.any(axis=0))
    bits = np.zeros((ITEMS, len(some)), bool)
    bits[: len(hit)] = hit[:, some]
    words = np.packbits(bits, axis=0, bitorder="little").T.copy().view("<i8")
    return pa.RecordBatch.from_arrays([doc_ids.take(pa.array(some)), *(pa.array(words[:, k].copy()) for k in range(words.shape[1]))], ["doc_id", *MASKS])


MASKS = [f"items{k}" for k in range(ITEMS // 64)]
_MASKED = "doc_id long, " + ", ".join(f"{c} long" for c in MASKS)


def _best(query: Query, blocks: DataFrame, k: int) -> DataFrame:
    """Per task and item the k documents with the highest bounds: ``item``, ``bound``, ``doc_id``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(query.items)
        top, ids = np.zeros((n, 0)), np.zeros((n, 0), np.int64)
        none = np.zeros((n, 0), bool)
        for b in batches:
            for doc_ids, bits, lengths, slices in _each_block(b):
                seen = np.broadcast_to(doc_ids.fill_null(0).to_numpy(), (n, len(doc_ids)))
                null = np.broadcast_to(doc_ids.is_null().to_numpy(zero_copy_only=False), (n, len(doc_ids)))
                top, ids, none = np.hstack([top, bounds(query, bits, lengths, slices)]), np.hstack([ids, seen]), np.hstack([none, null])
                if top.shape[1] > k:
                    keep = np.argpartition(-top, k - 1, axis=1)[:, :k]
                    top, ids, none = (np.take_along_axis(x, keep, axis=1) for x in (top, ids, none))
        item, at = np.nonzero(top > 0)
        yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(top[item, at].astype(np.int64)),
                                          pa.array(ids[item, at], mask=none[item, at])], ["item", "bound", "doc_id"])

    rows = blocks.select("doc_ids", "bits", "lengths", "slices").mapInArrow(run, "item int, bound long, doc_id long")
    return _top(rows, "bound", k)


def _reaching(query: Query, blocks: DataFrame, floors: np.ndarray) -> DataFrame:
    """Documents whose bound reaches the floor of an item, with the mask of these items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc_ids, bits, lengths, slices in _each_block(b):
                yield _masks(doc_ids, bounds(query, bits, lengths, slices) >= floors[:, None])

    return _one_each(blocks.select("doc_ids", "bits", "lengths", "slices").mapInArrow(run, _MASKED))


def _one_each(masked: DataFrame) -> DataFrame:
    return masked.groupBy("doc_id").agg(*(F.bit_or(c).alias(c) for c in MASKS))


def _top(rows: DataFrame, by: str, k: int) -> DataFrame:
    """The k first rows of each item, in two steps: no task meets all rows of an item."""
    order = [F.desc(by), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64(by, "doc_id"), F.lit(64))
    near = rows.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("rank") <= k)
    return near.drop("part").withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def _scored(query: Query, docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``item``, ``doc_id``, ``score``, ``rank``: the k best of the wanted documents, scored on their whole texts."""
    wanted = stage_table(wanted.withColumnRenamed("doc_id", "__id"), "bitsliced_wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    met = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("__id"))).select("doc_id", "text", *MASKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in query.items]
        for b in small_batches(batches):
            masks = np.stack([b.column(2 + i).to_numpy() for i in range(len(MASKS))], axis=1)
            asked = np.unpackbits(np.ascontiguousarray(masks).view(np.uint8), axis=1, bitorder="little")
            for doc_id, text, mine in zip(b.column(0).to_pylist(), text_bytes(b.column(1)), asked):
                words = terms(text)
                if not words:
                    continue
                m, tf = query.norm(np.int64(len(words))), np.zeros(len(query.words), np.int64)
                for word, many in Counter(words).items():
                    at = query.words.get(word)
                    if at is not None:
                        tf[at] = many
                gain = impact(tf, m)
                for q in np.flatnonzero(mine).tolist():
                    at, weight = query.items[q]
                    score = int(weight.astype(np.int64) @ gain[at])
                    if score > 0:
                        best[q].append((-score, doc_id is None, doc_id))
                        if len(best[q]) >= 4 * k:
                            best[q] = sorted(best[q])[:k]
        rows = [(q, -s, d) for q, found in enumerate(best) for s, _, d in sorted(found, key=lambda x: x[:2] + (x[2] or 0,))[:k]]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64()))], ["item", "score", "doc_id"])

    return _top(met.mapInArrow(run, "item int, score long, doc_id long"), "score", k)


# ---------------------------------------------------------------- search

def _item_terms(items: DataFrame) -> DataFrame:
    """Per item with a term: ``item_id``, its different terms and how often it has each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            found = [(i, Counter(terms(t))) for i, t in zip(b.column(0).to_pylist(), text_bytes(b.column(1)))]
            found = [(i, c) for i, c in found if c]
            yield pa.RecordBatch.from_arrays([
                pa.array([i for i, _ in found], pa.int64()), pa.array([[w.decode() for w in c] for _, c in found], pa.list_(pa.string())),
                pa.array([list(c.values()) for _, c in found], pa.list_(pa.int64()))], ["item_id", "terms", "counts"])

    return items.select(F.col("item_id").cast("long"), "text").mapInArrow(run, "item_id long, terms array<string>, counts array<long>")


def _item_blocks(items: DataFrame) -> Iterator[list]:
    """Lists of at most ``ITEMS`` items and about ``ITEM_TERMS`` terms; the driver holds one at a time."""
    held, size = [], 0
    for row in _item_terms(items).toLocalIterator():
        if held and (len(held) == ITEMS or size + len(row.terms) > ITEM_TERMS):
            yield held
            held, size = [], 0
        held.append(row)
        size += len(row.terms)
    if held:
        yield held


def search(docs: DataFrame, items: DataFrame, k: int = 10, index: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: per item its k best documents with a score above 0."""
    spark = docs.sparkSession
    blocks, counts = index or build(docs)
    n_docs, n_terms = blocks.select(F.size("lengths").alias("n"), F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("l")).agg(F.sum("n"), F.sum("l")).first()
    results = []
    for rows in _item_blocks(items) if n_docs else ():
        words = sorted({w for r in rows for w in r.terms})
        asked = spark.createDataFrame([(w,) for w in words], "term string")  # bounded: one block of items
        df = {r.term: r.df for r in counts.join(F.broadcast(asked), "term").collect()}
        weight = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for w, n in df.items()}
        held = [w for w in words if weight.get(w, 0) > 0]  # a term of no document, or of weight 0, adds nothing
        place = {w: i for i, w in enumerate(held)}
        wanted = [[(place[w], c * weight[w]) for w, c in zip(r.terms, r.counts) if w in place] for r in rows]
        query = Query(hashes([w.encode() for w in held]), {w.encode(): i for w, i in place.items()},
                      [(np.array([p for p, _ in x], np.int64), np.array([v for _, v in x], np.float64)) for x in wanted], n_docs, n_terms)
        if not held:
            continue
        first = stage_table(_best(query, blocks, k).select("item", "doc_id"), "bitsliced_first")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("item") % 64)
        first = _one_each(first.select("doc_id", *(F.when(F.floor(F.col("item") / 64) == i, bit).otherwise(0).alias(c) for i, c in enumerate(MASKS))))
        floors = np.ones(len(rows), np.int64)
        for r in _scored(query, docs, first, k).where(F.col("rank") == k).collect():
            floors[r["item"]] = r.score
        found = _scored(query, docs, _reaching(query, blocks, floors), k)
        ids = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], "item int, item_id long")
        results.append(stage_table(found.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"), "bitsliced_found"))
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def op11_bitsliced_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


ORACLE = """
WITH d AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
    FROM documents),
i AS (
    SELECT row_number() OVER () AS item, item_id,
           unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM benchmark),
held AS (SELECT row, doc_id, len(words)::BIGINT AS n, words FROM d WHERE len(words) > 0),
total AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS l FROM held),
asked AS (SELECT item, item_id, term, count(*)::BIGINT AS many FROM i GROUP BY ALL),
tf AS (SELECT row, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT row, doc_id, n, unnest(words) AS term FROM held)
       WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(nd) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, total GROUP BY term),
s AS (SELECT item, item_id, row, doc_id,
             sum(many * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * nd) // l))))::BIGINT AS score
      FROM asked JOIN tf USING (term) JOIN w USING (term), total GROUP BY item, item_id, row, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
    SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST, row) AS rank FROM s WHERE score > 0)
WHERE rank <= 10
"""
