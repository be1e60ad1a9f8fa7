"""Mixing sources to target weights by pivotal dependent rounding.

A document's size is its number of words (``[^\\x20\\x09-\\x0D]+``).  Sources in code-point order, null last,
weigh 1, 2, 3, 1, 2, ...; by weight they share the words of all documents.  A target stops at three times
its source's size, and the excess is shared by weight again until none is above.

A document is wanted ``target / source size`` times: a whole number of copies, the same for its source, and
a fraction, which is rounded so that the source's words come out near the target:

* Two documents with open fractions meet.  Words are moved from one to the other, in one of the two
  directions by a random draw, until one fraction is 0 or 1.  What the two are worth together does not
  change, and the draw's odds keep the expectation of each.  The other document stays open and meets the next.
* Each source's documents are dealt to chunks and walked from the largest to the smallest.  An open document
  with over ``1 / LARGE`` of the words that follow in its chunk meets all of them as one: it is rounded at
  once, and their common fraction makes up for it.  A task holds one open document a chunk and hands
  on the last, a small one.
* The open documents of ``FAN`` chunks meet in the next level of a tree, until a source has one.  That one is
  rounded by its fraction, so a source misses its target by less than the size of that document.

Draws are hashes of the two ids, the level and the seed: reruns agree, whatever the partitions.

Cases: null text has size 0 and is taken 0 words; null sources are one source; a null ``doc_id`` is an id
like any other; repeated rows are documents each; with no words at all, targets are 0; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table, small_batches, stage_table, text_bytes
from .ranks import ranked

WEIGHTS = (1, 2, 3)
#: A target, and so the words taken from a document, is at most this many times the size.
MOST = 3
SEED = 13
#: Documents of a chunk (about), and chunks whose open documents meet in the next level.
CHUNK = 1 << 12
FAN = 1 << 10
#: A document this many times of which outweigh what follows in its chunk meets all of it as one.
LARGE = 32
#: Fractions nearer to 0 or 1 than this are whole.
NEAR = 1e-12

OPEN = "doc_id long, g string, size long, source_size long, target double, copies long, x double, chunk long"


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source`` and ``size`` (words; ``bytes.split`` is ASCII-only)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            n = pa.array([len(t.split()) for t in text_bytes(b.column(2))], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), n], ["doc_id", "source", "size"])

    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), "text").mapInArrow(run, "doc_id long, source string, size long")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per source ``g`` (its key), ``source_size``, ``n_docs`` and ``target``.  The driver sees sums only."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    rows = sums.select(F.lit("").alias("all"), F.col("source").isNull().alias("none"), "source", "source_size", "n_docs")
    by_place = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    rows = stage_table(ranked(rows, "all", ["none", "source"], "mixing_sources").withColumn("weight", by_place), "mixing_weights")
    limit, whole = F.col("source_size") * most, rows.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:  # the level only rises, and each round but the last stops another source
        stopped = limit < F.col("weight") * F.lit(level)
        many, held, share = rows.agg(F.count_if(stopped), F.sum(F.when(stopped, limit).otherwise(0)), F.sum(F.when(stopped, 0).otherwise(F.col("weight")))).first()
        if many == full or not share:
            break
        full, level = many, (whole - held) / share
    return rows.select(_key(F.col("source")).alias("g"), "source_size", "n_docs", F.least(limit.cast("double"), F.col("weight") * F.lit(level)).alias("target"))


def _draw(a, b, at: int, level: int, seed: int) -> float:
    return xxhash.xxh64_intdigest(f"{a} {b} {at} {level}", seed) / 2.0**64


def transfer(size_a: int, a: float, size_b: int, b: float, draw: float) -> tuple[float, float]:
    """New fractions of two documents, at least one of them 0 or 1; ``size_a * a + size_b * b`` stays."""
    up, down = min(size_a * (1 - a), size_b * b), min(size_a * a, size_b * (1 - b))
    moved = up if draw * (up + down) < down else -down  # odds: what the other direction would move
    a, b = a + moved / size_a, b - moved / size_b
    a, b = (0.0 if x < NEAR else 1.0 if x > 1 - NEAR else x for x in (a, b))
    return a, b


class Rest:
    """What follows in a chunk, as one: so many ``words``, all wanted by the same ``fraction``."""

    def __init__(self, words: int, fraction: float):
        self.words, self.fraction = words, fraction

    def rounds(self, size: int, x: float, draw: float) -> float | None:
        """The document rounded against all that follows; None if it is not large or that does not suffice.
        Either way the rest gives or takes the document's words, so its expectation stays too."""
        if size * LARGE <= self.words:
            return None
        less, more = self.fraction - size * (1 - x) / max(self.words, 1), self.fraction + size * x / max(self.words, 1)
        if less <= NEAR or more >= 1 - NEAR:
            return None
        self.fraction = less if draw < x else more
        return 1.0 if draw < x else 0.0


def _meet(level: int, seed: int):
    """Documents sorted by source and chunk, each with its chunk's words; one open document of each chunk
    is handed on.  Only in the first level are a chunk's fractions the same, so only there is a rest one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list | None = None  # the open document; x is its column 6
        now, rest, at = None, None, 0
        for b in batches:
            out = []
            for *row, words in zip(*(c.to_pylist() for c in b.columns)):
                if now != (row[1], row[7]):
                    out += [kept] if kept else []
                    kept, now, rest, at = None, (row[1], row[7]), None if level else Rest(words, row[6]), 0
                at += 1
                if rest:
                    whole = rest.rounds(kept[2], kept[6], _draw(kept[0], "", at, level, seed)) if kept else None
                    if whole is not None:
                        kept[6] = whole
                        out.append(kept)
                        kept = None
                    row[6] = rest.fraction
                    rest.words -= row[2]
                if kept:
                    kept[6], row[6] = transfer(kept[2], kept[6], row[2], row[6], _draw(kept[0], row[0], at, level, seed))
                both = [kept, row] if kept else [row]
                out += [r for r in both if not 0 < r[6] < 1]
                kept = next((r for r in both if 0 < r[6] < 1), None)
            if out:
                yield _batch(out, b.schema)
        if kept:
            yield _batch([kept], b.schema)

    return run


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    fields = list(schema)[:8]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(fields)], [f.name for f in fields])


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """Per row ``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` (words) and ``copies``."""
    spark = docs.sparkSession
    sized = stage_table(sizes(docs), "mixing_sizes")
    shares = stage_table(targets(sized, weights, most), "mixing_targets")
    largest = shares.agg(F.max("n_docs")).first()[0] or 0
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    chunks = F.ceil(F.col("n_docs") / CHUNK)
    rows = (sized.select("doc_id", _key(F.col("source")).alias("g"), "size").join(shares, "g")
            .withColumn("copies", F.floor(wanted)).withColumn("x", F.when(F.col("size") > 0, wanted - F.floor(wanted)).otherwise(0.0))
            .withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.lit(seed)), chunks)))
    fields = [f.split()[0] for f in OPEN.split(", ")]
    rows = rows.select(*fields)
    done = [rows.where((F.col("x") < NEAR) | (F.col("x") > 1 - NEAR)).withColumn("x", F.round("x"))]
    now = rows.where((F.col("x") >= NEAR) & (F.col("x") <= 1 - NEAR))
    many, level = -(-largest // CHUNK), 0
    while True:
        words = F.sum("size").over(Window.partitionBy("g", "chunk"))
        dealt = now.repartition("g", "chunk").withColumn("words", words).sortWithinPartitions("g", "chunk", F.desc("size"), F.xxhash64("doc_id"), "doc_id")
        met = stage_table(dealt.mapInArrow(_meet(level, seed), OPEN), "mixing_open")
        whole = (F.col("x") == 0) | (F.col("x") == 1)
        done.append(met.where(whole))
        if many <= 1:
            last = F.shiftrightunsigned(F.xxhash64("g", F.lit(seed)), 11) / float(1 << 53)
            done.append(met.where(~whole).withColumn("x", (last < F.col("x")).cast("double")))
            break
        now = met.where(~whole).withColumn("chunk", F.floor(F.col("chunk") / FAN))
        many, level = -(-many // FAN), level + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    copies = (F.col("copies") + F.col("x")).cast("long")
    return out.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"))


def op13_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents"))
