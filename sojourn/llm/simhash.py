"""SimHash near-duplicates by fuzzy hashing with the binary Golay code.

Fingerprint: lower-case A-Z, words ``[^\\x20\\x09-\\x0D]+``, 3-word shingles
(repeats included, joined by a space; fewer words: the whole sequence), XXH64
with seed 42; a bit is 1 if it is set in over half of the hashes.  A text
without words has fingerprint zero and links like any other.

Search for pairs that differ in at most 3 bits, over distinct fingerprints:

* The 64 bits are cut into segments of 23, 23 and 18 bits.  The perfect Golay
  code [23,12,7] gives each segment the index of its nearest codeword, and
  ``near(s)`` the indices reached by flipping at most one bit: one or six keys.
  If two segments differ in one bit at most, the index of each is in ``near``
  of the other.
* Pigeonhole: with 3 errors at most, either one segment is equal and another
  has at most one error (six ordered pairs of segments: key = equal segment,
  index), or each of the three has at most one error (key = three indices).
* Every fingerprint is filed under few keys and probes with the rest; rows meet
  by key after one shuffle, and each candidate pair is verified by counting
  bits inside the task.  A task returns a spanning forest of the links found in
  each of its blocks, so a dense group costs links in proportion to its
  members, while components stay exactly those of all links.  Each key's probes
  are dealt to ``SALTS`` tasks, each of which has all that is filed there.

Cases: null text counts as empty; null ``doc_id`` rows keep their row, link
like others, and never become a component's id unless it has no other; repeated
rows each give a row; an empty table gives an empty result; other columns are
ignored by the search and kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bitmap import bitmap, bitmap_bits
from .common import read_table, small_batches, stage_table, text_bytes
from .components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
SALTS = 4
#: Key rows handled at once, and pairs compared at once, inside a task.
BLOCK_ROWS = 1 << 18
BLOCK_PAIRS = 1 << 21


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint; ``bytes.lower`` and ``bytes.split`` are ASCII-only."""
    words = text.lower().split()
    if not words:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    runs = zip(*(words[i:] for i in range(shingle))) if len(words) > shingle else [words]
    h = np.array([digest(join(run), SEED) for run in runs], "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[at: at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view("<u8")[0])


def _prints(texts: pa.Array) -> pa.Array:
    return pa.array(np.array([fingerprint(t) for t in text_bytes(texts)], np.uint64).view(np.int64))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint's bits as a signed long; one row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), _prints(b.column(1))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


# ---------------------------------------------------------------- Golay keys

@cache
def decoder() -> np.ndarray:
    """Index of the codeword within 3 bits of each 23-bit word; the code is perfect, so there is one."""
    generator = 0b110001110101  # fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
    message = np.arange(4096, dtype=np.int32)
    rest = message << 11
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (generator << (bit - 11)), rest)
    words = message << 11 | rest
    table = np.empty(1 << 23, np.int16)
    one = 1 << np.arange(23, dtype=np.int32)
    for i in range(24):
        for j in range(i + 1):
            flips = (one[i] if i < 23 else 0) ^ (one[j] if j < i else 0)
            for k in [*range(j), 23] if j < i else [23]:
                table[words ^ (flips ^ (one[k] if k < 23 else 0))] = message
    return table


def segments(fp: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """The three segments and how many bits each has."""
    u = fp.view(np.uint64)
    low = np.uint64((1 << 23) - 1)
    return [((u & low).astype(np.int64), 23), ((u >> np.uint64(23) & low).astype(np.int64), 23), ((u >> np.uint64(46)).astype(np.int64), 18)]


def near(seg: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, codeword index) pairs: the distinct indices within one flipped bit of each row's segment."""
    table = decoder()
    flips = np.concatenate([[0], 1 << np.arange(bits)])
    all_of = np.sort(table[seg[:, None] ^ flips[None, :]], axis=1)
    first = np.ones(all_of.shape, bool)
    first[:, 1:] = all_of[:, 1:] != all_of[:, :-1]
    row, at = np.nonzero(first)
    return row, all_of[row, at].astype(np.int64)


def _pairs(row_a: np.ndarray, row_b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions that pair each entry of a with every entry of b of the same row (both sorted by row)."""
    many = np.bincount(row_b, minlength=n)
    start = np.cumsum(many) - many
    left = np.repeat(np.arange(len(row_a)), many[row_a])
    ahead = np.arange(len(left)) - np.repeat(np.cumsum(many[row_a]) - many[row_a], many[row_a])
    return left, start[row_a][left] + ahead


def keys(fp: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[tuple[np.ndarray, np.ndarray]]]:
    """(key, row) arrays: what each fingerprint is filed under, and what it probes."""
    table, parts = decoder(), segments(fp)
    rows, n = np.arange(len(fp)), len(fp)
    index = [table[s].astype(np.int64) for s, _ in parts]
    fuzzy = [near(s, bits) for s, bits in parts]
    filed, probed = [], []
    kind = 0
    for equal in range(3):
        for other in range(3):
            if other != equal:
                head = (kind << 36) | (parts[equal][0] << 12)
                row, code = fuzzy[other]
                filed.append((head | index[other], rows))
                probed.append((head[row] | code, row))
                kind += 1
    row, code = fuzzy[0]
    filed.append((kind << 36 | code << 24 | index[1][row] << 12 | index[2][row], row))
    (row_b, code_b), (row_c, code_c) = fuzzy[1], fuzzy[2]
    left, right = _pairs(row_b, row_c, n)
    row = row_b[left]
    probed.append((kind << 36 | index[0][row] << 24 | code_b[left] << 12 | code_c[right], row))
    return filed, probed


def key_rows(prints: DataFrame, salts: int = SALTS) -> DataFrame:
    """``key``, ``probe`` and ``fp`` for distinct fingerprints: filed rows for every salt, probes for one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                fp = b.column(0).slice(at, 2000).to_numpy()
                filed, probed = keys(fp)
                mine = (fp.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % salts << 40
                put = [(k | s << 40, r) for k, r in filed for s in range(salts)]
                ask = [(k | mine[r], r) for k, r in probed]
                n = sum(len(k) for k, _ in put)
                key = np.concatenate([k for k, _ in put + ask])
                row = np.concatenate([r for _, r in put + ask])
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.arange(len(key)) >= n), pa.array(fp[row])], ["key", "probe", "fp"])

    return prints.select("fp").mapInArrow(run, "key long, probe boolean, fp long")


# ---------------------------------------------------------------- verified links

def _forest(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> list[int]:
    """Positions of the links that join two sets; ``label`` (each node's set) is brought up to date."""
    out = []
    live = np.flatnonzero(label[a] != label[b])
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:
            parent[x], x = root, parent[x]
        return root

    for at, x, y in zip(live.tolist(), label[a[live]].tolist(), label[b[live]].tolist()):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append(at)
    if parent:
        sets = np.array(sorted(parent))
        roots = np.array([find(x) for x in sets.tolist()])
        at = np.searchsorted(sets, label)
        at[at == len(sets)] = 0
        label[:] = np.where(sets[at] == label, roots[at], label)
    return out


def _links(key: np.ndarray, probe: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the verified links among whole key groups; rows are sorted by key, filed first."""
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
    filed = np.add.reduceat((~probe).astype(np.int64), edge)
    asks = np.flatnonzero(probe)
    many = filed[group[asks]]
    asks, many = asks[many > 0], many[many > 0]
    nodes, node = np.unique(fp, return_inverse=True)
    label = np.arange(len(nodes))
    u, v = [], []
    total = np.cumsum(many)
    at = 0
    while at < len(asks):
        done = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + BLOCK_PAIRS, side="right")))
        left = np.repeat(asks[at:to], many[at:to])
        ahead = np.arange(len(left)) - np.repeat(total[at:to] - many[at:to] - done, many[at:to])
        right = edge[group[left]] + ahead
        bits = np.bitwise_count((fp[left] ^ fp[right]).view(np.uint64))
        ok = (bits > 0) & (bits <= max_bits)
        a, b = node[left[ok]], node[right[ok]]
        chosen = _forest(a, b, label)
        u.append(nodes[a[chosen]])
        v.append(nodes[b[chosen]])
        at = to
    none = np.empty(0, np.int64)
    return np.concatenate([none, *u]), np.concatenate([none, *v])


def links(prints: DataFrame, max_bits: int = MAX_BITS, salts: int = SALTS) -> DataFrame:
    """``u``, ``v``: links between distinct fingerprints that connect what all links connect."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            key, probe, fp = (np.concatenate(x) for x in zip(*held))
            cut = len(key) if last else int(np.searchsorted(key, key[-1]))  # the last key may go on
            if cut:
                u, v = _links(key[:cut], probe[:cut], fp[:cut], max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])
            held[:] = [(key[cut:], probe[cut:], fp[cut:])] if cut < len(key) else []

        size = 0
        for b in batches:
            held.append((b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy()))
            size += b.num_rows
            if size >= BLOCK_ROWS:
                yield from flush(False)
                size = 0
        if held:
            yield from flush(True)

    rows = key_rows(prints, salts).repartition("key").sortWithinPartitions("key", "probe")
    return rows.mapInArrow(run, "u long, v long")


def classes(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id``, ``fp`` and ``root`` (the smallest fingerprint of its component), one row per input row."""
    prints = stage_table(fingerprints(docs), "simhash")
    nodes = components(links(prints.select("fp").distinct(), max_bits))
    return (prints.join(nodes.withColumnRenamed("node", "fp"), "fp", "left")
            .select("doc_id", "fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest ``doc_id`` of the component)."""
    found = stage_table(classes(docs, max_bits), "simhash_classes")
    least = stage_table(found.groupBy("root").agg(F.min("doc_id").alias("component_id")), "simhash_least")
    return found.join(least, "root").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Of each group the document with the smallest ``doc_id``, with all its columns (one row, if rows
    repeat it; a null ``doc_id`` only where the group has no other).

    A bitmap of bounded size holds the ids that some row in doubt has: one that its group drops, or that
    repeats an id.  Rows outside it stay without a shuffle; the others, and rows without an id, are decided
    by an exact join on id and fingerprint."""
    found = stage_table(classes(docs, max_bits), "simhash_classes")
    least = stage_table(found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")).alias("x"))
                        .select("root", F.col("x.doc_id").alias("__id"), F.col("x.fp").alias("__fp")), "simhash_least")
    own = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("fp") == F.col("__fp"))
    in_doubt = (found.join(least, "root").where("doc_id is not null").groupBy("doc_id")
                .agg(F.count("*").alias("n"), F.bool_and(own).alias("own")).where("n > 1 or not own"))
    in_doubt = stage_table(in_doubt.select(F.xxhash64("doc_id").alias("h")), "simhash_doubt")
    seen = bitmap(in_doubt, bitmap_bits(16 * in_doubt.count()))

    @F.pandas_udf("boolean")
    def listed(h: pd.Series) -> pd.Series:
        return pd.Series(seen.has(h.to_numpy(np.int64).view(np.uint64)))

    at = docs.columns.index("text")
    schema = docs.select("*", F.lit(0).cast("long").alias("__print")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            yield pa.RecordBatch.from_arrays([*b.columns, _prints(b.column(at))], [*b.schema.names, "__print"])

    doubt = F.col("doc_id").isNull() | listed(F.xxhash64(F.col("doc_id").cast("long")))
    marked = docs.where(doubt).mapInArrow(run, schema)
    decided = (marked.join(least.drop("root"), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__print") == F.col("__fp")), "left_semi")
               .dropDuplicates(["doc_id", "__print"]).select(*docs.columns))
    return docs.where(~doubt).unionByName(decided)


def op4_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
