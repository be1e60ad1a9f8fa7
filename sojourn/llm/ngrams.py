"""Elias-Fano n-gram tries for language-model scores.

Model: tokens are words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z folded, then
one end.  ``p1(w) = (c + 1) / (N + V + 1)`` and, interpolated with an absolute
discount D, ``p(w | v) = max(c(vw) - D, 0) / c(v.) + D * N1+(v.) / c(v.) * p1(w)``
(p1 where v never occurs as a context; the first token's context is a start).

The trie of a shard (contexts dealt by hash) is one file of levels that are
memory-mapped: the contexts' hashes and the monotone pointers to their ranges as
Elias-Fano sequences; the successors of all contexts, numbered relative to their
context, as one more Elias-Fano sequence; and the smoothed probabilities and
back-off weights as 8-bit codes of their logarithms.  A query finds the context,
takes its range from the pointers, and searches the successor in the range.

Jobs.  (1) Blocks: a task turns a few megabytes of text into its distinct words
and each token's word number, written as a file of the shared folder; a block's
distinct bigrams follow from it.  (2) Shards: every block sends each shard one packed row of its
words and bigrams, counts pre-aggregated; a shard sums them, builds and writes
its trie, and answers each block from the mapped trie.  (3) Scores: a block
meets its answers and sums over its documents.  A frequent word or bigram is one
entry per block wherever it falls.  All counts cover all training documents.

Words are held as 64-bit hashes, successors within a context as 40 bits.  The number
of shards grows with the blocks' words and tokens, so a shard's do not.

Cases: null text is empty text (one end token); a null ``doc_id`` is a training
document; repeated rows each count and each give a row; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from . import arrays
from .common import read_table, small_batches, stage_table, text_bytes

DISCOUNT = 0.75
SUCCESSOR_BITS = 40
#: Bounds of a shard; a shard of over 2 ** 23 words would not have room for the successors' bits.
SHARD_WORDS = 4_000_000
SHARD_TOKENS = 32_000_000
CODES = 255  # code 255: absent
LOWEST = -8.0  # log10 of the smallest coded value
END = xxhash.xxh64_intdigest(b"")  # no word is empty
START = xxhash.xxh64_intdigest(b" start")  # no word has a space


# ---------------------------------------------------------------- Elias-Fano

class EliasFano:
    """A rising sequence of n integers under 2 ** bits: low bits packed, high bits as a bitmap with one set
    bit per value, and the number of set bits before each 64-bit word."""

    def __init__(self, low: np.ndarray, high: np.ndarray, before: np.ndarray, shape: np.ndarray):
        self.low, self.high, self.before = low, high, before
        self.n, self.low_bits = int(shape[0]), int(shape[1])
        self.zeros = np.arange(len(high), dtype=np.int64) * 64 - before  # unset bits before each word

    @staticmethod
    def pack(values: np.ndarray, bits: int) -> dict[str, np.ndarray]:
        n = len(values)
        low_bits = min(56, max(0, bits - max(0, n - 1).bit_length()))
        v = values.astype(np.uint64)
        out = []
        for at in range(0, n, 1 << 15):  # a multiple of 8 values fills whole bytes
            part = (v[at: at + (1 << 15), None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
            out.append(np.packbits(part.astype(np.uint8).ravel(), bitorder="little"))
        low = np.concatenate([*out, np.zeros(8, np.uint8)])
        high = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        size = (int(high[-1]) if n else 0) // 64 + 2
        bitmap = np.zeros(size * 64, np.uint8)
        bitmap[high] = 1
        words = np.packbits(bitmap, bitorder="little").view("<u8")
        before = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))[:-1]])
        return {"low": low, "high": words, "before": before, "shape": np.array([n, low_bits])}

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Position of the k-th (from 0) set or unset bit."""
        before = self.before if ones else self.zeros
        word = np.searchsorted(before, k, side="right") - 1
        left = (k - before[word]).astype(np.int64)
        bits = self.high[word] if ones else ~self.high[word]
        at = np.zeros(len(k), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count(bits >> at.astype(np.uint64) & np.uint64((1 << width) - 1)).astype(np.int64)
            skip = left >= count
            left -= np.where(skip, count, 0)
            at += np.where(skip, width, 0)
        return word * 64 + at

    def _lows(self, i: np.ndarray) -> np.ndarray:
        at = i * self.low_bits
        byte, shift = at >> 3, (at & 7).astype(np.uint64)
        out = np.zeros(len(i), np.uint64)
        for k in range(8):
            out |= self.low[byte + k].astype(np.uint64) << np.uint64(8 * k)
        return out >> shift & np.uint64((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at positions ``i``."""
        if not len(i):
            return np.empty(0, np.uint64)
        high = self._select(i, True) - i
        return high.astype(np.uint64) << np.uint64(self.low_bits) | self._lows(i)

    def find(self, x: np.ndarray, lo: np.ndarray | None = None, hi: np.ndarray | None = None) -> np.ndarray:
        """Position of each ``x``, or -1; within [lo, hi) if given."""
        if not self.n or not len(x):
            return np.full(len(x), -1)
        head = (x >> np.uint64(self.low_bits)).astype(np.int64)
        top = int(self._select(np.array([self.n - 1]), True)[0]) - (self.n - 1)  # the largest high part
        inside = head <= top
        h = np.where(inside, head, 0)
        start = np.where(h > 0, self._select(np.maximum(h - 1, 0), False) + 1 - h, 0)
        end = np.where(h < top, self._select(h, False) - h, self.n)
        if lo is not None:
            start, end = np.maximum(start, lo), np.minimum(end, hi)
        want = x & np.uint64((1 << self.low_bits) - 1)
        a, z = start.copy(), np.maximum(end, start)
        while (live := a < z).any():
            mid = (a + z) >> 1
            less = self._lows(np.minimum(mid, self.n - 1)) < want
            a, z = np.where(live & less, mid + 1, a), np.where(live & ~less, mid, z)
        at = np.minimum(a, self.n - 1)
        return np.where(inside & (a < end) & (self._lows(at) == want), at, -1)


def code(value: np.ndarray) -> np.ndarray:
    """8-bit codes of values in (0, 1], evenly spaced in their logarithm."""
    log = np.log10(np.maximum(value, 10.0 ** LOWEST))
    return np.clip(np.rint((1 - log / LOWEST) * (CODES - 1)), 0, CODES - 1).astype(np.uint8)


VALUE = np.append(10.0 ** (LOWEST * (1 - np.arange(CODES) / (CODES - 1))), 0.0)


class Trie:
    def __init__(self, path: str):
        a = arrays.mapped(path)
        level = lambda name: EliasFano(*(a[f"{name}.{part}"] for part in ("low", "high", "before", "shape")))
        self.contexts, self.pointers, self.successors = level("contexts"), level("pointers"), level("successors")
        self.alpha, self.gamma, self.bits = a["alpha"], a["gamma"], int(a["bits"][0])

    @staticmethod
    def build(path: str, contexts: np.ndarray, rank: np.ndarray, successor: np.ndarray, count: np.ndarray, bits: int, discount: float) -> None:
        """``contexts`` rising hashes; per bigram its context's rank, its successor (``bits`` bits) and count,
        rising by rank and successor."""
        total = np.bincount(rank, weights=count, minlength=len(contexts))
        kinds = np.bincount(rank, minlength=len(contexts))
        levels = {
            "contexts": EliasFano.pack(contexts, 64),
            "pointers": EliasFano.pack(np.concatenate([[0], np.cumsum(kinds)]), max(1, len(rank).bit_length())),
            "successors": EliasFano.pack(rank.astype(np.uint64) << np.uint64(bits) | successor, bits + max(1, len(contexts).bit_length())),
        }
        arrays.save(path, {f"{name}.{part}": x for name, parts in levels.items() for part, x in parts.items()} | {
            "alpha": code(np.maximum(count - discount, 0) / total[rank]) if len(rank) else np.empty(0, np.uint8),
            "gamma": code(discount * kinds / np.maximum(total, 1)), "bits": np.array([bits])}, compress=False)

    def codes(self, contexts: np.ndarray, many: np.ndarray, successor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of each context's back-off weight and of each bigram; ``many``: bigrams of each context."""
        at = self.contexts.find(contexts)
        seen = at >= 0
        gamma = np.full(len(contexts), CODES, np.uint8)
        gamma[seen] = self.gamma[at[seen]]
        lo, hi = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        lo[seen], hi[seen] = self.pointers.get(at[seen]).astype(np.int64), self.pointers.get(at[seen] + 1).astype(np.int64)
        rank, keep = np.repeat(at, many), np.repeat(seen, many)
        found = np.full(len(successor), -1)
        found[keep] = self.successors.find(rank[keep].astype(np.uint64) << np.uint64(self.bits) | successor[keep],
                                           np.repeat(lo, many)[keep], np.repeat(hi, many)[keep])
        alpha = np.full(len(successor), CODES, np.uint8)
        alpha[found >= 0] = self.alpha[found[found >= 0]]
        return gamma, alpha


# ---------------------------------------------------------------- blocks

class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


BLOCK_SCHEMA = "block long, path string, train_tokens long, tokens long, words long"


def write_blocks(docs: DataFrame, folder: str) -> DataFrame:
    """One file per block; a row (``block``, ``path``, its training tokens, tokens and distinct words) for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, block = _Hashes(), TaskContext.get().partitionId() << 32
        for b in small_batches(batches):
            ids = b.column(0).to_pylist()
            tokens, sizes = [], []
            for text in text_bytes(b.column(1)):
                words = text.lower().split()
                tokens.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
                tokens.append(np.array([END], np.uint64))
                sizes.append(len(words) + 1)
            words, number = np.unique(np.concatenate(tokens), return_inverse=True)
            size = np.array(sizes)
            train = np.array([not held_out(i) for i in ids])
            path = f"{folder}/{block:016x}-{uuid.uuid4().hex}"
            arrays.save(path, {
                "doc": np.array([i if i is not None else 0 for i in ids], np.int64), "null": np.array([i is None for i in ids]), "train": train, "size": size,
                "words": words, "number": number.astype(np.uint32)}, compress=True)
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (block, path, int(size[train].sum()), int(size.sum()), len(words))], ["block", "path", "train_tokens", "tokens", "words"])
            block += 1

    return stage_table(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, BLOCK_SCHEMA), "ngram_blocks")


def _bigrams(words: np.ndarray, number: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many distinct bigrams each context (words, then the start) has, their second words, and each
    token's bigram; bigrams are in order of context and second word."""
    before = np.concatenate([[0], number[:-1]]).astype(np.int64)
    before[np.cumsum(size) - size] = len(words)
    pair, token = np.unique(before * len(words) + number, return_inverse=True)
    return np.bincount(pair // len(words), minlength=len(words) + 1), pair % len(words), token


def _deal(words: np.ndarray, many: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each shard the contexts (numbers in words, then the start) and the bigrams that it owns."""
    shard = (np.append(words, np.uint64(START)) >> np.uint64(8)) % np.uint64(shards)
    order = np.argsort(shard, kind="stable")
    cut = np.searchsorted(shard[order], np.arange(shards + 1))
    many = many.astype(np.int64)
    first = np.cumsum(many) - many
    for s in range(shards):
        mine = order[cut[s]: cut[s + 1]]
        n = many[mine]
        bigrams = np.repeat(first[mine], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        if len(mine):
            yield s, mine, bigrams


def _packed(*parts: np.ndarray) -> bytes:
    blobs = [arrays.squeezed(p) if len(p) else b"" for p in parts]
    return b"".join(len(b).to_bytes(8, "little") + b for b in blobs)


def _unpacked(blob: bytes, *kinds: str) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        size = int.from_bytes(blob[at: at + 8], "little")
        out.append(arrays.unsqueezed(blob[at + 8: at + 8 + size], kind) if size else np.empty(0, kind))
        at += 8 + size
    return out


def _short(hashes: np.ndarray) -> np.ndarray:
    """The top 40 bits as five bytes each."""
    return (hashes >> np.uint64(24)).view(np.uint8).reshape(-1, 8)[:, :5].ravel()


def _long(five: np.ndarray) -> np.ndarray:
    out = np.zeros((len(five) // 5, 8), np.uint8)
    out[:, :5] = five.reshape(-1, 5)
    return out.view("<u8").ravel()


def to_shards(blocks: DataFrame, shards: int) -> DataFrame:
    """``shard``, ``block``, ``data``: what each block has of each shard, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, path in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words, number, size, train = arrays.load(path, ["words", "number", "size", "train"])
                many, following, token = _bigrams(words, number, size)
                counted = np.repeat(train, size)
                every = np.append(words, np.uint64(START))
                count = np.bincount(number[counted], minlength=len(every)).astype(np.uint32)
                pair_count = np.bincount(token[counted], minlength=len(following)).astype(np.uint32)
                many = many.astype(np.uint32)
                rows = [(s, block, _packed(every[c], count[c], many[c], _short(words[following[g]]), pair_count[g])) for s, c, g in _deal(words, many, shards)]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary()))], ["shard", "block", "data"])

    return blocks.select("block", "path").mapInArrow(run, "shard int, block long, data binary")


ANSWER_SCHEMA = "shard int, block long, data binary, words long, model string, bigrams long"


def answers(sent: DataFrame, folder: str, discount: float = DISCOUNT) -> DataFrame:
    """Per shard: sum, build and write the trie, answer each block; and a row without block that has the
    number of distinct training words, the trie's file and its bigrams."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = int(pdf["shard"].iloc[0])
        parts = [_unpacked(d, "<u8", "<u4", "<u4", "u1", "<u4") for d in pdf["data"]]
        words, number = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        word_count = np.bincount(number, weights=np.concatenate([p[1] for p in parts]), minlength=len(words)).astype(np.int64)
        many = np.concatenate([p[2] for p in parts])
        bits = SUCCESSOR_BITS
        if len(words).bit_length() + bits > 63:
            raise ValueError(f"{len(words)} words in a shard: successors would lose bits; take more shards")
        successor = _long(np.concatenate([p[3] for p in parts]))
        count = np.concatenate([p[4] for p in parts])
        key = np.repeat(number, many).astype(np.uint64) << np.uint64(bits) | successor
        pair, which = np.unique(key[count > 0], return_inverse=True)
        pair_count = np.bincount(which, weights=count[count > 0], minlength=len(pair))
        contexts, rank = np.unique((pair >> np.uint64(bits)).astype(np.int64), return_inverse=True)
        path = f"{folder}/{shard:06d}-{uuid.uuid4().hex}.trie"
        Trie.build(path, words[contexts], rank, pair & np.uint64((1 << bits) - 1), pair_count, bits, discount)
        trie = Trie(path)
        rows, c, g = [], 0, 0
        for block, p in zip(pdf["block"], parts):
            gamma, alpha = trie.codes(p[0], p[2], successor[g: g + len(p[4])])
            rows.append((shard, block, _packed(word_count[number[c: c + len(p[0])]], gamma, alpha), 0, None, 0))
            c, g = c + len(p[0]), g + len(p[4])
        rows.append((shard, None, None, int((word_count > 0).sum()), path, len(pair)))
        out = pd.DataFrame(rows, columns=["shard", "block", "data", "words", "model", "bigrams"])
        return out.astype({"block": "Int64"})

    return stage_table(sent.groupBy("shard").applyInPandas(run, ANSWER_SCHEMA), "ngram_answers")


SCORE_SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(blocks: DataFrame, answered: DataFrame, shards: int) -> DataFrame:
    """Per document its scores, block by block."""
    n = int(blocks.agg(F.sum("train_tokens")).first()[0] or 0)
    v = int(answered.agg(F.sum("words")).first()[0] or 0)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        doc, null, train, size, words, number = arrays.load(pdf["path"].iloc[0], ["doc", "null", "train", "size", "words", "number"])
        many, following, token = _bigrams(words, number, size)
        data = dict(zip(pdf["shard"], pdf["data"]))
        count = np.zeros(len(words) + 1, np.int64)
        gamma, alpha = np.empty(len(words) + 1, np.uint8), np.empty(len(following), np.uint8)
        for s, c, g in _deal(words, many, shards):
            count[c], gamma[c], alpha[g] = _unpacked(data[s], "<i8", "u1", "u1")
        p1 = (count[:-1] + 1.0) / (n + v + 1)
        back = np.where(gamma == CODES, 1.0, VALUE[gamma])
        log = np.log10(VALUE[alpha] + np.repeat(back, many) * p1[following])
        word = number.astype(np.int64)
        first = np.cumsum(size) - size
        return pd.DataFrame({
            "doc_id": pd.arrays.IntegerArray(doc.copy(), null.copy()),
            "held_out": ~train, "n_tokens": size, "n_known": np.add.reduceat((count[word] > 0).astype(np.int64), first), "train_tokens": n,
            "base_score": np.add.reduceat(np.log10(p1)[word], first), "score": np.add.reduceat(log[token], first)})

    met = answered.where("block is not null").select("shard", "block", "data").join(blocks.select("block", "path"), "block")
    return met.groupBy("block").applyInPandas(run, SCORE_SCHEMA)


def shard_count(blocks: DataFrame, least: int) -> int:
    """Shards such that one has at most about ``SHARD_WORDS`` words and ``SHARD_TOKENS`` tokens: distinct words
    and bigrams are fewer than the blocks' sums, which hashing deals evenly."""
    tokens, words = blocks.agg(F.sum("tokens"), F.sum("words")).first()
    return max(least, -(-(tokens or 0) // SHARD_TOKENS), -(-(words or 0) // SHARD_WORDS))


def train_and_score(docs: DataFrame, discount: float = DISCOUNT) -> DataFrame:
    """Train on the documents that are not held out and score all."""
    spark = docs.sparkSession
    blocks = write_blocks(docs, shared_dir(spark, "llm", "blocks"))
    shards = shard_count(blocks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    answered = answers(to_shards(blocks, shards), shared_dir(spark, "llm", "tries"), discount)
    return score(blocks, answered, shards)


def op3_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_and_score(read_table(spark, sf_dir, "documents"))
