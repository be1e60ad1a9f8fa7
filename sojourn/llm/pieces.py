"""SentencePiece encoding and decoding by a max-plus parallel scan.

A segmentation is a path through a lattice whose arcs are pieces.  An arc
weighs its piece's score; for a BPE vocabulary two arcs may follow each other
only if the encoder itself would leave the pair unmerged (weight minus infinity
otherwise), which singles out the encoder's own segmentation; for a unigram
vocabulary any arcs may, and the heaviest path is the Viterbi segmentation.
Ids therefore equal the library's.

* A text is cut every ``CHUNK`` code points.  A boundary's state is the piece
  that starts before the cut and reaches it or beyond.  Each chunk, with a
  margin of one piece length, gives on its own a matrix in the (max, +)
  semiring: the weight of the best path from each incoming to each outgoing
  state.  Only states that occur are kept.
* Matrices are combined associatively, in blocks of ``BLOCK`` and then over the
  blocks of a document; going back down gives the two states at the ends of
  every block and then of every chunk.
* With its two states known, each chunk is backtraced independently.

Within a chunk no piece spans the start of a word (white space after something
else; checked when the vocabulary is loaded).  Such points pin every path, so
the words between the first and the last of them are encoded one by one and
remembered, and only the ragged ends need the lattice.  A document of one chunk
has no inner boundary, so its end states are known from the start.

Decoding concatenates the pieces' bytes.  The escape character U+2581 in a text
stands for a space in this family of models, so that character alone does not
come back as it was.

Cases: null and empty texts have no ids; rows with null or repeated ``doc_id``
each give a row; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, small_batches, stage_table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 32768
BLOCK = 64
SPACE = "▁"
NONE = float("-inf")
_WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_START = re.compile(f"(?<=[^{SPACE}]){SPACE}")
START = (0, 0)  # the state before the first piece

Arcs = dict[tuple[int, int], float]  # a sparse max-plus matrix: (state in, state out) -> weight


class Vocabulary:
    def __init__(self, path: str, remember: int = 200_000):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm = model.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models with the identity normaliser are supported")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.merges = model.trainer_spec.model_type == proto.TrainerSpec.BPE
        if not self.merges and model.trainer_spec.model_type != proto.TrainerSpec.UNIGRAM:
            raise ValueError("only BPE and unigram models are supported")
        norm.add_dummy_prefix = False
        self.leaf = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        normal = [(p.piece, k, p.score) for k, p in enumerate(model.pieces) if p.type in (proto.ModelProto.SentencePiece.NORMAL, proto.ModelProto.SentencePiece.USER_DEFINED)]
        self.ids = {piece: k for piece, k, _ in normal}
        self.scores = np.array([p.score for p in model.pieces])
        self.unknown = min((s for _, _, s in normal), default=0.0) - 10.0
        self.longest = max(map(len, self.ids), default=1)
        self.by_word = not any(_START.search(piece) for piece in self.ids)
        self.bytes = [bytes([int(p.piece[1:-1], 16)]) if p.type == proto.ModelProto.SentencePiece.BYTE
                      else b"" if p.type == proto.ModelProto.SentencePiece.CONTROL
                      else " ⁇ ".encode() if p.type == proto.ModelProto.SentencePiece.UNKNOWN
                      else p.piece.replace(SPACE, " ").encode() for p in model.pieces]
        self.remember = remember
        self.words: dict[str, bytes] = {}
        self.tokens: dict[str, float | None] = {}
        self.follows: dict[tuple[str, str], bool] = {}

    def normal(self, text: str) -> str:
        return self.prefix + text.replace(" ", SPACE) if text else ""

    def encode_words(self, text: str) -> bytes:
        """Ids (int32) of a normalised text that begins and ends where no piece spans."""
        words = _WORDS.findall(text) if self.by_word else [text] if text else []
        known = self.words
        new = list({w for w in words if w not in known})
        if new:
            if len(known) + len(new) > self.remember:
                known.clear()
                new = list(set(words))
            for w, ids in zip(new, self.leaf.encode(new, num_threads=1)):
                known[w] = array("i", ids).tobytes()
        return b"".join(map(known.__getitem__, words))

    def token(self, piece: str) -> float | None:
        """Weight of a piece as one arc, or None."""
        if piece not in self.tokens:
            if len(self.tokens) > self.remember:
                self.tokens.clear()
            k = self.ids.get(piece)
            if k is not None and self.merges and self.leaf.encode(piece) != [k]:
                k = None
            self.tokens[piece] = float(self.scores[k]) if k is not None else self.unknown if len(piece) == 1 and piece not in self.ids else None
        return self.tokens[piece]

    def may_follow(self, left: str, right: str) -> bool:
        if not self.merges:
            return True
        if (left, right) not in self.follows:
            if len(self.follows) > self.remember:
                self.follows.clear()
            encode = self.leaf.encode
            self.follows[left, right] = encode(left + right) == encode(left) + encode(right)
        return self.follows[left, right]

    def decode(self, ids: np.ndarray) -> bytes:
        out = b"".join(map(self.bytes.__getitem__, ids.tolist()))
        return out[1:] if self.prefix and out[:1] == b" " else out


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


# ---------------------------------------------------------------- one chunk

def _walk(v: Vocabulary, text: str, seeds: dict[tuple[int, int] | None, np.ndarray], at: int, to: int):
    """Extend paths over the arcs that start in [at, to).  ``seeds``: last arc (start, end) -> weight by
    origin; None is a pinned point at ``at``.  Returns the last arcs that end at ``to`` or beyond with
    their weights, and each arc's best predecessor (of the first origin)."""
    ending: dict[int, dict[tuple[int, int] | None, np.ndarray]] = {}
    for arc, w in seeds.items():
        ending.setdefault(at if arc is None else arc[1], {})[arc] = w
    before: dict[tuple[int, int], tuple[int, int] | None] = {}
    for x in range(at, to):
        here = ending.pop(x, None)
        if not here:
            continue
        for y in range(x + 1, min(x + v.longest, len(text)) + 1):
            weight = v.token(text[x:y])
            if weight is None:
                continue
            best = None
            for arc, w in here.items():
                if arc is None or v.may_follow(text[arc[0]: arc[1]], text[x:y]):
                    if best is None or w[0] > best[0]:
                        before[x, y] = arc
                    best = w if best is None else np.maximum(best, w)
            if best is not None:
                ending.setdefault(y, {})[x, y] = best + weight
    return {arc: w for y, arcs in ending.items() if y >= to for arc, w in arcs.items()}, before


def _pins(v: Vocabulary, text: str, at: int, to: int) -> tuple[int, int] | None:
    """First and last point in [at, to] where a word starts."""
    if not v.by_word:
        return None
    first = _START.search(text, max(at, 1), min(to + 1, len(text)))  # lookbehind sees the character before
    if not first:
        return None
    last = first.start()
    for m in _START.finditer(text, last, min(to + 1, len(text))):
        last = m.start()
    return first.start(), last


def states_at(v: Vocabulary, text: str, at: int) -> list[tuple[int, int]]:
    """Pieces that start before ``at`` and reach it, as (code points before it, beyond it); one state
    where a word starts, since nothing spans that point."""
    if at == 0 or v.by_word and _START.match(text, at):
        return [START]
    return [(at - x, y - at) for x in range(max(0, at - v.longest), at) for y in range(at, min(x + v.longest, len(text)) + 1)
            if y > x and v.token(text[x:y]) is not None]


def transfer(v: Vocabulary, text: str, at: int, to: int, last: bool) -> Arcs:
    """The matrix of the chunk [at, to) of ``text``, whose margins reach one piece length further."""
    origins = states_at(v, text, at)
    one = [np.where(np.arange(len(origins)) == k, 0.0, NONE) for k in range(len(origins))]
    seeds = {None if s == START else (at - s[0], at + s[1]): w for s, w in zip(origins, one)}
    pins = _pins(v, text, at, to)
    if pins is None:
        ends, _ = _walk(v, text, seeds, at, to)
        total = {arc: w for arc, w in ends.items()}
    else:
        a, z = pins
        heads = seeds if a == at else _walk(v, text, seeds, at, a)[0]
        head = np.full(len(origins), NONE)
        for arc, w in heads.items():
            if arc is None or arc[1] == a:
                head = np.maximum(head, w)
        ids = np.frombuffer(v.encode_words(text[a:z]), "<i4")
        head = head + v.scores[ids].sum()
        total = _walk(v, text, {None: head}, z, to)[0] if z < to else {None: head}
    out: Arcs = {}
    for arc, w in total.items():
        if arc is None:  # a word starts at the cut
            arc = (to, to)
        if last and arc[1] != to:
            continue
        for s, x in zip(origins, w):
            if x > NONE:
                key = (_code(v, s), _code(v, (to - arc[0], arc[1] - to)))
                out[key] = max(out.get(key, NONE), float(x))
    return out


def _code(v: Vocabulary, state: tuple[int, int]) -> int:
    return state[0] * (v.longest + 1) + state[1]


def backtrace(v: Vocabulary, text: str, at: int, to: int, s: int, t: int) -> bytes:
    """Ids of the pieces that start in [at, to), given the states at both ends."""
    k = v.longest + 1
    enter, leave = divmod(s, k), divmod(t, k)
    seed: tuple[int, int] | None = None if enter == START else (at - enter[0], at + enter[1])
    goal = None if leave == START else (to - leave[0], to + leave[1])

    def path(seed, a: int, z: int, goal) -> bytes:
        ends, before = _walk(v, text, {seed: np.zeros(1)}, a, z)
        if goal is None:  # any arc that ends at the pinned point z, the heaviest
            goal = max((arc for arc in ends if arc is None or arc[1] == z), key=lambda arc: ends[arc][0])
        out = []
        while goal != seed and goal is not None:
            out.append(text[goal[0]: goal[1]])
            goal = before.get(goal)
        return b"".join(np.array(v.leaf.encode(p), "<i4").tobytes() for p in reversed(out))

    pins = _pins(v, text, at, to)
    if pins is None:
        return path(seed, at, to, goal)
    a, z = pins
    head = path(seed, at, a, None) if a > at else b""
    tail = path(None, z, to, goal) if z < to else b""
    return head + v.encode_words(text[a:z]) + tail


# ---------------------------------------------------------------- the scan

def times(a: Arcs, b: Arcs) -> Arcs:
    """Max-plus product."""
    by: dict[int, list[tuple[int, float]]] = {}
    for (s, t), w in b.items():
        by.setdefault(s, []).append((t, w))
    out: Arcs = {}
    for (s, m), w in a.items():
        for t, x in by.get(m, ()):
            out[s, t] = max(out.get((s, t), NONE), w + x)
    return out


def between(chain: list[Arcs], s: int, t: int | None) -> list[int]:
    """States at the inner and outer ends of a chain of matrices, from ``s`` to ``t`` (None: the best)."""
    forward = [{s: 0.0}]
    for m in chain:
        now: dict[int, float] = {}
        for (a, b), w in m.items():
            if a in forward[-1]:
                now[b] = max(now.get(b, NONE), forward[-1][a] + w)
        forward.append(now)
    if t is None:
        t = max(forward[-1], key=forward[-1].get)
    out = [t]
    for m, f in zip(reversed(chain), reversed(forward[:-1])):
        out.append(max((a for (a, b) in m if b == out[-1] and a in f), key=lambda a: f[a] + m[a, out[-1]]))
    return out[::-1]


def _matrices(pdf: pd.DataFrame) -> list[Arcs]:
    return [dict(zip(zip(r.m_in, r.m_out), r.m_w)) for r in pdf.itertuples()]


def _columns(m: Arcs) -> list:
    return [[k[0] for k in m], [k[1] for k in m], list(m.values())]


MATRIX = "m_in array<int>, m_out array<int>, m_w array<double>"


def chunk_states(chunks: DataFrame) -> DataFrame:
    """``row``, ``chunk``, ``s``, ``t``: the states at both ends of every chunk."""
    m = chunks.select("row", (F.col("chunk") / BLOCK).cast("int").alias("block"), "chunk", "m_in", "m_out", "m_w")

    def product(pdf: pd.DataFrame) -> pd.DataFrame:
        total, *rest = _matrices(pdf.sort_values("chunk"))
        for x in rest:
            total = times(total, x)
        return pd.DataFrame([[pdf.row.iloc[0], pdf.block.iloc[0], *_columns(total)]], columns=["row", "block", "m_in", "m_out", "m_w"])

    def over_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        states = between(_matrices(pdf), 0, None)
        return pd.DataFrame({"row": pdf.row, "block": pdf.block, "s": states[:-1], "t": states[1:]})

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        states = between(_matrices(pdf), int(pdf.s.iloc[0]), int(pdf.t.iloc[0]))
        return pd.DataFrame({"row": pdf.row, "chunk": pdf.chunk, "s": states[:-1], "t": states[1:]})

    blocks = m.groupBy("row", "block").applyInPandas(product, f"row long, block int, {MATRIX}")
    ends = blocks.groupBy("row").applyInPandas(over_blocks, "row long, block int, s int, t int")
    return m.join(ends, ["row", "block"]).groupBy("row", "block").applyInPandas(inside, "row long, chunk int, s int, t int")


# ---------------------------------------------------------------- documents

def _chunk_rows(docs: DataFrame, model: str, size: int) -> DataFrame:
    """Chunks of texts longer than one, each with its margins and its matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        row = TaskContext.get().partitionId() << 40
        for b in small_batches(batches):
            for doc, text, mark in zip(*(c.to_pylist() for c in b.columns)):
                row += 1
                text = v.normal(text)
                n = -(-len(text) // size)
                out = []
                for k in range(n):
                    a, z = k * size, min(len(text), (k + 1) * size)
                    lo = max(0, a - v.longest)
                    part = text[lo: z + v.longest]
                    m = transfer(v, part, a - lo, z - lo, k == n - 1)
                    out.append((row, doc, mark, n, k, a - lo, z - lo, part, *_columns(m)))
                    if len(out) == 64 or k == n - 1:
                        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out), kinds)], names)
                        out = []

    names = ["row", "doc_id", "mark", "n_chunks", "chunk", "at", "to", "part", "m_in", "m_out", "m_w"]
    kinds = [pa.int64()] * 3 + [pa.int32()] * 4 + [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.float64())]
    return docs.mapInArrow(run, f"row long, doc_id long, mark long, n_chunks int, chunk int, at int, to int, part string, {MATRIX}")


def _id_lists(ids: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))


def encode(docs: DataFrame, model: str = MODEL, size: int = CHUNK) -> DataFrame:
    """``doc_id``, ``mark`` (hash of the text), ``n_chunks`` and ``ids``, one row per input row.
    ``size`` must be at least the vocabulary's longest piece."""
    if not os.path.exists(model):
        raise FileNotFoundError(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("mark"))
    long = F.length("text") + 1 > size

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        for b in small_batches(batches):
            ids = [v.encode_words(v.normal(t or "")) for t in b.column(1).to_pylist()]
            n = pa.array([1 if t else 0 for t in ids], pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), n, _id_lists(ids)], ["doc_id", "mark", "n_chunks", "ids"])

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        for b in small_batches(batches):
            r = b.to_pydict()
            ids = [backtrace(v, *x) for x in zip(r["part"], r["at"], r["to"], r["s"], r["t"])]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(5)), _id_lists(ids)], ["row", "doc_id", "mark", "n_chunks", "chunk", "ids"])

    short = rows.where(F.coalesce(~long, F.lit(True))).mapInArrow(whole, "doc_id long, mark long, n_chunks int, ids array<int>")
    chunks = stage_table(_chunk_rows(rows.where(long), model, size), "piece_chunks")
    parts = (chunks.join(chunk_states(chunks), ["row", "chunk"])
             .select("row", "doc_id", "mark", "n_chunks", "chunk", "part", "at", "to", "s", "t")
             .mapInArrow(traced, "row long, doc_id long, mark long, n_chunks int, chunk int, ids array<int>"))
    joined = (parts.groupBy("row", "doc_id", "mark", "n_chunks").agg(F.array_sort(F.collect_list(F.struct("chunk", "ids"))).alias("x"))
              .select("doc_id", "mark", "n_chunks", F.flatten("x.ids").alias("ids")))
    return short.unionByName(joined)


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``encoded`` (any columns and ``ids``) with the decoded ``text`` in place of the ids."""
    at = encoded.columns.index("ids")
    kept = [c for c in encoded.columns if c != "ids"]
    schema = encoded.select(*kept, F.lit("").alias("text")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        for b in small_batches(batches):
            text = [v.decode(x.values.to_numpy(zero_copy_only=False)).decode("utf-8", "replace") for x in b.column(at)]
            yield pa.RecordBatch.from_arrays([*(c for k, c in enumerate(b.columns) if k != at), pa.array(text, pa.string())], [*kept, "text"])

    return encoded.mapInArrow(run, schema)


def op8_sentencepiece(spark: SparkSession, sf_dir: str, model: str = MODEL) -> DataFrame:
    """Per document: ``n_pieces``, ``ids_sha256`` (of the ids as 32-bit little-endian integers),
    ``n_chunks`` and ``round_trip`` (the decoded text has the text's hash)."""
    encoded = encode(read_table(spark, sf_dir, "documents"), model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        for b in small_batches(batches):
            ids = [x.values.to_numpy(zero_copy_only=False) for x in b.column(3)]
            marks = [xxhash.xxh64_intdigest(v.decode(x), 42) for x in ids]
            same = [m is None or not len(x) or h == m % (1 << 64) for m, h, x in zip(b.column(1).to_pylist(), marks, ids)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) for x in ids], pa.int64()),
                                              pa.array([hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in ids]), b.column(2), pa.array(same)],
                                             ["doc_id", "n_pieces", "ids_sha256", "n_chunks", "round_trip"])

    return encoded.mapInArrow(run, "doc_id long, n_pieces long, ids_sha256 string, n_chunks int, round_trip boolean")
