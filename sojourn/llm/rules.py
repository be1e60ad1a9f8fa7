"""Quality rules by an isolation forest over rule statistics.

Words are ``[^\\x20\\x09-\\x0D]+``.  Per document: ``n_words``, ``word_chars``
(code points in words), ``n_symbols`` (characters of ``#*$%&|<>``),
``n_dup_lines`` (lines with a word that equal an earlier line) and
``n_repeat_words`` (words inside 8-word windows that occur twice or more in the
text).  The base rule fails a document of under 20 words or with over 30 % of
its words repeated.  The method's verdict is the isolation forest's: short
mean path lengths over random splits of the statistics mark an anomaly, and
the score from which a document is rejected is calibrated on all labelled rows.

Cases: a null text is a text without words (it fails the base rule); null or
repeated ``doc_id`` values give one result row per input row; without any
labelled row the forest is not fitted and the base rule alone decides; extra
columns are ignored.  Every size runs the same code: the only sample is the
forest's training sample, whose bound is ``trees * sample`` labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, small_batches, stage_table, text_bytes

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
#: Share of good labelled rows that the calibrated threshold may reject.
MAX_GOOD_LOST = 0.001
SCORE_BINS = 10_000

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
STATS_SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in STATS)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by windows that occur at least twice; exact ranks by doubling, no hashing."""
    n = len(words)
    if n <= window:
        return 0
    seen: dict[bytes, int] = {}
    ranks = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    length = 1
    while length < window:
        step = min(length, window - length)
        pairs = ranks[: len(ranks) - step] * (int(ranks.max()) + 1) + ranks[step:]
        ranks = np.unique(pairs, return_inverse=True)[1]
        length += step
    twice = np.bincount(ranks)[ranks] > 1
    if not twice.any():
        return 0
    edge = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_stats(text: bytes) -> tuple[int, int, int, int, int]:
    words = text.split()  # bytes.split() cuts at exactly the six ASCII white-space characters
    if not words:
        return 0, 0, sum(map(text.count, _BYTES)), 0, 0
    joined = b"".join(words)
    chars = len(joined.decode("utf-8", "replace"))
    seen: set[bytes] = set()
    dup = 0
    for line in text.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.strip(SPACES):
            seen.add(line)
    return len(words), chars, sum(map(joined.count, _BYTES)), dup, repeated_words(words)


_BYTES = [bytes([b]) for b in SYMBOLS]


def _stats_arrays(texts: pa.Array) -> np.ndarray:
    return np.array([text_stats(t) for t in text_bytes(texts)], np.int64).reshape(-1, len(STATS))


def rule_stats(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id`` and the five statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            s = _stats_arrays(b.column(1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), *(pa.array(s[:, k]) for k in range(len(STATS)))], ["doc_id", *STATS])

    return docs.select("doc_id", "text").mapInArrow(run, STATS_SCHEMA)


def base_failed(s: np.ndarray) -> np.ndarray:
    return (s[:, 0] < MIN_WORDS) | (100 * s[:, 4] > MAX_REPEAT_PERCENT * s[:, 0])


def features(s: np.ndarray) -> np.ndarray:
    """Ratios that do not depend on a text's length: symbols a word, and in coarse steps (small
    differences between good texts then give no splits) the mean word length in code points and the
    share of repeated lines in tenths, a line counted as eight words.  Repeated words have the base rule."""
    n = np.maximum(s[:, 0], 1).astype(np.float64)
    return np.column_stack([s[:, 2] / n, np.rint(s[:, 1] / n), np.floor(80 * s[:, 3] / n)])


@dataclass
class Forest:
    """Trees as flat arrays: feature (-1: leaf), split value, left child; ``depth`` at leaves includes
    the expected depth of what a leaf still holds."""

    feature: np.ndarray
    split: np.ndarray
    child: np.ndarray
    depth: np.ndarray
    norm: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1]: 2 ** (- mean path length / expected path length)."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t in range(self.feature.shape[0]):
            node = np.zeros(len(x), np.int64)
            live = rows
            while len(live):
                f = self.feature[t, node[live]]
                live = live[f >= 0]
                if not len(live):
                    break
                at = node[live]
                right = x[live, self.feature[t, at]] >= self.split[t, at]
                node[live] = self.child[t, at] + right
            total += self.depth[t, node]
        return np.exp2(-total / (self.feature.shape[0] * self.norm))


def _expected(n: float) -> float:
    """Mean path length of an unsuccessful search in a random tree of n rows."""
    return 0.0 if n <= 1 else 2.0 * (np.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n if n > 2 else 1.0


def fit_forest(x: np.ndarray, trees: int, sample: int, seed: int) -> Forest:
    rng = np.random.default_rng(seed)
    sample = min(sample, len(x))
    limit = int(np.ceil(np.log2(max(sample, 2))))
    size = 2 ** (limit + 1)
    feature, split = np.full((trees, size), -1, np.int64), np.zeros((trees, size))
    child, depth = np.zeros((trees, size), np.int64), np.zeros((trees, size))
    for t in range(trees):
        rows = x[rng.choice(len(x), sample, replace=False)]
        free, todo = 1, [(0, rows, 0)]
        while todo:
            node, part, d = todo.pop()
            low, high = part.min(0), part.max(0)
            wide = np.flatnonzero(high > low)
            if d >= limit or len(part) <= 1 or not len(wide):
                depth[t, node] = d + _expected(len(part))
                continue
            f = rng.choice(wide)
            cut = rng.uniform(low[f], high[f])
            right = part[:, f] >= cut
            feature[t, node], split[t, node], child[t, node] = f, cut, free
            todo += [(free, part[~right], d + 1), (free + 1, part[right], d + 1)]
            free += 2
    return Forest(feature, split, child, depth, max(_expected(sample), 1e-9))


@dataclass
class Model:
    forest: Forest | None
    threshold: float

    def kept(self, s: np.ndarray) -> np.ndarray:
        ok = ~base_failed(s)
        if self.forest is not None and ok.any():
            ok[ok] = self.forest.score(features(s[ok])) < self.threshold
        return ok


def calibrate(bins: list[tuple[int, int, int]], max_lost: float = MAX_GOOD_LOST) -> float:
    """``bins``: (score bin, good rows, bad rows).  The lowest threshold that rejects at most
    ``max_lost`` of the good rows, moved up to the middle of the empty gap above the good rows it keeps."""
    good = sum(b[1] for b in bins)
    allowed, lost, at = max_lost * good, 0, SCORE_BINS + 1
    above = SCORE_BINS + 1
    for b, g, bad in sorted(bins, reverse=True):
        if lost + g > allowed:
            at = b
            break
        lost += g
        if g or bad:
            above = b
    else:  # no good rows to lose: without labels nothing is rejected, else the lowest score seen is the bound
        return above / SCORE_BINS if bins else 2.0
    return (at + 1 + max(above, at + 1)) / 2 / SCORE_BINS


def fit(stats: DataFrame, labels: DataFrame, trees: int = 200, sample: int = 128, seed: int = 7) -> Model:
    """Fit on a bounded sample of labelled rows (``trees * sample`` rows in hash order: a distributed
    top-k), then calibrate the threshold on every labelled row that the base rule keeps."""
    flags = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = stage_table(stats.join(flags, "doc_id").select("quality", "doc_id", *STATS), "rule_labelled")
    picked = rows.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id", *STATS).limit(trees * sample).select(*STATS).collect()
    s = np.array(picked, np.int64).reshape(-1, len(STATS))
    s = s[~base_failed(s)] if len(s) else s
    if len(s) < 2:
        return Model(None, 2.0)
    forest = fit_forest(features(s), trees, sample, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.column_stack([b.column(k + 1).to_numpy() for k in range(len(STATS))])
            ok = ~base_failed(x)
            score = (forest.score(features(x[ok])) * SCORE_BINS).astype(np.int64)
            q = b.column(0).to_numpy()[ok]
            yield pa.RecordBatch.from_arrays([pa.array(score), pa.array((q > 0).astype(np.int64)), pa.array((q <= 0).astype(np.int64))],
                                             ["bin", "good", "bad"])

    bins = (rows.select("quality", *STATS).mapInArrow(run, "bin long, good long, bad long")
            .groupBy("bin").agg(F.sum("good"), F.sum("bad")).collect())  # at most SCORE_BINS + 1 rows
    return Model(forest, calibrate([tuple(r) for r in bins]))


def judge(stats: DataFrame, model: Model) -> DataFrame:
    """``stats`` with ``base_failed`` and ``kept``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.column_stack([b.column(k + 1).to_numpy() for k in range(len(STATS))])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(base_failed(s)), pa.array(model.kept(s))],
                                             ["doc_id", *STATS, "base_failed", "kept"])

    return stats.select("doc_id", *STATS).mapInArrow(run, STATS_SCHEMA + ", base_failed boolean, kept boolean")


def quality_rules(docs: DataFrame, labels: DataFrame, **fit_args) -> DataFrame:
    """One row per document: the statistics, ``base_failed`` and ``kept``."""
    stats = stage_table(rule_stats(docs), "rule_stats")
    return judge(stats, fit(stats, labels, **fit_args))


def keep_good(docs: DataFrame, labels: DataFrame, **fit_args) -> DataFrame:
    """The documents that the rules keep, with all their columns.  The verdict is computed where the
    row lies, so no text is shuffled; only the statistics of labelled rows meet the labels."""
    model = fit(rule_stats(docs), labels, **fit_args)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            yield b.filter(pa.array(model.kept(_stats_arrays(b.column(at)))))

    return docs.mapInArrow(run, docs.schema)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
