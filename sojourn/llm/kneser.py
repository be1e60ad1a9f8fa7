"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

The model is a trigram model of characters (A-Z folded, one end per text) for
each language, trained on trusted text: every document labelled good and not
toxic.  Nothing is sampled: counts, continuation counts, discounts by count of
counts, back-off weights and probabilities are DataFrame aggregates and joins
sharded by n-gram or context.  Labels meet the documents' ids, not their texts;
a block then counts its trusted documents from its file.

A document's perplexity needs the probability of each of its trigrams.  One pass
over the texts turns every block of a few megabytes into a file of the shared
folder (each document's trigrams and how often they occur) and into one row per
distinct trigram of the block; those rows join the probabilities, return to
their block, and give each document's sum.  A trigram of every text is one row a
block, however often it occurs.

A document is kept if its perplexity is at most its language's threshold: the
``QUANTILE`` of that language's trusted documents, from counts of all of them by
bins of the logarithm, times ``MARGIN``.

Cases: a null or empty text has one token, the end; a null language is a
language of its own; a language without trusted text has no perplexity and
keeps its documents, as does a table without labels; rows with a null or
repeated ``doc_id`` each give a row; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from . import arrays
from .common import read_table, small_batches, stage_table

QUANTILE = 0.999
MARGIN = 1.05
BINS = 1000  # of log10 perplexity, per unit
BITS = 21  # of a code point
START, END = (1 << BITS) - 1, (1 << BITS) - 2
_UPPER = {c: c + 32 for c in range(65, 91)}


def trigrams(text: str) -> np.ndarray:
    """Each token with the two before it, 21 bits each, in one long."""
    code = np.frombuffer(text.translate(_UPPER).encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    code = np.concatenate([[START, START], code, [END]])
    return code[:-2] << 2 * BITS | code[1:-1] << BITS | code[2:]


def trusted_ids(labels: DataFrame, bound: int | None = None) -> DataFrame:
    """The ids of all trusted documents, each once, or with ``bound`` the first of them in hash order."""
    toxic = F.coalesce("toxic", F.lit(0)) if "toxic" in labels.columns else F.lit(0)
    good = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max(toxic).alias("toxic")).where("quality > 0 and toxic <= 0")
    ids = good.select("doc_id")
    return ids if bound is None else ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


ROW_SCHEMA = "block long, k int, lang string, gram long, doc long, path string"


def block_rows(docs: DataFrame, folder: str) -> DataFrame:
    """``docs``: doc_id, lang, text.  A row per distinct (language, trigram) of a block, a row per document
    with an id (``k``: its place in the block), and a row with the block's file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for b in small_batches(batches):
            ids, langs, texts = (c.to_pylist() for c in b.columns)
            found = [np.unique(trigrams(t or ""), return_counts=True) for t in texts]
            size = np.array([len(g) for g, _ in found])
            times = np.concatenate([n for _, n in found])
            names = {x: k for k, x in enumerate(dict.fromkeys(langs))}
            lang = np.repeat([names[x] for x in langs], size)
            grams, number = np.concatenate([g for g, _ in found]), np.empty(len(times), np.uint32)
            lists, at = [], 0
            for k in range(len(names)):
                mine = np.flatnonzero(lang == k)
                distinct, inverse = np.unique(grams[mine], return_inverse=True)
                number[mine] = inverse + at
                at += len(distinct)
                lists.append(distinct)
            distinct, spelled = np.concatenate(lists), [x for x, d in zip(names, lists) for _ in range(len(d))]
            path = f"{folder}/{block:016x}-{uuid.uuid4().hex}"
            arrays.save(path, {
                "doc": np.array([i if i is not None else 0 for i in ids], np.int64), "null": np.array([i is None for i in ids]),
                "size": size, "lang": np.frombuffer(json.dumps(langs).encode(), np.uint8),
                "names": np.frombuffer(json.dumps(list(names)).encode(), np.uint8), "grams": distinct, "held": np.array([len(d) for d in lists]),
                "number": number, "times": times.astype(np.uint32)}, compress=True)
            known = [k for k, i in enumerate(ids) if i is not None]
            more = len(known) + 1
            columns = [np.full(at + more, block), np.concatenate([np.arange(at), np.array([*known, -1])]), pa.array([*spelled, *[None] * more], pa.string()),
                       np.append(distinct, np.full(more, -1)), pa.array([*[None] * at, *(ids[k] for k in known), None], pa.int64()),
                       pa.array([None] * (at + more - 1) + [path], pa.string())]
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, kinds)], [f.split()[0] for f in ROW_SCHEMA.split(", ")])
            block += 1

    return stage_table(docs.mapInArrow(run, ROW_SCHEMA), "kneser_blocks")


def trusted_places(rows: DataFrame, good: DataFrame) -> DataFrame:
    """``block`` and ``k`` of every trusted document; ``good`` is a written table of different ids."""
    ids = rows.where("doc is not null").select("block", "k", F.col("doc").alias("doc_id"))
    return stage_table(ids.join(good, "doc_id").select("block", "k"), "kneser_places")


def trusted_counts(rows: DataFrame, places: DataFrame) -> DataFrame:
    """``lang``, ``gram`` and ``n``, the count in a block's trusted documents."""
    files = rows.where("path is not null").select("block", "k", "path")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        path, good = pdf["path"].dropna().iloc[0], pdf["k"].to_numpy()
        size, names, grams, held, number, times = arrays.load(path, ["size", "names", "grams", "held", "number", "times"])
        trusted = np.zeros(len(size), bool)
        trusted[good[good >= 0]] = True
        n = np.bincount(number, weights=times * np.repeat(trusted, size), minlength=len(grams)).astype(np.int64)
        lang = np.repeat(np.array(json.loads(names.tobytes()), object), held)
        return pd.DataFrame({"lang": lang, "gram": grams, "n": n})[n > 0]

    return files.unionByName(places.withColumn("path", F.lit(None).cast("string"))).groupBy("block").applyInPandas(run, "lang string, gram long, n long")


def level(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``counts``: lang, gram, context, n.  Returns lang, gram, alpha (discounted relative count) and
    lang, context, gamma (what the discounts leave for the lower order)."""
    kinds = counts.groupBy("lang").agg(*(F.sum((F.col("n") == k).cast("double")).alias(f"n{k}") for k in (1, 2, 3, 4)))
    y = F.when(F.col("n1") + F.col("n2") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)

    def d(k: int) -> Column:  # k - (k + 1) Y n(k+1) / n(k), within [0, k]; half of k where there are none to estimate from
        raw = F.when(F.col(f"n{k}") > 0, k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")).otherwise(k / 2)
        return F.least(F.lit(float(k)), F.greatest(F.lit(0.1), raw)).alias(f"d{k}")

    discounts = kinds.select("lang", d(1), d(2), d(3))
    n = F.col("n")
    totals = counts.groupBy("lang", "context").agg(
        F.sum("n").alias("total"), F.sum((n == 1).cast("long")).alias("k1"), F.sum((n == 2).cast("long")).alias("k2"), F.sum((n > 2).cast("long")).alias("k3"))
    totals = totals.join(discounts, "lang")
    gamma = totals.select("lang", "context", ((F.col("d1") * F.col("k1") + F.col("d2") * F.col("k2") + F.col("d3") * F.col("k3")) / F.col("total")).alias("gamma"))
    less = F.when(n == 1, F.col("d1")).when(n == 2, F.col("d2")).otherwise(F.col("d3"))
    alpha = counts.join(totals, ["lang", "context"]).select("lang", "gram", ((n - less) / F.col("total")).alias("alpha"))
    return alpha, gamma


def probabilities(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """``lang``, ``gram`` and ``log`` (log10 of its probability) for every trigram of ``grams``, from the
    ``counts`` in trusted text; ``lang`` is never null here (the caller spells a missing one)."""
    low = (1 << BITS) - 1
    seen = grams.select("lang", "gram", F.lit(0).cast("long").alias("n")).unionByName(counts).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    seen = stage_table(seen, "kneser_counts")
    three = seen.where("n > 0").select("lang", "gram", F.shiftright("gram", BITS).alias("context"), "n")
    pair = F.col("gram").bitwiseAND((1 << 2 * BITS) - 1)
    two = three.groupBy("lang", pair.alias("gram")).agg(F.count("*").alias("n")).withColumn("context", F.shiftright("gram", BITS))
    one = two.groupBy("lang", F.col("gram").bitwiseAND(low).alias("gram")).agg(F.count("*").alias("n")).withColumn("context", F.lit(0).cast("long"))
    (a3, g3), (a2, g2), (a1, g1) = level(three), level(two), level(one)
    size = one.groupBy("lang").agg((F.count("*") + 1).alias("v"))
    base = g1.join(size, "lang").select("lang", (F.col("gamma") / F.col("v")).alias("rest"))
    q = seen.select("lang", "gram", F.shiftright("gram", BITS).alias("_ab"), pair.alias("_bc"), F.shiftright(pair, BITS).alias("_b"), F.col("gram").bitwiseAND(low).alias("_c"))

    def met(q: DataFrame, part: DataFrame, key: str, by: str, value: str) -> DataFrame:
        return q.join(part.select("lang", F.col(key).alias(by), F.col(part.columns[-1]).alias(value)), ["lang", by], "left")

    q = met(met(met(met(met(q, a3, "gram", "gram", "a3"), g3, "context", "_ab", "g3"), a2, "gram", "_bc", "a2"), g2, "context", "_b", "g2"), a1, "gram", "_c", "a1")
    q = q.join(base, "lang", "left")
    zero, one_ = F.lit(0.0), F.lit(1.0)
    p1 = F.coalesce("a1", zero) + F.col("rest")
    p2 = F.coalesce("a2", zero) + F.coalesce("g2", one_) * p1
    p3 = F.coalesce("a3", zero) + F.coalesce("g3", one_) * p2
    return q.select("lang", "gram", F.log10(p3).alias("log"))


SCORE_SCHEMA = "doc_id long, lang string, trusted boolean, n_tokens long, log10_prob double"


def scores(rows: DataFrame, table: DataFrame, places: DataFrame) -> DataFrame:
    """Per document ``n_tokens`` and ``log10_prob`` (null without a model of its language)."""
    none = {"log": F.lit(None).cast("double"), "path": F.lit(None).cast("string"), "good": F.lit(False)}
    met = rows.where("gram >= 0").select("block", "k", "lang", "gram").join(table, ["lang", "gram"]).select("block", "k", "log", none["path"].alias("path"), none["good"].alias("good"))
    files = rows.where("path is not null").select("block", "k", none["log"].alias("log"), "path", none["good"].alias("good"))
    marks = places.select("block", "k", none["log"].alias("log"), none["path"].alias("path"), F.lit(True).alias("good"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        path = pdf["path"].dropna().iloc[0]
        mark = pdf["good"].to_numpy(bool)
        part = pdf[(pdf["k"] >= 0).to_numpy() & ~mark]
        log = np.full(len(part), np.nan)
        log[part["k"].to_numpy()] = part["log"].to_numpy(np.float64)
        doc, null, size, lang, number, times = arrays.load(path, ["doc", "null", "size", "lang", "number", "times"])
        good = np.zeros(len(doc), bool)
        good[pdf["k"].to_numpy()[mark]] = True
        first = np.cumsum(size) - size
        total = np.add.reduceat(log[number] * times, first)
        return pd.DataFrame({"doc_id": pd.arrays.IntegerArray(doc.copy(), null.copy()), "lang": json.loads(lang.tobytes()), "trusted": good,
                             "n_tokens": np.add.reduceat(times.astype(np.int64), first), "log10_prob": pd.array(total, "Float64")})

    out = met.unionByName(files).unionByName(marks).groupBy("block").applyInPandas(run, SCORE_SCHEMA)
    return out.withColumn("log10_prob", F.when(~F.isnan("log10_prob"), F.col("log10_prob")))


def thresholds(scored: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN) -> DataFrame:
    """``lang`` and ``threshold``, from all trusted documents of a language."""
    bins = (scored.where("trusted and log10_prob is not null")
            .groupBy("lang", F.ceil(-F.col("log10_prob") / F.col("n_tokens") * BINS).alias("bin")).agg(F.count("*").alias("n")))
    w = Window.partitionBy("lang")
    below = F.sum("n").over(w.orderBy("bin"))
    return (bins.withColumn("below", below).withColumn("all", F.sum("n").over(w)).where(F.col("below") >= quantile * F.col("all"))
            .groupBy("lang").agg((F.pow(F.lit(10.0), F.min("bin") / BINS) * margin).alias("threshold")))


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN) -> DataFrame:
    """``doc_id``, ``lang``, ``n_tokens``, ``log10_prob``, ``perplexity``, ``threshold``, ``kept``; one row per input row."""
    missing = "\x00"  # spells a null language in keys
    good = stage_table(trusted_ids(labels).select(F.col("doc_id").cast("long")), "kneser_trusted")
    spelled = docs.select(F.col("doc_id").cast("long"), F.coalesce("lang", F.lit(missing)).alias("lang"), "text")
    rows = block_rows(spelled, shared_dir(docs.sparkSession, "llm", "kneser"))
    places = trusted_places(rows, good)
    table = probabilities(rows.where("gram >= 0"), trusted_counts(rows, places))
    scored = stage_table(scores(rows, table, places), "kneser_scores")
    limit = thresholds(scored, quantile, margin)
    perplexity = F.pow(F.lit(10.0), -F.col("log10_prob") / F.col("n_tokens"))
    return scored.join(limit, "lang", "left").select(
        "doc_id", F.when(F.col("lang") != missing, F.col("lang")).alias("lang"), "n_tokens", "log10_prob", perplexity.alias("perplexity"), "threshold",
        F.coalesce(perplexity <= F.col("threshold"), F.lit(True)).alias("kept"))


def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
