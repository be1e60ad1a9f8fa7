"""Merkle manifest of a dataset, its nodes labelled by nested intervals.

A row is a leaf: the SHA-256 (H, lower-case hex) of its columns, each ``-`` if null, else byte count,
colon, value.  Leaves of a group ascend by id (null first, then by leaf); while a level has several nodes,
each two consecutive ones become the H of their digests, the last one alone if their number is odd.  The
groups' last nodes, ordered by group (null first, bytewise), give the root in the same way.

* Labels: a node carries the interval ``lo..hi`` of leaf ranks that it covers.  Ranks come from a range
  partitioning, so a group that holds most rows is spread like any other.
* Levels are cut into bands of ``BAND``.  A band's bucket, the nodes below one node of the band's top level,
  is folded by one task; its size is bounded.  Bands go upwards, one job for each, and all nodes are written.
* Ancestors: nodes meet the band above them by the bucket that contains their interval.  Within a bucket the
  parent is the node whose interval contains the node's; the parent's interval less the node's own is
  the sibling's.  Paths go downwards: a bucket hands the siblings above it to what lies below, once.
* A proof is the list of siblings up to the root; folding a leaf with it gives the root again if and only if
  the leaf is the one that was summed.

Cases: any column may be null; a null id is a leaf without tampering; repeated rows are leaves each; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, stage_table
from .ranks import ranked

#: Levels of a band: a bucket has at most 2^BAND nodes of its lowest level.
BAND = 12
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
NODES = "g string, n long, level int, lo long, hi long, digest string"
PATHS = "g string, n long, lo long, path string"
PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*(_field(v) for v in values)), 256)


def group_key(group: Column) -> Column:
    """The group as a string without nulls that keeps the order: null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


# ---------------------------------------------------------------- nodes, upwards

def _height(n: int) -> int:
    """Levels above the leaves of a group of ``n``."""
    return (n - 1).bit_length()


def _fold(base: int):
    """All nodes above a bucket's nodes of level ``base``, up to the band's top or the group's."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("lo")
        g, n = table["g"][0].as_py(), table["n"][0].as_py()
        lo, hi, held = table["lo"].to_numpy(), table["hi"].to_numpy(), table["digest"].to_pylist()
        rows = []
        for level in range(base + 1, min(_height(n), base + BAND) + 1):
            held = [digest(*held[i: i + 2]) for i in range(0, len(held), 2)]
            lo, hi = lo[::2], np.append(hi[1::2], hi[-1:] if len(hi) % 2 else hi[:0])
            rows += zip([level] * len(held), lo.tolist(), hi.tolist(), held)
        level, lo, hi, held = zip(*rows) if rows else ([],) * 4
        k = len(rows)
        return pa.table({"g": pa.array([g] * k, pa.string()), "n": pa.array([n] * k, pa.int64()), "level": pa.array(level, pa.int32()),
                         "lo": pa.array(lo, pa.int64()), "hi": pa.array(hi, pa.int64()), "digest": pa.array(held, pa.string())})

    return run


def _bucket(base: int) -> Column:
    return F.shiftright("lo", base + BAND).alias("bucket")


def tree(leaves: DataFrame) -> list[DataFrame]:
    """``leaves``: ``g``, ``n``, ``rank``, ``digest``.  Per band, lowest first, the written table of its
    nodes above the band's lowest level: group, leaves of the group, level, interval, digest."""
    bands: list[DataFrame] = []
    largest = leaves.agg(F.max("n")).first()[0] or 0
    now = leaves.select("g", "n", F.col("rank").alias("lo"), F.col("rank").alias("hi"), "digest")
    for base in range(0, max(1, _height(largest)), BAND):
        made = now.where(F.col("n") > F.lit(1 << base)).groupBy("g", _bucket(base)).applyInArrow(_fold(base), NODES)
        bands.append(stage_table(made, "merkle_nodes"))
        now = bands[-1].where(F.col("level") == base + BAND).drop("level")
    return bands


def tops(leaves: DataFrame, bands: list[DataFrame]) -> DataFrame:
    """``g``, ``n`` and ``digest`` of each group's last node."""
    alone = leaves.where("n = 1").select("g", "n", "digest")
    for b in bands:  # the node that covers the whole group, at the group's height
        alone = alone.unionByName(b.where((F.col("lo") == 0) & (F.col("hi") == F.col("n") - 1)).select("g", "n", "digest", "level")
                                  .groupBy("g").agg(F.first("n").alias("n"), F.min_by("digest", "level").alias("digest")))
    return alone


# ---------------------------------------------------------------- siblings, downwards

def _siblings(items: pa.Table, nodes: pa.Table, base: int) -> list[list[str]]:
    """Per item (in order of ``lo``) its siblings within the bucket, upwards: ``L`` or ``R`` and the digest,
    or ``-`` for none."""
    lo, hi = items["lo"].to_numpy(), items["hi"].to_numpy()
    paths: list[list[str]] = [[] for _ in range(len(lo))]
    level_lo, held = lo, items["digest"].to_pylist()
    level = nodes["level"].to_numpy()
    for k in range(base + 1, int(level.max(initial=base)) + 1):
        here = nodes.filter(pa.array(level == k)).sort_by("lo")
        p_lo, p_hi = here["lo"].to_numpy(), here["hi"].to_numpy()
        parent = np.searchsorted(p_lo, lo, side="right") - 1  # the node whose interval contains the item's
        p_lo, p_hi = p_lo[parent], p_hi[parent]
        left, right = p_lo < lo, p_hi > hi  # what the parent covers besides the node itself
        at = np.searchsorted(level_lo, np.where(left, p_lo, hi + 1))
        for path, a, is_left, is_right in zip(paths, at.tolist(), left.tolist(), right.tolist()):
            path.append("L" + held[a] if is_left else "R" + held[a] if is_right else "-")
        lo, hi = p_lo, p_hi
        level_lo, held = here["lo"].to_numpy(), here["digest"].to_pylist()
    return paths


def _split(nodes: pa.Table) -> tuple[pa.Table, str]:
    """A bucket's nodes, and the path of the node above it (the row of level -1)."""
    level = nodes["level"].to_numpy()
    above = nodes.filter(pa.array(level < 0))
    return nodes.filter(pa.array(level >= 0)), above["digest"][0].as_py()


def _handed_down(base: int):
    def run(items: pa.Table, nodes: pa.Table) -> pa.Table:
        items = items.sort_by("lo")
        nodes, above = _split(nodes)
        paths = [" ".join([above.split("|")[0] + "|" + " ".join([*p, *above.split("|")[1].split()])]) for p in _siblings(items, nodes, base)]
        return pa.table({"g": items["g"], "n": items["n"], "lo": items["lo"], "path": pa.array(paths, pa.string())})

    return run


def _folded(start: str, path: list[str]) -> str:
    now = start.encode()
    for step in path:
        other = step[1:].encode()
        now = sha256(other + now if step[0] == "L" else now + other).hexdigest().encode()
    return now.decode()


def _proven(items: pa.Table, nodes: pa.Table) -> pa.Table:
    items = items.sort_by("lo")
    nodes, above = _split(nodes)
    head, rest = above.split("|")
    subroot, root = head.split()
    rest = rest.split()
    leaves, given = items["digest"].to_pylist(), items["given"].to_pylist()
    proofs, folded = [], []
    for path, start in zip(_siblings(items, nodes, 0), given):
        path += rest
        proofs.append(digest(*(x[1:] for x in path)))
        folded.append(_folded(start, path))
    n = len(leaves)
    return pa.table({"doc_id": items["doc_id"], "leaf": items["digest"], "subroot": pa.array([subroot] * n, pa.string()), "root": pa.array([root] * n, pa.string()),
                     "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array(folded, pa.string()), "verified": pa.array([f == root for f in folded])})


def _attached(items: DataFrame, bands: list[DataFrame], group_paths: DataFrame, run, schema: str) -> DataFrame:
    """Items (``g``, ``n``, ``lo``, ``hi``, ``digest``, level 0) with what ``run`` makes of their paths."""
    above = None
    for t in range(len(bands) - 1, -1, -1):
        base = t * BAND
        ends = group_paths.where((F.col("n") <= F.lit(1 << (base + BAND))) & ((F.col("n") > F.lit(1 << base)) | F.lit(t == 0)))
        here = ends if above is None else ends.unionByName(above)
        mine = items if t == 0 else bands[t - 1].where((F.col("level") == base) & (F.col("n") > F.lit(1 << base))).drop("level")
        rows = bands[t].select("g", _bucket(base), "level", "lo", "hi", "digest").unionByName(
            here.select("g", F.shiftright("lo", base + BAND).alias("bucket"), F.lit(-1).alias("level"), "lo", F.col("lo").alias("hi"), F.col("path").alias("digest")))
        met = mine.withColumn("bucket", _bucket(base)).groupBy("g", "bucket").cogroup(rows.groupBy("g", "bucket"))
        if t == 0:
            return met.applyInArrow(run, schema)
        above = stage_table(met.applyInArrow(_handed_down(base), PATHS), "merkle_paths")
    raise AssertionError("a tree has a band at least")


# ---------------------------------------------------------------- manifest

class Manifest:
    """A summed dataset: ``leaves`` (group, rank, digest, id), the nodes of the groups' trees and of the tree
    over the groups, all written tables; ``root`` is null for an empty dataset."""

    def __init__(self, docs: DataFrame, columns: list[str] = COLUMNS, group: str = "lang", key: str = "doc_id", given: Column | None = None):
        """``given``: another leaf to fold with the proof of each row's own (by default the same)."""
        own = leaf([F.col(c) for c in columns])
        rows = docs.select(group_key(F.col(group)).alias("g"), F.col(key).cast("long").alias("doc_id"), own.alias("digest"),
                           (own if given is None else given).alias("given"), F.monotonically_increasing_id().alias("row"))
        rows = stage_table(rows, "merkle_leaves")
        self.leaves = stage_table(ranked(rows, "g", ["doc_id", "digest", "row"], "merkle_slices").drop("row"), "merkle_ranked")
        self.bands = tree(self.leaves)
        self.subroots = stage_table(
            ranked(tops(self.leaves, self.bands).select(F.lit("").alias("all"), F.col("g").alias("of"), "digest", F.col("n").alias("of_n")), "all", ["of"], "merkle_groups")
            .withColumnRenamed("all", "g"), "merkle_subroots")
        self.top_bands = tree(self.subroots)
        found = tops(self.subroots, self.top_bands).first()
        self.root = found.digest if found else None

    def nodes(self) -> DataFrame:
        """Every node above the leaves of the groups: ``g``, ``level``, ``lo``, ``hi``, ``digest``."""
        out = self.bands[0]
        for b in self.bands[1:]:
            out = out.unionByName(b)
        return out.drop("n")

    def _group_paths(self) -> DataFrame:
        """Per group the path from its subroot to the root, headed by the two."""
        spark = self.leaves.sparkSession
        n = self.subroots.count()
        start = spark.createDataFrame([("", n, 0, "|")], PATHS)
        items = self.subroots.select("g", "n", F.col("rank").alias("lo"), F.col("rank").alias("hi"), "digest")
        paths = _attached(items, self.top_bands, start, _handed_down(0), PATHS)
        met = self.subroots.join(paths.select("lo", "path"), F.col("rank") == F.col("lo"))
        return stage_table(met.select(F.col("of").alias("g"), F.col("of_n").alias("n"), F.lit(0).cast("long").alias("lo"),
                                      F.concat("digest", F.lit(f" {self.root}"), "path").alias("path")), "merkle_group_paths")

    def proofs(self) -> DataFrame:
        """Per row its leaf, both roots, the digest of its proof, and what its given leaf folds to."""
        if self.root is None:
            return self.leaves.sparkSession.createDataFrame([], PROOFS)
        items = self.leaves.select("g", "n", F.col("rank").alias("lo"), F.col("rank").alias("hi"), "digest", "given", "doc_id")
        return _attached(items, self.bands, self._group_paths(), _proven, PROOFS)


def tampered(docs: DataFrame) -> Column:
    """The leaf of a row after tampering: where 7 divides the CRC-32 of its id, ``n_chars`` is one more."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    more = F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return leaf([more if c == "n_chars" else F.col(c) for c in COLUMNS])


def op12_merkle_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return Manifest(docs, given=tampered(docs)).proofs()


def _oracle() -> str:
    def fields(n_chars: str) -> str:
        def one(v: str) -> str:
            return f"coalesce(strlen(({v})::VARCHAR) || ':' || ({v})::VARCHAR, '-')"
        return "sha256(" + " || ".join(one(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + ")"

    step = "CASE WHEN b < 0 THEN xor(a >> 1, (a & 1) * 3988292384::BIGINT) ELSE xor(a, b) END"
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), "
           f"lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, b: {step}), 4294967295::BIGINT)")
    return f"""WITH RECURSIVE base AS (
        SELECT row_number() OVER () AS row, doc_id, lang, {fields("n_chars")} AS leaf,
               CASE WHEN doc_id IS NOT NULL AND {crc} % 7 = 0 THEN {fields("n_chars + 1")} ELSE {fields("n_chars")} END AS given FROM documents),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n FROM base),
    up(lang, level, idx, digest, n) AS (
        SELECT lang, 0, idx, leaf, n FROM ranked
        UNION ALL
        SELECT lang, level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (n + 1) // 2 FROM up WHERE n > 1 GROUP BY lang, level, idx // 2, n),
    subs AS (SELECT lang, level AS height, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM up WHERE n = 1),
    top(level, idx, digest, n) AS (
        SELECT 0, idx, subroot, n FROM subs
        UNION ALL
        SELECT level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY level, idx // 2, n),
    walk(row, lang, level, idx, now, proof) AS (
        SELECT row, lang, 0, idx, given, '' FROM ranked
        UNION ALL
        SELECT w.row, w.lang, w.level + 1, w.idx // 2,
               sha256(CASE WHEN w.idx % 2 = 1 THEN s.digest || w.now WHEN s.digest IS NULL THEN w.now ELSE w.now || s.digest END), w.proof || coalesce(s.digest, '')
        FROM walk w JOIN subs h ON w.lang IS NOT DISTINCT FROM h.lang AND w.level < h.height
             LEFT JOIN up s ON s.lang IS NOT DISTINCT FROM w.lang AND s.level = w.level AND s.idx = xor(w.idx, 1)),
    over_(row, level, idx, now, proof) AS (
        SELECT w.row, 0, h.idx, w.now, w.proof FROM walk w JOIN subs h ON w.lang IS NOT DISTINCT FROM h.lang AND w.level = h.height
        UNION ALL
        SELECT w.row, w.level + 1, w.idx // 2,
               sha256(CASE WHEN w.idx % 2 = 1 THEN s.digest || w.now WHEN s.digest IS NULL THEN w.now ELSE w.now || s.digest END), w.proof || coalesce(s.digest, '')
        FROM over_ w JOIN (SELECT max(level) AS height FROM top) h ON w.level < h.height
             LEFT JOIN top s ON s.level = w.level AND s.idx = xor(w.idx, 1))
    SELECT r.doc_id, r.leaf, h.subroot, t.digest AS root, sha256(o.proof) AS proof_sha256, o.now AS folded_root, o.now = t.digest AS verified
    FROM ranked r JOIN subs h ON r.lang IS NOT DISTINCT FROM h.lang JOIN over_ o ON o.row = r.row JOIN (SELECT max(level) AS height FROM top) m ON o.level = m.height
         CROSS JOIN (SELECT digest FROM top WHERE n = 1) t"""


ORACLE = _oracle()
