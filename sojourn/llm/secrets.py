"""Secret scans with an incremental blob ledger; DataFrame functions only.

Every version of every path is addressed by its content (SHA-256).  The ledger
holds, for each blob, the rule versions that have scanned it and what they
found; a run scans only pairs of blob and rule version that the ledger lacks,
once for all copies, and findings are joined back to every path of a blob.
Copies are folded by a partial aggregate before the shuffle, so a content that
fills a third of the table costs each task one row.

A span is a whole match, in code points, end exclusive: leftmost matches that
do not overlap within a rule.  ``split`` gives the pieces between matches and
``regexp_extract_all`` the matches, so starts are running sums of lengths.
The base kinds are ``assign``, ``access`` and ``hex``; the ledger's own rules
add key headers, vendor tokens, JSON web tokens and passwords in addresses.
``redact`` masks by ``MASKED``, whose newer key rule takes the whole key.

Cases: null text is empty text; rows with null or repeated ``doc_id`` each give
a row; a text that consists of a secret, an empty table and an empty ledger are
ordinary; other columns are ignored, and kept by ``redact``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table, stage_table


@dataclass(frozen=True)
class Rule:
    """``value``: the group of the pattern that must have ``least`` characters (0: the match)."""

    kind: str
    pattern: str
    version: int = 1
    value: int = 0
    least: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# For access and hex a maximal run that is too short contains no longer one, so the length can stand in
# the pattern; a short assignment still takes its place in the text and is dropped afterwards.
BASE = [
    Rule("assign", r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", value=2, least=8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
]
RULES = BASE + [
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_password", r"://[^/\x00-\x20:@]{1,128}:[^/\x00-\x20:@]{1,128}@"),
]
# A key from its BEGIN line to its END line; if five dashes or the text's end come first, to the end of its base64
# lines, after header lines if any: runs of 16 characters or more, then at most one shorter line.  Line ends may be
# spelled (backslash, n), lines indented, quoted or joined by blanks.  All loops are possessive: linear, and no recursion in Java.
_EOL, _RUN = r"(?:\r?\n|(?:\\r)?\\n)", "[A-Za-z0-9+/]"
_BODY = (rf"(?:{_EOL}[\x20\t>]*+[A-Za-z]++-[A-Za-z]++:[^\n\\]*+)*+"
         rf"(?:(?:\\[nrt]|[\s>\"'+,;])*+{_RUN}{{16,}}+={{0,2}}+)*+"
         rf"(?:[\x20\t\"'+,;]*+{_EOL}[\x20\t>\"']*+{_RUN}++={{0,2}}+(?=[\x20\t\"'+,;]*+(?:[\r\n\\]|\z)))?+")
PRIVATE_KEY = Rule("private_key", rf"-----BEGIN [A-Z ]{{0,40}}PRIVATE KEY-----(?:(?:[^-]++|-(?!----))*+-----END [A-Z ]{{0,40}}PRIVATE KEY-----|{_BODY})", version=2)
#: What ``redact`` masks; RULES are those of op9 and its SQL.
MASKED = [PRIVATE_KEY if r.kind == "private_key" else r for r in RULES]
#: Code points of a block that is masked as one.
BLOCK = 4096
LEDGER_SCHEMA = "blob string, rules array<string>, found array<struct<start:int,kind:int,end:int>>"


def blob_id(content: Column) -> Column:
    return F.coalesce(F.sha2(F.coalesce(content, F.lit("")), 256), F.lit(""))  # never null, and Spark can tell


def _passes(match: Column, rule: Rule) -> Column:
    if rule.least <= 1:
        return F.lit(True)
    return F.length(F.regexp_extract(match, rule.pattern, rule.value) if rule.value else match) >= rule.least


def _parts(content: Column, rule: Rule) -> Column:
    """Per match: length of the piece before it, its own length, and whether it counts."""
    pieces = F.split(content, rule.pattern, -1)
    matches = F.regexp_extract_all(content, F.lit(rule.pattern), F.lit(0))
    pairs = F.zip_with(pieces, matches, lambda p, m: F.struct(
        F.length(p).alias("skip"), F.length(m).alias("len"), _passes(m, rule).alias("ok")))
    return F.filter(pairs, lambda x: x["len"].isNotNull())


def blobs(versions: DataFrame) -> DataFrame:
    """``versions`` has ``content``; one row for each different content."""
    text = F.coalesce("content", F.lit(""))
    return versions.select(text.alias("content")).groupBy(blob_id(F.col("content")).alias("blob")).agg(F.first("content").alias("content"))


def scan(found_blobs: DataFrame, ledger: DataFrame | None = None, rules: list[Rule] = RULES) -> DataFrame:
    """New ledger rows: a row for each blob that some rule version has not scanned yet."""
    names = F.array(*(F.lit(r.name) for r in rules))
    if ledger is None:
        due = found_blobs.withColumn("due", names)
    else:
        seen = ledger.select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        due = (found_blobs.join(seen, "blob", "left")
               .withColumn("due", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>"))))
               .where(F.size("due") > 0))
    return (_spans(due, rules).withColumn("span", F.when(F.col("start").isNotNull(), F.struct("start", "kind", "end")))
            .groupBy("blob").agg(F.first("due").alias("rules"), F.array_sort(F.collect_list("span")).alias("found")))


def _spans(due: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per blob and finding ``due``, ``kind``, ``start``, ``end``; a blob without any has a row of nulls."""
    hits = F.array(*(
        F.when(F.array_contains("due", r.name) & F.col("content").rlike(r.pattern),
               F.struct(F.lit(k).alias("kind"), _parts(F.col("content"), r).alias("parts")))
        for k, r in enumerate(rules)))
    rows = (due.select("blob", "due", F.explode_outer(F.filter(hits, lambda h: h.isNotNull())).alias("h"))
            .select("blob", "due", F.col("h.kind").alias("kind"), F.posexplode_outer("h.parts").alias("at", "part")))
    w = Window.partitionBy("blob", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    ends = rows.withColumn("end", F.sum(F.col("part.skip") + F.col("part.len")).over(w).cast("int"))
    return ends.select("blob", "due", "kind", F.when(F.col("part.ok"), F.col("end") - F.col("part.len")).alias("start"), "end")


def merged(ledger: DataFrame) -> DataFrame:
    """``blob`` and all its findings, over the ledger's runs, by start and kind."""
    return ledger.groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))).alias("found"))


def scan_versions(versions: DataFrame, ledger: DataFrame | None = None, rules: list[Rule] = RULES) -> tuple[DataFrame, DataFrame]:
    """``versions``: any columns (path, commit, ...) and ``content``.  Returns the new ledger rows, written,
    and the versions (without their content) with ``blob`` and ``found``."""
    new = stage_table(scan(blobs(versions), ledger, rules), "ledger")
    known = new.select("blob", "found") if ledger is None else stage_table(merged(ledger.unionByName(new)), "ledger_merged")
    paths = versions.withColumn("blob", blob_id(F.col("content"))).drop("content")
    return new, paths.join(known, "blob")


def _cuts(spans: DataFrame) -> DataFrame:
    """Per blob with findings ``cuts``: for each block of ``BLOCK`` code points, up to the last with a
    finding, what to cut from it (from, to, and the kind where a finding begins).

    Findings that overlap or touch are one, named by the first: in order of start, the running maximum of
    the ends before a span tells whether it opens a new one."""
    order = Window.partitionBy("blob").orderBy("start", "kind")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = spans.where("start is not null").select("blob", "kind", "start", "end", (F.coalesce(before, F.lit(-1)) < F.col("start")).alias("opens"))
    number = F.sum(F.col("opens").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    one = (opens.select("*", number.alias("no")).groupBy("blob", "no")
           .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max(F.when(F.col("opens"), F.col("kind"))).alias("kind")))
    last = F.floor((F.col("end") - 1) / BLOCK).cast("int")
    seen = F.coalesce(F.lag(last).over(Window.partitionBy("blob").orderBy("start")), F.lit(-1))
    first = F.floor(F.col("start") / BLOCK).cast("int")
    one = one.select("blob", "kind", "start", "end", first.alias("first"), last.alias("last"), seen.alias("seen"))
    rows = one.select("blob", "kind", "start", "end", "first", F.explode(F.sequence(F.least("first", F.col("seen") + 1), "last")).alias("block"))
    at = F.col("block") * BLOCK
    cut = F.when(F.col("block") >= F.col("first"), F.struct(
        F.greatest(F.col("start") - at, F.lit(0)).alias("from"), F.least(F.col("end") - at, F.lit(BLOCK)).alias("to"),
        F.when(F.col("block") == F.col("first"), F.col("kind")).alias("kind")))  # blocks between two findings have no cut
    each = rows.groupBy("blob", "block").agg(F.array_sort(F.collect_list(cut)).alias("cut"))
    return each.groupBy("blob").agg(F.transform(F.array_sort(F.collect_list(F.struct("block", "cut"))), lambda x: x["cut"]).alias("cuts"))


def _masked(content: Column, cuts: Column, rules: list[Rule]) -> Column:
    """The text with every finding replaced by its kind in brackets, block by block: each block is cut by
    positions within it, so the work grows with the text and its findings, not with their product."""
    marks = F.array(*(F.lit(f"[{r.kind}]") for r in rules))

    def without(block: Column, cut: Column) -> Column:
        kept = F.transform(cut, lambda s, i: F.concat(
            F.substring(block, F.when(i == 0, F.lit(0)).otherwise(F.get(cut, i - 1)["to"]) + 1,
                        s["from"] - F.when(i == 0, F.lit(0)).otherwise(F.get(cut, i - 1)["to"])),
            F.coalesce(F.get(marks, s["kind"]), F.lit(""))))
        return F.concat(F.array_join(kept, ""), F.substring(block, F.element_at(cut, -1)["to"] + 1, F.lit(BLOCK)))

    blocks = F.regexp_extract_all(content, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    parts = F.transform(blocks, lambda t, i: F.when(F.size(F.get(cuts, i)) > 0, without(t, F.get(cuts, i))).otherwise(t))
    return F.when(cuts.isNotNull(), F.array_join(parts, "")).otherwise(content)


def redact(docs: DataFrame, rules: list[Rule] = MASKED) -> DataFrame:
    """``docs`` with every finding masked in ``text``; null stays null, ``n_chars`` follows a changed text.
    Texts are shuffled once, as blobs: findings and masked texts stay with their blob, and documents meet it
    by its address."""
    content = blobs(docs.select(F.col("text").alias("content")))
    due = content.withColumn("due", F.array(*(F.lit(r.name) for r in rules)))
    found = _cuts(_spans(due, rules)).withColumnRenamed("blob", "__of")
    clean = (content.join(found, F.col("blob") == F.col("__of"), "left")
             .select(F.col("blob").alias("__blob"), F.col("cuts").isNotNull().alias("__hit"), _masked(F.col("content"), F.col("cuts"), rules).alias("__text")))
    text = F.when(F.col("__null"), F.lit(None)).otherwise(F.col("__text"))
    out = {c: F.col(c) for c in docs.columns} | {"text": text.alias("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(F.col("__hit"), F.length("__text").cast(kind)).otherwise(F.col("n_chars")).alias("n_chars")
    rows = docs.select(*(c for c in docs.columns if c != "text"), F.col("text").isNull().alias("__null"), blob_id(F.col("text")).alias("__blob"))
    return rows.join(clean, "__blob").select(*(out[c] for c in docs.columns))


def _listed(found: Column, rules: list[Rule]) -> Column:
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(kind: int) -> Column:
    return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")


def op9_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))
    paths = docs.select("doc_id", blob_id(F.col("content")).alias("blob"))
    new = stage_table(scan(blobs(docs)), "ledger")
    base = F.filter("found", lambda s: s["kind"] < len(BASE))
    per_blob = new.select(  # a plain table: Spark can split the rows of a frequent blob in the join
        "blob", *(_count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE)),
        F.sha2(_listed(base, RULES), 256).alias("base_sha256"), _listed(F.col("found"), RULES).alias("spans"))
    return paths.join(per_blob, "blob").drop("blob")


def _oracle() -> str:
    """The same result in DuckDB: pieces and matches of each rule, starts as sums of lengths."""
    def part(k: int, r: Rule) -> str:
        p = r.pattern.replace("((?i)password|passwd|secret|token|api_?key)", "((?i:password|passwd|secret|token|api_?key))").replace("'", "''")
        ok = f"length(regexp_extract(m[i], '{p}', {r.value})) >= {r.least}" if r.least > 1 else "true"
        return f"""SELECT row, {k} AS kind, '{r.kind}' AS name,
            list_sum(list_transform(s[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[:i-1], lambda x: length(x))), 0) AS start,
            length(m[i]) AS len FROM (
              SELECT row, s, m, unnest(range(1, len(m) + 1)) AS i FROM (
                SELECT row, string_split_regex(t, '{p}') AS s, regexp_extract_all(t, '{p}', 0) AS m FROM d WHERE regexp_matches(t, '{p}')))
            WHERE {ok}"""

    spans = " UNION ALL ".join(part(k, r) for k, r in enumerate(RULES))
    counts = ", ".join(f"count(*) FILTER (kind = {k}) AS n_{r.kind}" for k, r in enumerate(BASE))
    joined = "string_agg(name || ':' || start::BIGINT || ':' || (start + len)::BIGINT, ',' ORDER BY start, kind)"
    return f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
        s AS ({spans}),
        g AS (SELECT row, {counts}, {joined} AS spans, {joined.replace("start, kind)", "start, kind) FILTER (kind < 3)")} AS base FROM s GROUP BY row)
        SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)},
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (row)"""


ORACLE = _oracle()
