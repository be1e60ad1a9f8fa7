"""The corpus pipeline: raw documents to encoded training text, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on every row that the stage
before it kept.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from sojourn.llm.common import read_table, stage_table
from sojourn.llm.pieces import encode
from sojourn.llm.rules import keep_good
from sojourn.llm.secrets import redact
from sojourn.llm.simhash import one_of_each
from sojourn.llm.winnow import drop_contaminated
from sojourn.session import ship_code

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(function: Stage) -> Stage:
    """A stage whose tasks can import this package wherever the driver was started."""

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_code(spark)
        return function(spark, docs, sf_dir)

    return run


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: that with the smallest doc_id."""
    return one_of_each(docs)


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


@stage
def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret found masked by its kind."""
    return redact(docs)


@stage
def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its piece ids."""
    return encode(docs).select("doc_id", "n_chunks", "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret scan", secret_scan),
    ("encoding", encoding),
]

ORACLE_SQL = None  # an isolation forest, Golay keys and piece ids are not SQL; tests/llm has brute-force versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's result is written and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage_table(docs, "pipeline_" + name.replace(" ", "_"))
    return docs
