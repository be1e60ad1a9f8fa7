"""The operators' registered queries and the SQL that states their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bitsliced import ORACLE as OP11_SQL
from .bitsliced import op11_bitsliced_bloom
from .extract import op5_text_tag_ratio
from .kneser import op7_kneser_ney
from .lines import ORACLE as OP6_SQL
from .lines import op6_line_dedup
from .merkle import ORACLE as OP12_SQL
from .merkle import op12_merkle_intervals
from .mixing import op13_pivotal_mix
from .ngrams import op3_elias_fano_lm
from .pieces import op8_sentencepiece
from .rules import op10_quality_rules
from .secrets import ORACLE as OP9_SQL
from .secrets import op9_blob_ledger
from .simhash import op4_simhash_golay
from .warc import ORACLE as OP1_SQL
from .warc import op1_chunked_warc
from .winnow import ORACLE as OP2_SQL
from .winnow import op2_winnowing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chunked_warc": op1_chunked_warc,
    "op2_winnowing": op2_winnowing,
    "op3_elias_fano_lm": op3_elias_fano_lm,
    "op4_simhash_golay": op4_simhash_golay,
    "op5_text_tag_ratio": op5_text_tag_ratio,
    "op6_line_dedup": op6_line_dedup,
    "op7_kneser_ney": op7_kneser_ney,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_blob_ledger": op9_blob_ledger,
    "op10_quality_rules": op10_quality_rules,
    "op11_bitsliced_bloom": op11_bitsliced_bloom,
    "op12_merkle_intervals": op12_merkle_intervals,
    "op13_pivotal_mix": op13_pivotal_mix,
}

ORACLE_SQL: dict[str, str] = {
    "op1_chunked_warc": OP1_SQL,
    "op2_winnowing": OP2_SQL,
    "op6_line_dedup": OP6_SQL,
    "op9_blob_ledger": OP9_SQL,
    "op11_bitsliced_bloom": OP11_SQL,
    "op12_merkle_intervals": OP12_SQL,
}
