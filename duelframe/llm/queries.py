"""Registered queries of the subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from duelframe.llm.ann import op5_nearest_neighbours
from duelframe.llm.bpe import op1_byte_bpe
from duelframe.llm.decontam import op7_benchmark_decontamination
from duelframe.llm.grid_join import OP12_SQL, op12_embedding_near_duplicates
from duelframe.llm.html_text import op3_html_extraction
from duelframe.llm.lines import op4_line_dedup
from duelframe.llm.minhash import op6_minhash_near_duplicates
from duelframe.llm.periodic import op13_periodic_runs
from duelframe.llm.quality import op10_quality_classifier
from duelframe.llm.secret_scan import op8_secret_scan
from duelframe.llm.spelling import op11_spelling_variants
from duelframe.llm.suffix import op2_suffix_dedup
from duelframe.llm.warc import OP9_SQL, op9_warc_fixity_audit

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_html_extraction": op3_html_extraction,
    "op4_line_dedup": op4_line_dedup,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_minhash_near_duplicates": op6_minhash_near_duplicates,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_secret_scan": op8_secret_scan,
    "op9_warc_fixity_audit": op9_warc_fixity_audit,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_embedding_near_duplicates": op12_embedding_near_duplicates,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = {"op9_warc_fixity_audit": OP9_SQL, "op12_embedding_near_duplicates": OP12_SQL}
