"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import exact_dedup, filter_audit
from .bpe import op1_bpe
from .exact_dedup import op3_exact_dedup
from .filter_audit import op11_filter_audit
from .html_extract import op7_html
from .lang_cnn import op6_language
from .lattice_join import op13_lattice_join
from .line_quality import op5_quality
from .ngram_lm import op10_lm
from .near_dup import op2_near_dup
from .packing import op8_packing
from .periodic_runs import op12_periodic_runs
from .token_store import op4_tokens
from .toxicity import op9_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_near_dup": op2_near_dup,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_tokens": op4_tokens,
    "op5_quality": op5_quality,
    "op6_language": op6_language,
    "op7_html": op7_html,
    "op8_packing": op8_packing,
    "op9_toxicity": op9_toxicity,
    "op10_lm": op10_lm,
    "op11_filter_audit": op11_filter_audit,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_lattice_join": op13_lattice_join,
}

ORACLES: dict[str, str] = {
    "op3_exact_dedup": exact_dedup.ORACLE,
    "op11_filter_audit": filter_audit.ORACLE,
}
