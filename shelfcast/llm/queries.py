"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chunk_bpe import op11_chunk_bpe
from .importance_sampling import op13_importance_resampling
from .language_id import op5_language_id
from .lexical_search import op12_lexical_search
from .line_dedup import op7_line_dedup
from .mixing import op4_mix_sources
from .near_dedup import op9_near_dedup
from .oracle import SQL
from .packing import op10_pack_sequences
from .passage_dedup import op6_passage_dedup
from .quality_rules import op3_quality_rules
from .secret_scan import op1_secret_scan
from .token_files import op2_token_files
from .vector_search import op8_nearest_vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_token_files, op3_quality_rules, op4_mix_sources, op5_language_id, op6_passage_dedup,
        op7_line_dedup, op8_nearest_vectors, op9_near_dedup, op10_pack_sequences, op11_chunk_bpe,
        op12_lexical_search, op13_importance_resampling,
    )
}

ORACLE: dict[str, str] = dict(SQL)
