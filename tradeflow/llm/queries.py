"""The registered queries of this package: one ``opN_<name>`` for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op8_bpe_transducer
from .chat import OP7_SQL, op7_chat_parts
from .collocations import OP11_SQL, op11_son_collocations
from .fingerprints import op10_weighted_sampling
from .language import op4_language_id
from .lines import OP13_SQL, op13_line_dedup
from .manifest import OP12_SQL, op12_merkle_manifest
from .neardup import op5_bagminhash
from .packing import op2_harmonic_packing
from .quality import op6_weak_supervision
from .substrings import OP1_SQL, op1_debruijn_substrings
from .toxicity import op3_toxic_segments
from .urls import op9_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_debruijn_substrings,
        op2_harmonic_packing,
        op3_toxic_segments,
        op4_language_id,
        op5_bagminhash,
        op6_weak_supervision,
        op7_chat_parts,
        op8_bpe_transducer,
        op9_url_filter,
        op10_weighted_sampling,
        op11_son_collocations,
        op12_merkle_manifest,
        op13_line_dedup,
    )
}

#: DuckDB statements for those that SQL can express.
ORACLE: dict[str, str] = {
    "op1_debruijn_substrings": OP1_SQL,
    "op7_chat_parts": OP7_SQL,
    "op11_son_collocations": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
    "op13_line_dedup": OP13_SQL,
}
