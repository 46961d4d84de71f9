"""Registered queries of this subpackage and the SQL of those that SQL expresses."""

from __future__ import annotations

from .bpe import op7_byte_bpe
from .chat import OP10_SQL, op10_chat
from .langid import op5_language
from .multiset import op1_fingerprints
from .negatives import OP11_SQL, op11_negatives
from .packing import op13_packing
from .quality import op3_quality
from .sharding import op2_sharding
from .simhash import op6_simhash
from .tiling import op4_decontamination
from .tokencount import op8_token_counts
from .urls import OP9_SQL, op9_url_filters
from .variants import op12_variants

QUERIES = {
    "op1_document_fingerprints": op1_fingerprints,
    "op2_sharding": op2_sharding,
    "op3_quality_classifier": op3_quality,
    "op4_benchmark_decontamination": op4_decontamination,
    "op5_language_id": op5_language,
    "op6_simhash_near_dedup": op6_simhash,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_token_counts": op8_token_counts,
    "op9_url_filters": op9_url_filters,
    "op10_chat_formatting": op10_chat,
    "op11_hard_negatives": op11_negatives,
    "op12_spelling_variants": op12_variants,
    "op13_packing": op13_packing,
}

ORACLE: dict[str, str] = {
    "op9_url_filters": OP9_SQL,
    "op10_chat_formatting": OP10_SQL,
    "op11_hard_negatives": OP11_SQL,
}
