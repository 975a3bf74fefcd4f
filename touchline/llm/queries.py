"""The registered queries of this package and the SQL that DuckDB can check them with."""

from __future__ import annotations

from .classifier import op6_subword_classifier
from .fingerprints import op1_fingerprints
from .mixing import OP12_SQL, op12_water_filling
from .nearduplicates import op10_order_minhash
from .packing import op9_harmonic_packing
from .repetition import op2_repetition
from .search import OP13_SQL, op13_nra_search
from .sharding import op5_byte_shards
from .substrings import op4_chunk_dedup
from .tokencounts import op8_token_counts
from .transducer import op3_transducer
from .urlfilters import OP7_SQL, op7_url_rules
from .whitening import op11_chebyshev_whitening

QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_repetition": op2_repetition,
    "op3_transducer": op3_transducer,
    "op4_chunk_dedup": op4_chunk_dedup,
    "op5_byte_shards": op5_byte_shards,
    "op6_subword_classifier": op6_subword_classifier,
    "op7_url_rules": op7_url_rules,
    "op8_token_counts": op8_token_counts,
    "op9_harmonic_packing": op9_harmonic_packing,
    "op10_order_minhash": op10_order_minhash,
    "op11_chebyshev_whitening": op11_chebyshev_whitening,
    "op12_water_filling": op12_water_filling,
    "op13_nra_search": op13_nra_search,
}

#: The other operators' results cannot be expressed in SQL; tests/llm holds them against brute force.
ORACLE_SQL = {"op7_url_rules": OP7_SQL, "op12_water_filling": OP12_SQL, "op13_nra_search": OP13_SQL}
