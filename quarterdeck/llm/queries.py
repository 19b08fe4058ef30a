"""The registered queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from quarterdeck.llm import covertree, mixing
from quarterdeck.llm.common import importable
from quarterdeck.llm.covertree import op13_cover_tree_negatives
from quarterdeck.llm.fingerprint import op2_multiset_fingerprints
from quarterdeck.llm.licenses import op1_license_scan
from quarterdeck.llm.minhash import op8_weighted_minhash
from quarterdeck.llm.mixing import op10_pareto_mixing
from quarterdeck.llm.neighbours import op3_kmeans_tree
from quarterdeck.llm.packing import op5_binary_packing
from quarterdeck.llm.piecetable import op11_piece_table
from quarterdeck.llm.quality import op9_compression_quality
from quarterdeck.llm.suffix import op4_suffix_dedup
from quarterdeck.llm.tokenfile import op7_token_frames
from quarterdeck.llm.toxicity import op6_toxic_segments
from quarterdeck.llm.whitening import op12_shifted_cholesky_whitening

_QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_multiset_fingerprints": op2_multiset_fingerprints,
    "op3_kmeans_tree": op3_kmeans_tree,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_binary_packing": op5_binary_packing,
    "op6_toxic_segments": op6_toxic_segments,
    "op7_token_frames": op7_token_frames,
    "op8_weighted_minhash": op8_weighted_minhash,
    "op9_compression_quality": op9_compression_quality,
    "op10_pareto_mixing": op10_pareto_mixing,
    "op11_piece_table": op11_piece_table,
    "op12_shifted_cholesky_whitening": op12_shifted_cholesky_whitening,
    "op13_cover_tree_negatives": op13_cover_tree_negatives,
}

LLM_QUERIES = {name: (lambda spark, sf_dir, f=f: f(importable(spark), sf_dir)) for name, f in _QUERIES.items()}

LLM_ORACLE_SQL = {"op10_pareto_mixing": mixing.oracle(), "op13_cover_tree_negatives": covertree.ORACLE_SQL}
