"""Queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

from . import (byte_cnn, flow_reshard, license_diagonals, mixing, order_minhash, prefix_decontam, simhash_bits, suffix_dedup,
               token_align, token_files, url_tree, vector_codes, weak_quality)

QUERIES = {f.__name__: f for f in (
    url_tree.op1_url_tree, mixing.op2_soft_mixing, weak_quality.op3_weak_quality, simhash_bits.op4_simhash_near_dedup,
    prefix_decontam.op5_prefix_decontamination, license_diagonals.op6_license_diagonals, order_minhash.op7_order_minhash,
    flow_reshard.op8_flow_reshard, token_files.op9_token_files, byte_cnn.op10_byte_cnn_language,
    suffix_dedup.op11_suffix_dedup, token_align.op12_token_align, vector_codes.op13_vector_codes)}

ORACLE_SQL = {"op5_prefix_decontamination": prefix_decontam.ORACLE, "op11_suffix_dedup": suffix_dedup.ORACLE,
              "op13_vector_codes": vector_codes.ORACLE}
