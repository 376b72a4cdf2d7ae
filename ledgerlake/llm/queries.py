"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from . import (
    circulant_minhash, conversation_repair, embedding_whitening, factor_machine, html_mincut, license_scan, line_dedup, ngram_rules, source_mix,
    suffix_dedup, token_count, warc_bundle, winnowing,
)

QUERIES = {
    "op10_html_mincut": html_mincut.op10,
    "op11_line_dedup": line_dedup.op11,
    "op12_embedding_whitening": embedding_whitening.op12,
    "op13_conversation_repair": conversation_repair.op13,
    "op1_warc_bundle": warc_bundle.op1,
    "op2_factor_machine": factor_machine.op2,
    "op3_winnowing": winnowing.op3,
    "op4_source_mix": source_mix.op4,
    "op5_circulant_minhash": circulant_minhash.op5,
    "op6_token_count": token_count.op6,
    "op7_license_scan": license_scan.op7,
    "op8_suffix_dedup": suffix_dedup.op8,
    "op9_ngram_rules": ngram_rules.op9,
}

ORACLE = {
    "op11_line_dedup": line_dedup.ORACLE_SQL,
    "op1_warc_bundle": warc_bundle.ORACLE_SQL,
    "op3_winnowing": winnowing.ORACLE_SQL,
    "op4_source_mix": source_mix.ORACLE_SQL,
}
