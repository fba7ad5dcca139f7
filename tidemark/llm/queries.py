"""The corpus operators' queries and their SQL twins."""

from __future__ import annotations

from tidemark.llm import (
    byte_pairs,
    cross_tokens,
    document_fingerprints,
    license_scan,
    line_dedup,
    near_documents,
    quality_classifier,
    quality_rules,
    sampled_pieces,
    source_mix,
    token_files,
    toxicity,
    vector_codes,
)

QUERIES = {
    "op1_quality_rules": quality_rules.query,
    "op2_license_scans": license_scan.query,
    "op3_document_fingerprints": document_fingerprints.query,
    "op4_token_files": token_files.query,
    "op5_line_dedup": line_dedup.query,
    "op6_toxicity": toxicity.query,
    "op7_sampled_pieces": sampled_pieces.query,
    "op8_source_mix": source_mix.query,
    "op9_quality_classifier": quality_classifier.query,
    "op10_simhash_near_dedup": near_documents.query,
    "op11_cross_tokens": cross_tokens.query,
    "op12_byte_pairs": byte_pairs.query,
    "op13_vector_codes": vector_codes.query,
}

#: DuckDB twins of the queries that SQL expresses.
ORACLE: dict[str, str] = {
    "op1_quality_rules": quality_rules.ORACLE,
    "op8_source_mix": source_mix.ORACLE,
    "op13_vector_codes": vector_codes.ORACLE,
}
