"""Queries of this subpackage over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from tidemark.llm.byte_bpe import op8_byte_bpe
from tidemark.llm.decontaminate import op6_decontamination
from tidemark.llm.fill_in_middle import OP13_SQL, op13_fill_in_middle
from tidemark.llm.language_id import op2_language_id
from tidemark.llm.lexical_search import OP11_SQL, op11_best_position_search
from tidemark.llm.near_dups import op1_dart_minhash
from tidemark.llm.packing import op12_packing
from tidemark.llm.passages import op4_substring_dedup
from tidemark.llm.pii import op9_pii
from tidemark.llm.quality_classifier import op7_quality_classifier
from tidemark.llm.quality_rules import OP3_SQL, op3_quality_rules
from tidemark.llm.repeats import op10_suffix_dedup
from tidemark.llm.token_counts import op5_token_counts

QUERIES = {
    "op1_dart_minhash": op1_dart_minhash,
    "op2_language_id": op2_language_id,
    "op3_quality_rules": op3_quality_rules,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_decontamination": op6_decontamination,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_pii": op9_pii,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_best_position_search": op11_best_position_search,
    "op12_packing": op12_packing,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLES = {
    "op3_quality_rules": OP3_SQL,
    "op11_best_position_search": OP11_SQL,
    "op13_fill_in_middle": OP13_SQL,
}
