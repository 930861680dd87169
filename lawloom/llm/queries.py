"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from importlib import import_module

_QUERIES = {
    "op1_compression_quality": ("quality_classifier", "op1"),
    "op2_line_frequency_rules": ("quality_rules", "op2"),
    "op3_cnn_toxicity": ("toxicity", "op3"),
    "op4_hilbert_packing": ("packing", "op4"),
    "op5_bayesian_minhash": ("minhash", "op5"),
    "op6_int8_tiles": ("embedding_dedup", "op6"),
    "op7_mixture_language": ("language_id", "op7"),
    "op8_pivotal_mixing": ("mixing", "op8"),
    "op9_line_block_text": ("html_text", "op9"),
    "op10_run_length_repeats": ("repeats", "op10"),
    "op11_trie_repair": ("conversations", "op11"),
    "op12_two_tier_bpe": ("bpe", "op12"),
    "op13_suffix_phrases": ("phrases", "op13"),
}


def _bound(module: str, name: str):
    return getattr(import_module(f"{__package__}.{module}"), name)


def queries() -> dict:
    return {name: _bound(*where) for name, where in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {"op2_line_frequency_rules": _bound("quality_rules", "OP2_SQL"), "op13_suffix_phrases": _bound("phrases", "OP13_SQL")}
