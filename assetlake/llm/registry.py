"""Queries and SQL of the training-data operators."""

from __future__ import annotations

import importlib

#: query name -> (module, function, SQL or None)
ENTRIES = {
    "op1_exact_dedup": ("exact_dedup", "q_exact_dedup", "Q_SQL"),
    "op2_language_id": ("langid", "q_language_id", None),
    "op3_suffix_dedup": ("suffix_dedup", "q_suffix_dedup", None),
    "op4_secret_scan": ("secret_scan", "q_secret_scan", None),
    "op5_line_dedup": ("line_dedup", "q_line_dedup", None),
    "op6_forest_dedup": ("forest_dedup", "q_forest_dedup", None),
    "op7_packing": ("packing", "q_packing", None),
    "op8_minhash_dedup": ("minhash_dedup", "q_minhash_dedup", None),
    "op9_warc": ("warc", "q_warc", None),
    "op10_sentencepiece": ("sentencepiece_codec", "q_sentencepiece", None),
    "op11_token_alignment": ("token_alignment", "q_token_alignment", None),
    "op12_conversation_trie": ("conversation_trie", "q_conversation_trie", "Q_SQL"),
    "op13_token_counts": ("token_counts", "q_token_counts", None),
}


def queries() -> dict:
    return {name: getattr(importlib.import_module(f"assetlake.llm.{mod}"), fn) for name, (mod, fn, _) in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: getattr(importlib.import_module(f"assetlake.llm.{mod}"), sql)
            for name, (mod, _, sql) in ENTRIES.items() if sql}
