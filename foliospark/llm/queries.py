"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from foliospark.llm import hardneg, licences, oracles, trie
from foliospark.llm.ann import op10_ann_prefix_forest
from foliospark.llm.bpe import op5_byte_bpe
from foliospark.llm.hardneg import op13_hard_negatives
from foliospark.llm.licences import op9_licence_scan
from foliospark.llm.mixing import op6_mix_sources
from foliospark.llm.neardup import op2_minhash_near_dedup
from foliospark.llm.packing import op11_best_fit_packing
from foliospark.llm.pii import op8_pii_pseudonyms
from foliospark.llm.quality import op1_quality_rules
from foliospark.llm.quotes import op7_quote_threads
from foliospark.llm.tokenstore import op4_token_store
from foliospark.llm.toxicity import op3_toxicity
from foliospark.llm.trie import op12_conversation_trie

QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_token_store": op4_token_store,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_mix_sources": op6_mix_sources,
    "op7_quote_threads": op7_quote_threads,
    "op8_pii_pseudonyms": op8_pii_pseudonyms,
    "op9_licence_scan": op9_licence_scan,
    "op10_ann_prefix_forest": op10_ann_prefix_forest,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLES: dict[str, str] = {
    "op2_minhash_near_dedup": oracles.NEAR_DUPLICATES,
    "op9_licence_scan": licences.ORACLE,
    "op12_conversation_trie": trie.ORACLE,
    "op13_hard_negatives": hardneg.ORACLE,
}
