"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from . import byte_pairs, conversations, decontaminate, embeddings, language_id, language_model, near_dup, pieces, substrings, toxicity, vector_codes, warc, wrappers

QUERIES = {
    "op1_html_extraction": wrappers.op1_html_extraction,
    "op2_language_id": language_id.op2_language_id,
    "op3_sentencepiece": pieces.op3_sentencepiece,
    "op4_language_model": language_model.op4_language_model,
    "op5_embedding_near_dedup": embeddings.op5_embedding_near_dedup,
    "op6_minhash_near_dedup": near_dup.op6_minhash_near_dedup,
    "op7_decontamination": decontaminate.op7_decontamination,
    "op8_warc": warc.op8_warc,
    "op9_substring_dedup": substrings.op9_substring_dedup,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_conversation_trie": conversations.op11_conversation_trie,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_byte_bpe": byte_pairs.op13_byte_bpe,
}
ORACLES = {
    "op5_embedding_near_dedup": embeddings.ORACLE_OP5,
    "op6_minhash_near_dedup": near_dup.ORACLE_OP6,
    "op7_decontamination": decontaminate.ORACLE_OP7,
    "op8_warc": warc.ORACLE_OP8,
    "op9_substring_dedup": substrings.ORACLE_OP9,
    "op11_conversation_trie": conversations.ORACLE_OP11,
    "op12_vector_codes": vector_codes.ORACLE_OP12,
}
