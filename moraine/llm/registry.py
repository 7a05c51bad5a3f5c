"""The opN_ queries of this subpackage."""

from __future__ import annotations

from moraine.llm import chat, decontaminate, embeddings, jaccard, linededup, pii, quality, secrets, sentencepieces, substrings

QUERIES: dict = {
    "op1_suffix_array_dedup": substrings.query,
    "op2_pii": pii.query,
    "op3_quality_classifier": quality.query,
    "op4_chat_formatting": chat.query,
    "op5_ngram_jaccard_join": jaccard.query,
    "op6_secret_scan": secrets.query,
    "op7_sentencepiece": sentencepieces.query,
    "op8_line_dedup": linededup.query,
    "op9_benchmark_decontamination": decontaminate.query,
    "op10_embedding_near_dedup": embeddings.query,
}
ORACLES: dict = {
    "op4_chat_formatting": chat.ORACLE,
    "op5_ngram_jaccard_join": jaccard.ORACLE,
    "op9_benchmark_decontamination": decontaminate.ORACLE,
    "op10_embedding_near_dedup": embeddings.ORACLE,
}
