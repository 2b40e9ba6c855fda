"""The registry of this package: one query per operator, and their SQL."""

from __future__ import annotations

from docquarry.llm import bpe, chat, decontam, fim, media, mixing, neardup, pii, quality, repeats, runs, secrets, tokens

QUERIES = {
    "op1_decontaminate": decontam.op1_decontaminate,
    "op2_scan_secrets": secrets.op2_scan_secrets,
    "op3_ngram_jaccard": neardup.op3_ngram_jaccard,
    "op4_quality": quality.op4_quality,
    "op5_mix_sources": mixing.op5_mix_sources,
    "op6_format_chat": chat.op6_format_chat,
    "op7_separator_scan": tokens.op7_separator_scan,
    "op8_remove_repeats": repeats.op8_remove_repeats,
    "op9_find_personal": pii.op9_find_personal,
    "op10_audio_features": media.op10_audio_features,
    "op11_byte_bpe": bpe.op11_byte_bpe,
    "op12_periodic_runs": runs.op12_periodic_runs,
    "op13_fill_in_middle": fim.op13_fill_in_middle,
}

ORACLE_SQL = {
    "op2_scan_secrets": secrets.ORACLE,
    "op5_mix_sources": mixing.ORACLE,
    "op13_fill_in_middle": fim.ORACLE,
}
