"""The registered queries of this subpackage, and the oracle SQL of those that SQL can express."""

from __future__ import annotations

from tierflow.llm import ann, bpe, chat, decontaminate, lengths, mainhtml, merkle, neardup, quality, surrogates, toxicity, variants, warc

QUERIES = {
    "op1_surrogates": surrogates.op1_surrogates,
    "op2_decontamination": decontaminate.op2_decontamination,
    "op3_byte_bpe": bpe.op3_byte_bpe,
    "op4_nearest_neighbours": ann.op4_nearest_neighbours,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_warc": warc.op6_warc,
    "op7_token_lengths": lengths.op7_token_lengths,
    "op8_chat_windows": chat.op8_chat_windows,
    "op9_near_duplicates": neardup.op9_near_duplicates,
    "op10_quality": quality.op10_quality,
    "op11_main_text": mainhtml.op11_main_text,
    "op12_spelling_variants": variants.op12_spelling_variants,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

ORACLE: dict[str, str] = {
    "op2_decontamination": decontaminate.ORACLE,
    "op6_warc": warc.ORACLE,
    "op12_spelling_variants": variants.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
