"""The queries of this subpackage and their SQL, for __spark_entry__.py."""

from __future__ import annotations

from corpusloom.llm import chat, decontaminate, exact_dedup, line_dedup, lm_score, merkle, mixing, quality, sharding, simhash, spelling, suffix_dedup, toxicity

QUERIES = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_lm_score": lm_score.op3_lm_score,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_mixing": mixing.op5_mixing,
    "op6_sharding": sharding.op6_sharding,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_quality": quality.op8_quality,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_simhash": simhash.op10_simhash,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_chat_format": chat.op12_chat_format,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}
ORACLE_SQL = {**exact_dedup.ORACLE, **mixing.ORACLE, **sharding.ORACLE, **merkle.ORACLE, **spelling.ORACLE, **chat.ORACLE}
