"""The registered queries of this folder and the SQL of those that SQL can express."""

from __future__ import annotations

from strandline.llm import bpe, conversation_repair, lexical_search, masked_lm, media, quality_rules, simhash, source_mix, substring_dedup, suffix_dedup, token_counts, token_files, url_filter


def queries() -> dict:
    return {
        "op1_source_mix": source_mix.op1_source_mix,
        "op2_simhash": simhash.op2_simhash,
        "op3_masked_lm": masked_lm.op3_masked_lm,
        "op4_bpe": bpe.op4_bpe,
        "op5_url_filter": url_filter.op5_url_filter,
        "op6_substring_dedup": substring_dedup.op6_substring_dedup,
        "op7_token_counts": token_counts.op7_token_counts,
        "op8_quality_rules": quality_rules.op8_quality_rules,
        "op9_media": media.op9_media,
        "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
        "op11_token_files": token_files.op11_token_files,
        "op12_lexical_search": lexical_search.op12_lexical_search,
        "op13_conversation_repair": conversation_repair.op13_conversation_repair,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_source_mix": source_mix.ORACLE, "op8_quality_rules": quality_rules.ORACLE, "op12_lexical_search": lexical_search.ORACLE, "op13_conversation_repair": conversation_repair.ORACLE}
