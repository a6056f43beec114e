"""The queries of this subpackage and their SQL."""

from siltworks.llm import decontaminate, htmltext, langid, media, mixing, neardup, pii, prefixtrie, quality, qualityrules, tokencount, toxicity, turnrepair

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_html_extract": htmltext.op3_html_extract,
    "op4_media_chunks": media.op4_media_chunks,
    "op5_pii": pii.op5_pii,
    "op6_token_counts": tokencount.op6_token_counts,
    "op7_language": langid.op7_language,
    "op8_minhash_neardup": neardup.op8_minhash_neardup,
    "op9_mixing": mixing.op9_mixing,
    "op10_quality": quality.op10_quality,
    "op11_prefix_trie": prefixtrie.op11_prefix_trie,
    "op12_turn_repair": turnrepair.op12_turn_repair,
    "op13_quality_rules": qualityrules.op13_quality_rules,
}

ORACLE_SQL = {
    "op2_decontaminate": decontaminate.OP2_SQL,
    "op9_mixing": mixing.OP9_SQL,
    "op11_prefix_trie": prefixtrie.OP11_SQL,
    "op12_turn_repair": turnrepair.OP12_SQL,
}
