"""The registered queries of the training-data operators, and SQL where it can express them."""

from __future__ import annotations

from . import chat, decontamination, jaccard_join, langid, lm_score, mixing, token_files, topk_search, toxicity, warc

QUERIES = {
    "op1_topk_search": topk_search.op1_topk_search,
    "op2_jaccard_join": jaccard_join.op2_jaccard_join,
    "op3_language_id": langid.op3_language_id,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_decontaminate": decontamination.op5_decontaminate,
    "op6_chat_format": chat.op6_chat_format,
    "op7_token_files": token_files.op7_token_files,
    "op8_warc": warc.op8_warc,
    "op9_pareto_mix": mixing.op9_pareto_mix,
    "op10_cross_entropy": lm_score.op10_cross_entropy,
}
ORACLE_SQL = {
    "op1_topk_search": topk_search.OP1_SQL,
    "op2_jaccard_join": jaccard_join.OP2_SQL,
    "op5_decontaminate": decontamination.OP5_SQL,
    "op6_chat_format": chat.OP6_SQL,
    "op8_warc": warc.OP8_SQL,
    "op9_pareto_mix": mixing.OP9_SQL,
}
