"""Named queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

from lastmile.llm import chat, divergence, hard_negatives, jaccard_join, max_score, mixing, multi_index, order_minhash, packing, pii, quality, toxicity, url_filter
from lastmile.llm.common import ready


def queries() -> dict:
    found = {
        "op1_packing": packing.op1_packing,
        "op2_order_minhash": order_minhash.op2_order_minhash,
        "op3_url_filter": url_filter.op3_url_filter,
        "op4_quality": quality.op4_quality,
        "op5_multi_index": multi_index.op5_multi_index,
        "op6_toxicity": toxicity.op6_toxicity,
        "op7_pii": pii.op7_pii,
        "op8_chat_formatting": chat.op8_chat_formatting,
        "op9_jaccard_join": jaccard_join.op9_jaccard_join,
        "op10_mixing": mixing.op10_mixing,
        "op11_hard_negatives": hard_negatives.op11_hard_negatives,
        "op12_divergence": divergence.op12_divergence,
        "op13_max_score": max_score.op13_max_score,
    }
    return {name: ready(query) for name, query in found.items()}


def oracle_sql() -> dict:
    return {
        "op3_url_filter": url_filter.OP3_SQL,
        "op10_mixing": mixing.OP10_SQL,
        "op11_hard_negatives": hard_negatives.OP11_SQL,
        "op12_divergence": divergence.OP12_SQL,
        "op13_max_score": max_score.OP13_SQL,
    }
