"""The registered queries of this subpackage: one for each operator."""

from __future__ import annotations

from . import decontaminate, htmltext, langid, linededup, merkle, mixing, ngramjoin, phrases, pii, sharding, tokens, topk, toxicity


def queries() -> dict:
    return {
        "op1_pii": pii.query,
        "op2_line_templates": linededup.query,
        "op3_decontaminate": decontaminate.query,
        "op4_language_id": langid.query,
        "op5_mix_sources": mixing.query,
        "op6_ngram_jaccard": ngramjoin.query,
        "op7_shard_slots": sharding.query,
        "op8_topk_norm_buckets": topk.query,
        "op9_prefix_tokens": tokens.query,
        "op10_main_text": htmltext.query,
        "op11_collocations": phrases.query,
        "op12_merkle_manifest": merkle.query,
        "op13_toxic_segments": toxicity.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_line_templates": linededup.SQL,
        "op3_decontaminate": decontaminate.SQL,
        "op5_mix_sources": mixing.SQL,
        "op6_ngram_jaccard": ngramjoin.SQL,
        "op8_topk_norm_buckets": topk.SQL,
        "op11_collocations": phrases.SQL,
        "op12_merkle_manifest": merkle.SQL,
    }
