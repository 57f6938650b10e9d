"""Queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docmeter.llm import chat, embedding_join, filter_audit, jaccard_join, language_id, line_crf, mixing, oracles, packing, prefix_trie, quality_rules, sharding, tokens, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pack_nnls": packing.op1_pack_nnls,
        "op2_warc_index": warc.op2_warc_index,
        "op3_line_crf": line_crf.op3_line_crf,
        "op4_jump_shards": sharding.op4_jump_shards,
        "op5_subspace_join": embedding_join.op5_subspace_join,
        "op6_quality_votes": quality_rules.op6_quality_votes,
        "op7_mix_sources": mixing.op7_mix_sources,
        "op8_count_tokens": tokens.op8_count_tokens,
        "op9_language_id": language_id.op9_language_id,
        "op10_jaccard_skip": jaccard_join.op10_jaccard_skip,
        "op11_filter_audit": filter_audit.op11_filter_audit,
        "op12_chat_format": chat.op12_chat_format,
        "op13_prefix_trie": prefix_trie.op13_prefix_trie,
    }


def oracle_sql() -> dict[str, str]:
    """Packing, trained models, EM and tokenizers have none; tests hold those against brute force, round trips or held-out rows."""
    return {
        "op2_warc_index": oracles.WARC,
        "op4_jump_shards": oracles.JUMP,
        "op5_subspace_join": oracles.VECTORS,
        "op7_mix_sources": oracles.MIX,
        "op10_jaccard_skip": oracles.JACCARD,
        "op11_filter_audit": oracles.FILTERS,
        "op12_chat_format": oracles.CHAT,
        "op13_prefix_trie": oracles.TRIE,
    }
