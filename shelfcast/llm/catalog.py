"""The registered queries of this folder and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from shelfcast.llm import alignment, bpe, exactdedup, fingerprint, hilbert, langid, mixing, neardup, prefixtrie, suffixdup, toxicity, warc, wrapper


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc_derivatives": warc.op1_warc_derivatives,
        "op2_byte_bpe": bpe.op2_byte_bpe,
        "op3_minhash_inverted_join": neardup.op3_minhash_inverted_join,
        "op4_temperature_mix": mixing.op4_temperature_mix,
        "op5_rank_order_langid": langid.op5_rank_order_langid,
        "op6_content_sort_dedup": exactdedup.op6_content_sort_dedup,
        "op7_bottom_k_fingerprints": fingerprint.op7_bottom_k_fingerprints,
        "op8_hilbert_shards": hilbert.op8_hilbert_shards,
        "op9_wrapper_induction": wrapper.op9_wrapper_induction,
        "op10_subword_toxicity": toxicity.op10_subword_toxicity,
        "op11_suffix_dedup": suffixdup.op11_suffix_dedup,
        "op12_merge_path_alignment": alignment.op12_merge_path_alignment,
        "op13_conversation_trie": prefixtrie.op13_conversation_trie,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_content_sort_dedup": exactdedup.OP6_SQL,
    }
