"""Operators that prepare text corpora: personal data, tokens, shards, filters, near-duplicates, search, quality, packing,
hard negatives, repeated passages, whitening.

``queries()`` gives each operator's query over whole tables, ``oracle_sql()`` DuckDB SQL for those that SQL can express. Nothing
outside this package imports it, but for the repository's entry file and ``corpus_pipeline``.
"""

from __future__ import annotations

from collections.abc import Callable


def queries() -> dict[str, Callable]:
    from . import embedding_dedup, hard_negatives, langid, minhash, packing, pii, quality, sentencepiece, sharding, substring_dedup, topk, urlfilter, whitening

    found = (
        pii.op1_pii,
        sentencepiece.op2_sentencepiece,
        sharding.op3_sharding,
        urlfilter.op4_url_filter,
        embedding_dedup.op5_embedding_near_dedup,
        langid.op6_language_id,
        topk.op7_exact_top_k,
        minhash.op8_minhash_near_dedup,
        quality.op9_quality,
        packing.op10_packing,
        hard_negatives.op11_hard_negative_mining,
        substring_dedup.op12_substring_dedup,
        whitening.op13_embedding_whitening,
        pii.pii_base_counts,
        urlfilter.url_hosts_and_rules,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    from . import embedding_dedup, hard_negatives, minhash, pii, sharding, substring_dedup, topk, urlfilter

    return {
        "op3_sharding": sharding.ORACLE_SQL,
        "op5_embedding_near_dedup": embedding_dedup.ORACLE_SQL,
        "op7_exact_top_k": topk.ORACLE_SQL,
        "op8_minhash_near_dedup": minhash.ORACLE_SQL,
        "op11_hard_negative_mining": hard_negatives.ORACLE_SQL,
        "op12_substring_dedup": substring_dedup.ORACLE_SQL,
        "pii_base_counts": pii.BASE_COUNTS_SQL,
        "url_hosts_and_rules": urlfilter.RULES_SQL,
    }
