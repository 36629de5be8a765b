"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontam, langid, licenses, lm_score, pivots, pseudonyms, quality, shards, simhash

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": langid.op1_language_id,
    "op2_decontamination": decontam.op2_decontamination,
    "op3_license_scan": licenses.op3_license_scan,
    "op4_simhash_near_dedup": simhash.op4_simhash_near_dedup,
    "op5_sharding": shards.op5_sharding,
    "op6_embedding_near_dedup": pivots.op6_embedding_near_dedup,
    "op7_quality": quality.op7_quality,
    "op8_pii": pseudonyms.op8_pii,
    "op9_bpe": bpe.op9_bpe,
    "op10_lm_scoring": lm_score.op10_lm_scoring,
}

ORACLE_SQL: dict[str, str] = {
    "op3_license_scan": licenses.op3_sql(),
    "op5_sharding": shards.op5_sql(),
    "op6_embedding_near_dedup": pivots.op6_sql(),
    "op10_lm_scoring": lm_score.op10_sql(),
}
