"""A corpus pipeline of five operators; each stage is written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontam, langid, pseudonyms, simhash
from tidemark.llm.common import cut, table

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", langid.stage),
    ("simhash_near_dedup", simhash.stage),
    ("benchmark_decontamination", decontam.stage),
    ("pii_pseudonyms", pseudonyms.stage),
    ("bpe_encoding", bpe.stage),
]

#: The stages learn models and walk trees; no SQL expresses them, tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
