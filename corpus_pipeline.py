"""A training-data pipeline over documents: quality, toxicity, near-duplicates, repeated passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadenza.llm import packing, passages, quality, simhash, toxicity
from cadenza.llm.common import kept, read

#: Each takes (spark, docs, sf_dir). All but the last return the columns of docs.
STAGES = [
    ("quality", quality.quality_stage),
    ("toxicity", toxicity.toxicity_stage),
    ("near_duplicates", simhash.dedup_stage),
    ("repeated_passages", passages.passages_stage),
    ("packing", packing.packing_stage),
]

#: Models and suffix arrays have no SQL; tests hold each stage against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's documents are written and read again as the next one's."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
