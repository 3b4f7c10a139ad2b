"""The corpus pipeline, from raw documents to packed pieces.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame; it is written as Parquet and read again as the next
stage's documents.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from sparloom.llm import decontaminate, packing, quality, simhash, substring_dedup
from sparloom.llm.common import scratch_dir

STAGES = [
    ("quality_classifier", quality.stage),
    ("simhash_near_dedup", simhash.stage),
    ("substring_dedup", substring_dedup.stage),
    ("benchmark_decontamination", decontaminate.stage),
    ("best_fit_packing", packing.stage),
]

#: DuckDB can't express the classifier or the packing; the rows are held against brute force in tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{scratch_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{root}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
