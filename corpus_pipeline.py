"""From raw documents to packed training sequences.

``STAGES`` lists (name, function): each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written and read again as the next one's
docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollcall.llm import decontaminate, language_id, packing, secrets_crf, simhash
from rollcall.session import scratch_path

STAGES = [
    ("language", language_id.stage),
    ("near-duplicates", simhash.stage),
    ("decontamination", decontaminate.stage),
    ("secrets", secrets_crf.stage),
    ("packing", packing.stage),
]

# The stages learn models and hash shingles: not SQL. Tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
