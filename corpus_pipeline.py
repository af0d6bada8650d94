"""Training-data pipeline over ``documents``: quality rules, near-duplicates, personal data,
packing. Each stage reads all its predecessor kept, from Parquet."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from orderlens.llm import stages
from orderlens.session import shared_folder

STAGES = [
    ("quality_rules", stages.quality_rules),
    ("near_duplicates", stages.near_duplicates),
    ("personal_data", stages.personal_data),
    ("packing", stages.packing),
]
# SQL has no XXH64, so the second stage cannot be stated; tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
