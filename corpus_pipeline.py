"""The corpus pipeline: documents in, a clean mixture out. Each stage reads what the one before has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from repodw.llm import stages
from repodw.session import delete_path, scratch_dir, scratch_scope

STAGES = [
    ("identify_language", stages.identify_language),
    ("drop_near_duplicates", stages.drop_near_duplicates),
    ("decontaminate_benchmark", stages.decontaminate_benchmark),
    ("mask_secrets", stages.mask_secrets),
    ("mix_sources", stages.mix_sources),
]

# SQL can't express hyperdimensional vectors, a trained forest or hypergeometric draws.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What stages write for themselves, and the output of the stage before, is deleted as soon
    as a stage's own output is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_dir(spark, name)
        with scratch_scope(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            delete_path(spark, before)
        before = path
    return docs
