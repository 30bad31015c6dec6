"""Columns and small helpers that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDS = 5


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def merged_length(spans: Column) -> Column:
    """How many whole positions an array of struct(start, end), end exclusive, covers."""
    zero = F.struct(F.lit(0).cast("long").alias("reach"), F.lit(0).cast("long").alias("n"))

    def step(state: Column, span: Column) -> Column:
        new = F.greatest(span["end"].cast("long") - F.greatest(state["reach"], span["start"].cast("long")), F.lit(0).cast("long"))
        return F.struct(F.greatest(state["reach"], span["end"].cast("long")).alias("reach"), (state["n"] + new).alias("n"))

    return F.aggregate(F.array_sort(spans), zero, step, lambda state: state["n"])
