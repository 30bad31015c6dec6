"""Data-quality profile of cleaned records. Null keys belong to no group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repodw import fixed_values as V
from repodw.functions.numbers import count_if, percent, ratio
from repodw.functions.text import utc_year
from repodw.operators.median import exact_median


def _long_sum(column: str) -> Column:
    return F.coalesce(F.sum(F.col(column).cast("long")), F.lit(0))


def _rows(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


def prof_totals(df: DataFrame) -> DataFrame:
    """Rows, stars, forks, mean and exact median of stars."""
    totals = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        _long_sum("stars_count").alias("total_stars"),
        _long_sum("forks_count").alias("total_forks"),
        F.count("stars_count").alias("_starred"),
    )
    return totals.select(
        "total_rows", "total_stars", "total_forks",
        ratio(F.col("total_stars"), F.col("_starred")).alias("avg_stars"),
        exact_median(df, "stars_count").alias("median_stars"),
    )


def prof_platform(df: DataFrame) -> DataFrame:
    """Per platform: records, stars, mean stars, and how many have a language."""
    groups = df.filter(F.col("source_platform").isNotNull()).groupBy("source_platform").agg(
        F.count("repo_id").alias("repos"),
        _long_sum("stars_count").alias("total_stars"),
        F.count("stars_count").alias("_starred"),
        count_if(~F.coalesce(F.col("language") == V.NO_LANGUAGE, F.lit(False))).alias("with_language"),
    )
    return groups.select(
        "source_platform", "repos", "total_stars",
        ratio(F.col("total_stars"), F.col("_starred")).alias("avg_stars"),
        "with_language",
        F.coalesce(percent(F.col("with_language"), F.col("repos")), F.lit(0).cast("decimal(5,2)")).alias("language_rate"),
    )


def prof_org(df: DataFrame) -> DataFrame:
    keyed = df.filter(F.col("org").isNotNull() & F.col("source_platform").isNotNull())
    groups = keyed.groupBy("org", "source_platform").agg(
        F.count("repo_id").alias("repos"), _long_sum("stars_count").alias("total_stars")
    )
    return groups.orderBy(F.col("total_stars").desc(), "org", "source_platform")


def prof_star_bins(df: DataFrame) -> DataFrame:
    """All bins with their rows and share of all rows, in one pass over the input."""
    stars = F.col("stars_count")
    inside = [(stars >= low) & ((stars < high) if high is not None else F.lit(True)) for _, low, high in V.STAR_BINS]
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"), *[count_if(test).alias(f"bin_{i}") for i, test in enumerate(inside)]
    )
    bins = F.array(*[
        F.struct(F.lit(i).alias("bin_no"), F.lit(label).alias("star_range"), F.col(f"bin_{i}").alias("repos"))
        for i, (label, _, _) in enumerate(V.STAR_BINS)
    ])
    return counts.select("total_rows", F.inline(bins)).select(
        "bin_no", "star_range", "repos", percent(F.col("repos"), F.col("total_rows")).alias("pct")
    )


def prof_top15(df: DataFrame, ties: tuple[str, ...] = ("repo_id",)) -> DataFrame:
    """The 15 most starred records; `ties` is the input order."""
    return df.orderBy(F.col("stars_count").desc(), *ties).limit(V.CHART_ROWS).select(
        "full_name", "stars_count", "forks_count", "language", "source_platform"
    )


def prof_lang_top10(df: DataFrame) -> DataFrame:
    groups = df.filter(F.col("language").isNotNull()).groupBy("language").agg(F.count(F.lit(1)).alias("repos"))
    top = groups.orderBy(F.col("repos").desc(), "language").limit(V.PROFILE_ROWS)
    return top.withColumn("pct", percent(F.col("repos"), _rows(df)))


def prof_year(df: DataFrame) -> DataFrame:
    """Records by the UTC year they were created in; texts that are no time are left out."""
    return df.groupBy(utc_year(F.col("created_at")).alias("year")).agg(F.count(F.lit(1)).alias("repos")).filter(
        F.col("year").isNotNull()
    ).orderBy("year")


def prof_license(df: DataFrame) -> DataFrame:
    column = "license_type" if "license_type" in df.columns else "license"
    groups = df.filter(F.col(column).isNotNull() & (F.col(column) != "")).groupBy(F.col(column).alias("license")).agg(
        F.count(F.lit(1)).alias("repos")
    )
    return groups.orderBy(F.col("repos").desc(), "license").limit(V.PROFILE_ROWS)


def ingest_split(df: DataFrame) -> DataFrame:
    """Rows per platform of a load, in one row."""
    return df.agg(
        count_if(F.col("source_platform") == "gitee").alias("gitee_rows"),
        count_if(F.col("source_platform") == "github").alias("github_rows"),
    )
