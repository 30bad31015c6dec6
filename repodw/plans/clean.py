"""Raw records to clean records to raw-layer rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repodw import fixed_values as V
from repodw import schemas
from repodw.functions.numbers import count_if
from repodw.functions.text import cut, fill_blank, is_true, matches, topics_to_text
from repodw.operators.dedup import keep_one

DEDUP_KEYS = ["repo_id", "source_platform"]


def fill_missing_columns(df: DataFrame, defaults: Mapping[str, object] = schemas.RAW_DEFAULTS) -> DataFrame:
    """Add columns the input lacks altogether; nulls in present columns stay."""
    return df.withColumns({name: F.lit(value) for name, value in defaults.items() if name not in df.columns})


def is_migrated(pattern: str = V.MIGRATED_PATTERN) -> Column:
    """Repository moved elsewhere: judged by its description, on gitee and unknown platforms only."""
    return F.coalesce(F.col("source_platform").isin("gitee", V.UNKNOWN_PLATFORM), F.lit(False)) & matches(
        F.col("description"), pattern
    )


def is_archived() -> Column:
    return F.coalesce((F.col("source_platform") == "github") & F.col("archived"), F.lit(False))


def is_spam() -> Column:
    return F.coalesce(F.length("description") > V.DESCRIPTION_MAX, F.lit(False))


def drop_migrated(df: DataFrame, pattern: str = V.MIGRATED_PATTERN) -> DataFrame:
    return df.filter(~is_migrated(pattern))


def drop_archived(df: DataFrame) -> DataFrame:
    return df.filter(~is_archived())


def drop_spam(df: DataFrame) -> DataFrame:
    return df.filter(~is_spam())


def fill_description(df: DataFrame) -> DataFrame:
    return df.withColumn("description", fill_blank(F.col("description"), V.NO_DESCRIPTION))


def fill_language(df: DataFrame) -> DataFrame:
    return df.withColumn("language", fill_blank(F.col("language"), V.NO_LANGUAGE))


def truncate_text(df: DataFrame, limits: Mapping[str, int] | None = None) -> DataFrame:
    """Cut long text columns; those the input lacks are passed over."""
    limits = limits or {"description": V.DESCRIPTION_MAX, "full_name": V.NAME_MAX, "html_url": V.NAME_MAX}
    return df.withColumns({name: cut(F.col(name), size) for name, size in limits.items() if name in df.columns})


def topics_to_string(df: DataFrame, strict: bool = False) -> DataFrame:
    return df.withColumn("topics", topics_to_text(F.col("topics"), strict))


def clean_repos(df: DataFrame, order: Sequence[str], pattern: str = V.MIGRATED_PATTERN,
                strict_topics: bool = False, keep: str = "first", within: Sequence[str] = ()) -> DataFrame:
    """All cleaning steps. `order` names the columns that say which duplicate came first. Duplicates are settled
    within each value of the columns `within`, such as the load day.

    Rows are dropped after the deduplication on purpose: a dropped first row does not bring back a later
    duplicate.
    """
    return (
        fill_missing_columns(df)
        .transform(keep_one, [*DEDUP_KEYS, *within], order, keep)
        .transform(fill_description)
        .transform(drop_migrated, pattern)
        .transform(drop_archived)
        .transform(drop_spam)
        .transform(truncate_text)
        .transform(fill_language)
        .transform(topics_to_string, strict_topics)
    )


def clean_audit(df: DataFrame, order: Sequence[str], pattern: str = V.MIGRATED_PATTERN) -> DataFrame:
    """One row with the counts of every cleaning step, each on the rows the steps before it left."""
    blank = F.coalesce(F.col("description"), F.lit("")) == ""
    no_language = F.coalesce(F.col("language"), F.lit("")) == ""
    flags = {"blank": blank, "migrated": is_migrated(pattern), "archived": is_archived(), "spam": is_spam(), "no_language": no_language}
    # One pass: the first row of each key and how many rows the key has.
    raw = fill_missing_columns(df).select(
        *DEDUP_KEYS, F.struct(*[F.col(c).alias(f"_{k}") for k, c in enumerate(order)], *[f.alias(n) for n, f in flags.items()]).alias("row"))
    flagged = raw.groupBy(*DEDUP_KEYS).agg(F.count(F.lit(1)).alias("rows"), F.min("row").alias("row")).select(
        "source_platform", "rows", *[F.col(f"row.{name}").alias(name) for name in flags])
    valid = ~F.col("migrated") & ~F.col("archived")
    kept = valid & ~F.col("spam")
    on_gitee = F.coalesce(F.col("source_platform").isin("gitee", V.UNKNOWN_PLATFORM), F.lit(False))
    on_github = F.coalesce(F.col("source_platform") == "github", F.lit(False))
    counts = flagged.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("original"),
        F.count(F.lit(1)).alias("unique_rows"),
        count_if(F.col("blank")).alias("empty_descriptions"),
        count_if(F.col("migrated")).alias("migrated"),
        count_if(F.col("archived")).alias("archived"),
        count_if(~valid).alias("invalid"),
        count_if(valid & F.col("spam")).alias("spam"),
        count_if(kept & F.col("no_language") & on_gitee).alias("no_language_gitee"),
        count_if(kept & F.col("no_language") & on_github).alias("no_language_github"),
        count_if(kept).alias("kept"),
    )
    rest = [c for c in counts.columns if c != "original"]
    return counts.select("original", (F.col("original") - F.col("unique_rows")).alias("duplicates"), *rest)


def normalize_ods(df: DataFrame, day: str | None = None) -> DataFrame:
    """Raw-layer rows of one load day, or of the day each record carries as dt: defaults for what a clean record lacks,
    flags as 0/1, text cut."""
    given = set(df.columns)

    def text(name: str, default: str = "") -> Column:
        return F.col(name) if name in given else F.lit(default)

    def count(name: str) -> Column:
        return F.col(name) if name in given else F.lit(0)

    licence = F.coalesce(F.nullif(text("license_type"), F.lit("")), text("license"))
    columns = {
        "repo_id": F.col("repo_id"),
        "org": text("org"),
        "name": text("name"),
        "full_name": cut(text("full_name"), V.NAME_MAX),
        "description": cut(F.coalesce(text("description"), F.lit("")), V.DESCRIPTION_MAX),
        "stars_count": count("stars_count"),
        "forks_count": count("forks_count"),
        "watchers_count": count("watchers_count"),
        "open_issues_count": count("open_issues_count"),
        "language": fill_blank(text("language"), V.NO_LANGUAGE),
        "default_branch": text("default_branch"),
        "html_url": cut(text("html_url"), V.NAME_MAX),
        "topics": topics_to_text(text("topics")),
        "license_type": licence,
        "homepage": text("homepage"),
        "archived": is_true(text("archived", "0")),
        "created_at": text("created_at"),
        "updated_at": text("updated_at"),
        "pushed_at": text("pushed_at"),
        "source_platform": text("source_platform", V.UNKNOWN_PLATFORM),
        "dt": F.col("dt") if day is None else F.lit(day),
    }
    return df.select(*[col.alias(name) for name, col in columns.items()])
