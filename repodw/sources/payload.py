"""API payloads to raw records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repodw import schemas

# Payload field by raw column, for the fields that are only renamed.
_TEXTS = {
    "name": "name", "full_name": "full_name", "default_branch": "default_branch", "html_url": "html_url",
    "created_at": "created_at", "updated_at": "updated_at", "pushed_at": "pushed_at",
}
_COUNTS = {
    "stars_count": "stargazers_count", "forks_count": "forks_count", "watchers_count": "watchers_count",
    "open_issues_count": "open_issues_count",
}


def normalize_payload(df: DataFrame, platform: str, payload: str = "payload", org: str | None = None) -> DataFrame:
    """One raw record per API payload (a JSON text column) of a platform.

    `org` names the column with the organisation asked for; without it the owner in the payload counts, as
    for search hits. A default stands in for a missing key only: an explicit JSON null stays null, apart from
    description and language.
    """
    if platform not in ("gitee", "github"):
        raise ValueError(f"unknown platform {platform}")
    github = platform == "github"
    p = F.col("p")

    def field(name: str, default) -> Column:
        return F.when(F.array_contains("given", name), p[name]).otherwise(F.lit(default))

    def text(name: str) -> Column:
        return F.coalesce(p[name], F.lit(""))

    columns = {
        "repo_id": p["id"],
        "org": F.col("asked") if org else search_owner(p, platform),
        "description": text("description"),
        "language": text("language"),
        "topics": F.coalesce(F.array_join(p["topics"], ", "), F.lit("")) if github else F.lit(""),
        "license_type": F.coalesce(p["license"]["spdx_id"], F.lit("")) if github else F.lit(""),
        "homepage": field("homepage", "") if github else F.lit(""),
        "archived": field("archived", False) if github else F.lit(False),
        "source_platform": F.lit(platform),
    }
    columns |= {raw: field(name, "") for raw, name in _TEXTS.items()}
    columns |= {raw: field(name, 0) for raw, name in _COUNTS.items()}
    parsed = df.select(
        F.from_json(payload, schemas.PAYLOAD).alias("p"),
        F.json_object_keys(payload).alias("given"),
        (F.col(org) if org else F.lit(None).cast("string")).alias("asked"),
    )
    return parsed.select(*[columns[name].alias(name) for name in schemas.RAW.fieldNames() if name in columns])


def response_items(df: DataFrame, response: str = "response", payload: str = "payload") -> DataFrame:
    """One payload (JSON text) per item of an API response, be it a list or an object with `items`.

    The other columns stay, such as the organisation or keyword that was asked for.
    """
    text = F.col(response)
    items = F.when(F.ltrim(text).startswith("["), F.from_json(text, "array<string>")).otherwise(
        F.from_json(text, "items array<string>")["items"]
    )
    others = [c for c in df.columns if c != response]
    return df.select(*others, F.explode(items).alias(payload))


def search_owner(p: Column, platform: str) -> Column:
    """Owner of a search hit: owner.login or namespace.path, "" when absent."""
    return F.coalesce(p["owner"]["login"] if platform == "github" else p["namespace"]["path"], F.lit(""))
