"""Text and time expressions used by cleaning and by the star schema."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fill_blank(col: Column, default: str) -> Column:
    """Null or empty text becomes `default`; a blank of spaces stays."""
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(default))


def not_blank(col: Column) -> Column:
    return col.isNotNull() & (col != "")


def cut(col: Column, size: int) -> Column:
    """The first `size` characters (characters, not bytes)."""
    return F.substring(col, 1, size)


def topics_to_text(col: Column, strict: bool = False) -> Column:
    """A JSON list of topics becomes "a, b". Other text is kept, or blanked when `strict`."""
    items = F.from_json(col, "array<string>")
    other = F.lit("") if strict else col
    return F.coalesce(
        F.when(F.ltrim(col).startswith("["), F.array_join(items, ", ")).otherwise(other), F.lit("")
    )


def matches(col: Column, pattern: str) -> Column:
    """Case-insensitive regular expression; null never matches."""
    return F.coalesce(F.rlike(col, F.lit("(?iu)" + pattern)), F.lit(False))


def month_of_text(col: Column) -> Column:
    """Month of an ISO time as it is written, without changing its zone."""
    return F.substring(col, 1, 7)


def month_of_date(col: Column) -> Column:
    return F.substring(col.cast("string"), 1, 7)


def parse_created_at(col: Column) -> Column:
    """The written local time without its zone; null when it is not a time."""
    return F.try_to_timestamp(F.substring(col, 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss")).cast("timestamp_ntz")


def utc_year(col: Column) -> Column:
    """Year in UTC of an ISO date or time; without a zone it is taken as UTC. Null when it is neither."""
    dated = F.rlike(col, F.lit(r"^\d{4}-\d{1,2}-\d{1,2}"))
    zoned = F.rlike(col, F.lit(r":.*(Z|[+-]\d{2}:?\d{2})$"))
    timed = F.contains(col, F.lit(":"))
    written = F.when(zoned, col).when(timed, F.concat(col, F.lit("Z"))).otherwise(F.concat(col, F.lit("T00:00:00Z")))
    moment = F.try_to_timestamp(F.when(dated, written))
    return F.year(F.to_utc_timestamp(moment, F.current_timezone()))


def is_true(col: Column) -> Column:
    """1 for true, 1 or "1", else 0."""
    return F.when(col.cast("string").isin("true", "1"), 1).otherwise(0)
