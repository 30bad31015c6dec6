"""Exact decimals and the outgoing form of values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = "decimal(20,0)"


def ratio(top: Column, bottom: Column, to: str = "decimal(10,2)") -> Column:
    """top / bottom of whole numbers, half-up at two places, null on a zero bottom. Never through double."""
    exact = top.cast(_WHOLE) / F.nullif(bottom.cast(_WHOLE), F.lit(0).cast(_WHOLE))
    return F.round(exact, 2).cast(to)


def percent(part: Column, whole: Column, to: str = "decimal(5,2)") -> Column:
    return ratio(part.cast(_WHOLE) * 100, whole, to)


def count_if(condition: Column) -> Column:
    """Number of rows where the condition holds; 0 rather than null on no rows."""
    return F.count(F.when(condition, 1))


def wire_form(df: DataFrame) -> DataFrame:
    """Dates and times as text, decimals as double: the form in which results leave the warehouse."""

    def out(field: T.StructField) -> Column:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            col = col.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.substring(col.cast("string"), 1, 19)
        elif isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        return col.alias(field.name)

    return df.select([out(field) for field in df.schema.fields])
