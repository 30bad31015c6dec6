"""Change against the same key on the previous calendar day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def daily_with_delta(rows: DataFrame, keys: Sequence[str], day: str, deltas: Mapping[str, str],
                     keep: Sequence[str] | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """One row per (key, day): the maximum of each measure and its change since exactly one day earlier.

    `deltas` maps a measure to the name of its change; `carry` names measures that only get their maximum.
    Without a row on the day before, or with a null value there, the change is 0. After the daily maximum
    (with partial aggregation ahead of the shuffle) a key has at most one row per calendar day, so the window
    sees no key of more rows than there are days. A gap day is told from a neighbour by its date.
    """
    keep = list(deltas) if keep is None else list(keep)
    daily = rows.groupBy(*keys, day).agg(*[F.max(m).alias(m) for m in [*deltas, *carry]])
    before = Window.partitionBy(*keys).orderBy(day)
    adjacent = F.lag(day).over(before) == F.date_sub(F.col(day), 1)
    change = [
        (F.col(m) - F.coalesce(F.when(adjacent, F.lag(m).over(before)), F.col(m))).alias(name)
        for m, name in deltas.items()
    ]
    return daily.select(*keys, day, *keep, *carry, *change)
