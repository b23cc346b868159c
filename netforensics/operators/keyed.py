"""First and last row per key as plain aggregates.

A row_number() window would bring every row of a hot key into one task; a min or max over a
struct combines on the map side, so only one row per key and task is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], smallest: bool) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*order, *rest)
    chosen = F.min(packed) if smallest else F.max(packed)
    return (
        df.groupBy(*keys)
        .agg(chosen.alias("_row"))
        .select(*keys, *[F.col("_row").getField(c).alias(c) for c in [*order, *rest]])
        .select(*df.columns)
    )


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("seq",)) -> DataFrame:
    """The first row per key in `order`; ties fall to the remaining columns in table order."""
    return _pick(df, keys, order, smallest=True)


def last_per(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("seq",)) -> DataFrame:
    """The last row per key in `order`."""
    return _pick(df, keys, order, smallest=False)


def unmatched_key(value: Column, row_id: Column) -> Column:
    """A join key in which NULLs are spread out and can never match the other side."""
    return F.coalesce(value, F.concat(F.lit("\u0000"), row_id.cast("string")))
