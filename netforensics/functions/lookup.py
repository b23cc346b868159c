"""Fixed lookup tables as Columns or seed DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netforensics.vocab import TIER_RANK


def literals(values: Iterable) -> Column:
    return F.array(*[F.lit(v) for v in values])


def mapped(key: Column, table: Mapping) -> Column:
    """Value of `key` in a fixed table, NULL when absent."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def tier_rank(tier: Column) -> Column:
    """Rank of a tier; an unknown tier counts as weak."""
    return F.coalesce(mapped(tier, TIER_RANK), F.lit(TIER_RANK["weak"]))


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def seed_frame(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A fixed table written in the source code; its size is known, so it may be broadcast."""
    fields = [f.strip().rsplit(" ", 1) for f in schema.split(",")]
    rows = list(rows)
    casts = ", ".join(f"CAST(`{n}` AS {t}) AS `{n}`" for n, t in fields)
    names = ", ".join(f"`{n}`" for n, _ in fields)
    if not rows:
        nulls = ", ".join(f"CAST(NULL AS {t}) AS `{n}`" for n, t in fields)
        return F.broadcast(spark.sql(f"SELECT {nulls} WHERE false"))
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return F.broadcast(spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({names})"))
