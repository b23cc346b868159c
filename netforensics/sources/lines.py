"""Text lines with their place in the file, and small JSON documents, as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def case_from_path(path: Column) -> Column:
    """The name of the folder that holds the file, or holds the folder log=... that does (see `sources.cases`).

    It is worked out for every line, so the pattern is only tried on the end of the path.
    """
    end = F.substring_index(path, "/", -3)
    return F.regexp_extract(end, r"(?:^|/)(?:case_id=)?([^/]+)/(?:log=[^/]+/)?[^/]+$", 1)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(case_id, file, seq, value): lines of splittable text files in file order.

    seq is the byte offset of the split plus the row's place in its task. A split of n bytes has
    at most n lines, so positions of consecutive splits of one file never cross.
    """
    raw = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return raw.select(
        case_from_path(F.col("file_path")).alias("case_id"),
        F.col("file_path").alias("file"),
        (F.col("file_block_start") + row).alias("seq"),
        "value",
    )


def read_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(case_id, file, raw): one row per small document such as a manifest."""
    raw = spark.read.option("wholetext", True).text(path).select("value", "_metadata.file_path")
    return raw.select(
        case_from_path(F.col("file_path")).alias("case_id"), F.col("file_path").alias("file"), F.col("value").alias("raw")
    )
