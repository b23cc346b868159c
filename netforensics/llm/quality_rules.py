"""Quality rules per document and per host (operator 4).

Every document gets its counts and its rule failures. Failures are summed by host; a host's
failure rate is shrunk towards the mean of all hosts with a beta prior whose two parameters come
from the hosts themselves (method of moments), so that a host with few documents is not judged by
chance. A host is rejected if a rate stays above `limit` even `margin` posterior standard
deviations below its posterior mean; the verdict is joined back to the host's documents.

Words are runs of anything but blanks, tabs and line ends (U+0009 to U+000D). Null texts have no
words. Documents without a host (null or empty) get no host verdict.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from netforensics.session import reliable_checkpoint

from .common import free_name, only, slices, texts

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
RULES = ("short", "repetitive", "symbols", "duplicate_lines")
# Rejected hosts are broadcast up to this number of rows; beyond it the join shuffles.
BROADCAST_HOSTS = 100_000


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) > 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(number) + ids[2:]
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    twice = times[which] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(twice)] |= twice
    return int(covered.sum())


def measure(text: str) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines with a word."""
    words = text.encode().split()
    lines = text.split("\n")
    distinct = set(lines)
    blank = {line for line in distinct if not line.strip(SPACES)}
    filled = len(lines) - (sum(line in blank for line in lines) if blank else 0)
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        filled - (len(distinct) - len(blank)),
        repeated_words(words),
        filled,
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def with_counts(docs: DataFrame, into: str, text: str = "text") -> DataFrame:
    """`docs` with a struct column of COUNTS."""
    kind = pa.struct([(n, pa.int64()) for n in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        for batch in slices(batches, text):
            columns = list(zip(*map(measure, texts(batch, text)), strict=True)) or [[]] * len(COUNTS)
            yield batch.append_column(into, pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(kind)))

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(into, StructType([StructField(n, LongType()) for n in COUNTS]))]))


def failures(counts: str) -> dict[str, F.Column]:
    c = {n: F.col(f"{counts}.{n}") for n in COUNTS}
    return {
        "short": c["n_words"] < 50,
        "repetitive": 100 * c["n_repeat_words"] > 50 * c["n_words"],
        "symbols": 10 * c["n_symbols"] > c["word_chars"],
        "duplicate_lines": 10 * c["n_dup_lines"] > 3 * c["n_lines"],
    }


def base_failed(counts: str) -> F.Column:
    failed = failures(counts)
    return failed["short"] | failed["repetitive"]


def host_verdicts(measured: DataFrame, counts: str, host: str = "source", limit: float = 0.5, margin: float = 2.0) -> DataFrame:
    """Per host: documents, shrunken failure rate of each rule, rejected."""
    flags = failures(counts)
    hosts = (
        measured.where(F.length(F.col(host)) > 0)
        .select(F.col(host).alias("host"), *(f.cast("long").alias(n) for n, f in flags.items()))
        .groupBy("host")
        .agg(F.count("*").alias("n"), *(F.sum(n).alias(n) for n in RULES))
    )
    hosts = reliable_checkpoint(hosts)
    # Prior of each rule by moments: mean rate, and the variance of the rates beyond that of drawing n documents.
    stats = hosts.agg(
        *(F.expr(f"sum({r}) / sum(n)").alias(f"m_{r}") for r in RULES),
        *(F.expr(f"sum(n * pow({r} / n, 2)) / sum(n)").alias(f"q_{r}") for r in RULES),
        F.expr("count(*) / sum(n)").alias("per_document"),
    ).first()
    out = hosts
    for r in RULES:
        mean = min(max(stats[f"m_{r}"] or 0.0, 1e-6), 1 - 1e-6)
        noise = mean * (1 - mean) * (stats["per_document"] or 0.0)
        between = max((stats[f"q_{r}"] or 0.0) - mean * mean - noise, mean * (1 - mean) * 1e-4)
        strength = max(mean * (1 - mean) / between - 1, 1.0)
        rate = (F.col(r) + mean * strength) / (F.col("n") + strength)
        out = out.withColumn(f"rate_{r}", rate).withColumn(
            f"low_{r}", rate - margin * F.sqrt(rate * (1 - rate) / (F.col("n") + strength + 1))
        )
    bad = F.greatest(*(F.col(f"low_{r}") for r in RULES)) > limit
    return out.select("host", "n", *(f"rate_{r}" for r in RULES), bad.alias("rejected"))


def _join_hosts(rows: DataFrame, hosts: DataFrame, host: str, how: str) -> DataFrame:
    few = hosts.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS
    own = free_name(rows, "_host")
    side = hosts.withColumnRenamed("host", own)
    return rows.join(F.broadcast(side) if few else side, F.col(host) == F.col(own), how)


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Per row: key, the counts, base_failed, kept, host_docs and the host's shrunken rates (null without host)."""
    rows = with_counts(docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(host).alias("src")), "counts").drop("text")
    rows = reliable_checkpoint(rows)
    hosts = host_verdicts(rows, "counts", "src")
    joined = _join_hosts(rows, hosts, "src", "left")
    kept = ~base_failed("counts") & ~F.coalesce("rejected", F.lit(False))
    return joined.select(
        F.col("key").alias(key),
        *(F.col(f"counts.{n}").alias(n) for n in COUNTS[:5]),
        base_failed("counts").alias("base_failed"),
        kept.alias("kept"),
        F.col("n").alias("host_docs"),
        *(F.col(f"rate_{r}").alias(f"host_{r}") for r in RULES),
    )


def keep_good(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """`docs` without the rows that the rules or the verdict on their host reject; columns unchanged.

    Counts are taken twice, once for the hosts and once for the rows, instead of moving texts.
    """
    counts, columns = free_name(docs, "counts"), docs.columns
    hosts = host_verdicts(with_counts(docs.select(text, host), counts, text).select(host, counts), counts, host)
    rows = with_counts(docs, counts, text).where(~base_failed(counts))
    return _join_hosts(rows, hosts.where("rejected").select("host"), host, "left_anti").select(columns)


