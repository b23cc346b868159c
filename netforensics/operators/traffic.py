"""Detectors over connections: beaconing, upload volume, FTP store commands, unexplained egress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netforensics.functions.ip import is_private
from netforensics.functions.numbers import ratio, round_even
from netforensics.operators.keyed import first_per

SERVICE = ["case_id", "dst_ip", "dst_port"]


def remote_only(rows: DataFrame, allow: DataFrame | None = None) -> DataFrame:
    """Drop internal destinations, except those in `allow` (case_id, dst_ip)."""
    private = is_private(F.col("dst_ip"))
    if allow is None:
        return rows.filter(~private)
    scope = allow.select("case_id", "dst_ip").distinct().withColumn("_in_scope", F.lit(True))
    kept = rows.join(scope, ["case_id", "dst_ip"], "left").filter(~private | F.col("_in_scope"))
    return kept.select(*rows.columns)


def responded() -> Column:
    """The server replied: bytes came back or the history holds a responder event."""
    return (F.col("resp_bytes") > 0) | F.coalesce(F.col("history").rlike("[a-z]"), F.lit(False))


def upload_ratio() -> Column:
    return ratio(F.col("orig_bytes"), F.col("orig_bytes") + F.col("resp_bytes"))


def _merge_spans(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Join neighbouring time spans of the same key into one, with exact interval moments.

    A span carries its first and last time, the number of intervals inside and their summed
    squared deviation from the span's own mean. Merging adds the gaps between spans.
    """
    ordered = Window.partitionBy(*keys).orderBy("first_ts")
    whole = Window.partitionBy(*keys)
    gap = F.col("first_ts") - F.lag("last_ts").over(ordered)
    own_mean = F.when(F.col("intervals") > 0, (F.col("last_ts") - F.col("first_ts")) / F.col("intervals"))
    total = F.sum("intervals").over(whole) + F.count(F.lit(1)).over(whole) - 1
    mean = (F.max("last_ts").over(whole) - F.min("first_ts").over(whole)) / total
    shifted = F.coalesce(F.col("intervals") * F.pow(F.col("_own_mean") - F.col("_mean"), 2), F.lit(0.0))
    across = F.coalesce(F.pow(F.col("_gap") - F.col("_mean"), 2), F.lit(0.0))
    return (
        spans.withColumn("_gap", gap)
        .withColumn("_own_mean", own_mean)
        .withColumn("_mean", F.when(total > 0, mean))
        .groupBy(*keys)
        .agg(
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
            (F.sum("intervals") + F.count("_gap")).alias("intervals"),
            F.sum(F.col("deviation") + shifted + across).alias("deviation"),
            F.sum("rows").alias("rows"),
            F.sum("answered").alias("answered"),
            F.sum("size_sum").alias("size_sum"),
            F.sum("size_squares").alias("size_squares"),
        )
    )


def interval_stats(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Interval and size statistics per key without ever sorting a whole key in one task.

    Rows with the same time collapse first (zero intervals). Then spans merge per second, per
    hour and per key, so a window holds at most the distinct times of one second, 3600 seconds,
    or the hours a key is active, no matter how many rows the key has.
    """
    second = F.floor(F.col("first_ts"))
    base = rows.groupBy(*keys, "ts").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("responded").cast("bigint")).alias("answered"),
        F.sum("orig_bytes").alias("size_sum"),
        F.sum(F.pow(F.col("orig_bytes").cast("double"), 2)).alias("size_squares"),
    )
    spans = base.select(
        *keys,
        F.col("ts").alias("first_ts"),
        F.col("ts").alias("last_ts"),
        (F.col("rows") - 1).alias("intervals"),
        F.lit(0.0).alias("deviation"),
        "rows", "answered", "size_sum", "size_squares",
    )
    spans = _merge_spans(spans.withColumn("_second", second), [*keys, "_second"])
    spans = spans.withColumn("_hour", F.floor(F.col("_second") / 3600)).drop("_second")
    spans = _merge_spans(spans, [*keys, "_hour"]).drop("_hour")
    merged = _merge_spans(spans, keys)
    mean = F.when(F.col("intervals") > 0, (F.col("last_ts") - F.col("first_ts")) / F.col("intervals"))
    spread = F.when(F.col("intervals") > 0, F.sqrt(F.col("deviation") / F.col("intervals")))
    mean_size = F.col("size_sum") / F.col("rows")
    size_spread = F.sqrt(
        F.greatest(F.col("size_squares") / F.col("rows") - mean_size * mean_size, F.lit(0.0))
    )
    return merged.select(
        *keys,
        F.col("rows").alias("connection_count"),
        mean.alias("mean_interval"),
        spread.alias("interval_stddev"),
        F.when(mean > 0, spread / mean).otherwise(F.lit(1.0)).alias("jitter"),
        F.when(mean_size > 0, size_spread / mean_size).otherwise(F.lit(0.0)).alias("size_variation"),
        "answered",
    )


def detect_beaconing(
    conns: DataFrame,
    min_count: int = 4,
    max_jitter_ratio: float = 0.25,
    min_interval_s: float = 1.0,
    allow: DataFrame | None = None,
) -> DataFrame:
    """Periodic callbacks per (case, destination, port); one verdict row per busy destination."""
    rows = remote_only(conns, allow).select(*SERVICE, "ts", "orig_bytes", responded().alias("responded"))
    stats = interval_stats(rows, SERVICE).filter(F.col("connection_count") >= min_count)
    beacon = (F.col("jitter") <= max_jitter_ratio) & (F.col("mean_interval") >= min_interval_s)
    unanswered = F.col("is_beacon") & (F.col("answered") == 0)
    raw = (
        (1 - F.col("jitter") / max_jitter_ratio) * 0.55
        + F.least(F.col("connection_count") / 10.0, F.lit(1.0)) * 0.35
        + F.when(F.col("size_variation") < 0.1, 0.10).otherwise(0.0)
    )
    capped = F.least(raw, F.when(F.col("unanswered"), 0.3).otherwise(1.0))
    return (
        stats.withColumn("is_beacon", beacon)
        .withColumn("unanswered", unanswered)
        .select(
            *SERVICE,
            "connection_count",
            round_even(F.col("mean_interval"), 2).alias("mean_interval_s"),
            round_even(F.col("interval_stddev"), 3).alias("interval_stddev_s"),
            round_even(F.col("jitter"), 3).alias("jitter_ratio"),
            "is_beacon",
            round_even(F.when(F.col("is_beacon"), capped).otherwise(0.0), 2).alias("confidence"),
            round_even(F.col("size_variation"), 3).alias("size_cv"),
            round_even(F.col("answered") / F.col("connection_count"), 2).alias("handshake_ratio"),
            "unanswered",
        )
    )


def detect_exfil(
    conns: DataFrame,
    min_upload_bytes: int = 1024,
    min_upload_ratio: float = 0.7,
    min_raw_upload_bytes: int | None = None,
    allow: DataFrame | None = None,
) -> DataFrame:
    """Large POSTs and upload-heavy connections; one row per qualifying connection."""
    raw_limit = min_upload_bytes if min_raw_upload_bytes is None else min_raw_upload_bytes
    post = F.coalesce(F.col("http_method") == "POST", F.lit(False))
    big_post = post & (F.col("orig_bytes") >= min_upload_bytes)
    enough = F.col("orig_bytes") >= F.when(post, min_upload_bytes).otherwise(raw_limit)
    one_sided = F.col("_ratio") >= min_upload_ratio
    confidence = 0.5 + F.when(big_post, 0.3).otherwise(0.0) + F.when(one_sided, 0.2).otherwise(0.0)
    return (
        remote_only(conns, allow)
        .withColumn("_ratio", upload_ratio())
        .filter(big_post | (enough & one_sided))
        .select(
            "case_id", "seq", "src_ip", "dst_ip", "dst_port", "orig_bytes",
            round_even(F.col("_ratio"), 2).alias("upload_ratio"),
            "http_method", "http_uri",
            F.lit(True).alias("is_exfil"),
            round_even(F.least(confidence, F.lit(1.0)), 2).alias("confidence"),
        )
    )


def detect_ftp_exfil(conns: DataFrame, allow: DataFrame | None = None) -> DataFrame:
    """Destinations that received an FTP store command, first command per destination."""
    rows = (
        remote_only(conns.filter(F.col("ftp_upload_cmd").isNotNull() & (F.col("ftp_upload_cmd") != "")), allow)
        .select("case_id", "dst_ip", "seq", "src_ip", "dst_port", "orig_bytes", "resp_bytes", "ftp_upload_cmd")
    )
    return first_per(rows, ["case_id", "dst_ip"]).select(
        "case_id", "seq", "src_ip", "dst_ip", "dst_port", "orig_bytes",
        round_even(upload_ratio(), 2).alias("upload_ratio"),
        F.lit("FTP").alias("http_method"),
        F.col("ftp_upload_cmd").alias("http_uri"),
        F.lit(True).alias("is_exfil"),
        F.lit(0.8).alias("confidence"),
    )


def merge_exfil(volume: DataFrame, ftp: DataFrame) -> DataFrame:
    """Volume verdicts plus the FTP verdicts of services the volume rule did not report."""
    known = volume.select("case_id", "dst_ip", "dst_port").distinct()
    return volume.unionByName(ftp.join(known, SERVICE, "left_anti"))


def detect_unclassified_egress(
    conns: DataFrame,
    covered: DataFrame | None,
    min_bytes: int = 2048,
    min_ratio: float = 0.6,
    allow: DataFrame | None = None,
) -> DataFrame:
    """Upload-heavy services no other detector explained, first connection per service.

    Without `covered` the caller drops the explained ones.
    """
    rows = (
        remote_only(conns, allow)
        .withColumn("_ratio", upload_ratio())
        .filter((F.col("orig_bytes") >= min_bytes) & (F.col("_ratio") >= min_ratio))
        .select(*SERVICE, "seq", "orig_bytes", "_ratio")
    )
    if covered is not None:
        rows = rows.join(covered.select("case_id", "dst_ip").distinct(), ["case_id", "dst_ip"], "left_anti")
    return first_per(rows, SERVICE).select(
        *SERVICE, "seq", "orig_bytes", round_even(F.col("_ratio"), 2).alias("upload_ratio")
    )
