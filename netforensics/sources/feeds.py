"""Threat-intelligence feeds and the indicator table.

Parsers take lines (value, seq) and give (value, source, note, indicator_type, last_seen, seq).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netforensics.functions.ip import is_ip_literal
from netforensics.functions.lookup import seed_frame
from netforensics.functions.text import url_host
from netforensics.operators.dns import has_parent_in
from netforensics.vocab import (
    DEMO_INDICATORS, FEED_SELF, KNOWN_BAD_JA3, KNOWN_BAD_JA4, MIN_INDICATORS, SHARED_HOSTING,
)

COLUMNS = ["value", "source", "note", "indicator_type", "last_seen", "seq"]


def _content(lines: DataFrame) -> DataFrame:
    line = F.trim("value")
    return lines.withColumn("_line", line).filter((F.col("_line") != "") & ~F.col("_line").startswith("#"))


def _unquoted(part: Column) -> Column:
    return F.btrim(F.trim(part), F.lit('"'))


def parse_feodo(lines: DataFrame) -> DataFrame:
    """Botnet C2 address list; rows whose second field is not an address are headers or noise."""
    parts = F.split("_line", ",")
    rows = _content(lines).filter(F.size(parts) >= 6).select(
        "seq", _unquoted(parts[0]).alias("last_seen"), _unquoted(parts[1]).alias("value"),
        _unquoted(parts[2]).alias("port"), _unquoted(parts[5]).alias("malware"),
    )
    return rows.filter(is_ip_literal(F.col("value"))).select(
        "value", F.lit("abuse.ch/FeodoTracker").alias("source"),
        F.concat("malware", F.lit(" C2 (port "), "port", F.lit(")")).alias("note"),
        F.lit("ip").alias("indicator_type"), "last_seen", "seq",
    )


def parse_urlhaus(lines: DataFrame) -> DataFrame:
    """Payload URL list reduced to hosts; the provider itself and shared hosting are left out."""
    parts = F.split("_line", ",")
    rows = _content(lines).filter(F.size(parts) >= 7).select(
        "seq", _unquoted(parts[0]).alias("id"), _unquoted(parts[1]).alias("last_seen"),
        _unquoted(parts[2]).alias("url"), _unquoted(parts[5]).alias("threat"), _unquoted(parts[6]).alias("tags"),
    )
    rows = rows.filter(~F.lower("id").isin("id", "#id") & (F.lower("url") != "url"))
    host = F.rtrim(F.lower(F.trim(F.coalesce(url_host(F.col("url")), F.col("url")))), F.lit("."))
    rows = rows.withColumn("value", host).filter(F.col("value") != "").withColumn(
        "indicator_type", F.when(is_ip_literal(F.col("value")), "ip").otherwise("domain")
    )
    shared = (F.col("indicator_type") == "domain") & has_parent_in(F.col("value"), SHARED_HOSTING)
    note = F.when(F.col("tags") != "", F.concat("threat", F.lit(" ("), "tags", F.lit(")"))).otherwise(F.col("threat"))
    return rows.filter(~has_parent_in(F.col("value"), FEED_SELF) & ~shared).select(
        "value", F.lit("abuse.ch/URLhaus").alias("source"), note.alias("note"), "indicator_type", "last_seen", "seq"
    )


def parse_threatfox(lines: DataFrame) -> DataFrame:
    """C2 indicators by family; the port of an address goes into the note."""
    schema = ", ".join(f"c{i} string" for i in range(16))
    row = F.from_csv(F.regexp_replace("value", r'(,)\s+"', '$1"'), schema, {"sep": ",", "quote": '"', "escape": '"'})
    # A generator parses each line once; field access on from_csv would parse once per field.
    content = lines.filter((F.trim("value") != "") & ~F.ltrim("value").startswith("#"))
    rows = content.select("seq", "value", F.inline(F.array(row)))

    def part(i: int) -> Column:
        return F.btrim(F.coalesce(F.col(f"c{i}"), F.lit("")), F.lit('" '))

    rows = rows.filter(F.col("c7").isNotNull() | (F.size(F.split("value", ",")) >= 8)).select(
        "seq", part(0).alias("last_seen"), part(2).alias("raw"), F.lower(part(3)).alias("ioc_type"),
        F.when(part(7) != "", part(7)).when(part(5) != "", part(5)).otherwise("unknown").alias("family"),
    )
    rows = rows.filter((F.col("raw") != "") & (F.lower("raw") != "ioc_value"))
    with_port = F.col("ioc_type").isin("ip:port", "ip_port") & F.col("raw").contains(":")
    kind = (
        F.when(with_port, "ip").when(F.col("ioc_type").isin("domain", "hostname"), "domain")
        .when(is_ip_literal(F.col("raw")), "ip")
    )
    port = F.when(with_port, F.substring_index("raw", ":", -1))
    address = F.when(
        with_port, F.substr("raw", F.lit(1), F.length("raw") - F.length(F.substring_index("raw", ":", -1)) - 1)
    ).otherwise(F.col("raw"))
    rows = rows.select(
        "seq", "last_seen", "family", kind.alias("indicator_type"), port.alias("port"),
        F.lower(F.rtrim(F.trim(address), F.lit("."))).alias("value"),
    ).filter(F.col("indicator_type").isNotNull() & (F.col("value") != ""))
    domain = F.col("indicator_type") == "domain"
    keep = F.when(domain, ~has_parent_in(F.col("value"), SHARED_HOSTING + FEED_SELF)).otherwise(
        is_ip_literal(F.col("value"))
    )
    suffix = F.when(
        F.coalesce("port", F.lit("")) != "", F.concat(F.lit(" (port "), "port", F.lit(")"))
    ).otherwise(F.lit(""))
    return rows.filter(keep).select(
        "value", F.lit("abuse.ch/ThreatFox").alias("source"),
        F.concat("family", F.lit(" C2"), suffix).alias("note"), "indicator_type", "last_seen", "seq",
    )


def parse_indicator_list(lines: DataFrame, kind: Column | str = "domain", source: Column | str = "custom") -> DataFrame:
    """One indicator per line."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    source = F.lit(source) if isinstance(source, str) else source
    value = F.lower(_unquoted(F.substring_index("_line", ",", 1)))
    return (
        _content(lines)
        .withColumn("_kind", kind)
        .withColumn("_source", source)
        .withColumn("_value", value)
        .filter(F.col("_value") != "")
        .select(
            F.col("_value").alias("value"), F.col("_source").alias("source"),
            F.concat("_kind", F.lit(" blocklist")).alias("note"), F.col("_kind").alias("indicator_type"),
            F.lit(None).cast("string").alias("last_seen"), "seq",
        )
    )


def known_fingerprints(spark: SparkSession) -> DataFrame:
    """Built-in known-bad JA3 and JA4 fingerprints."""
    rows = [(v, "known_bad_ja3", d, "ja3", None, i) for i, (v, d) in enumerate(KNOWN_BAD_JA3)]
    rows += [(v, "known_bad_ja4", d, "ja4", None, i) for i, (v, d) in enumerate(KNOWN_BAD_JA4)]
    return seed_frame(
        spark, rows, "value string, source string, note string, indicator_type string, last_seen string, seq bigint"
    )


def demo_indicators(spark: SparkSession) -> DataFrame:
    """Seed addresses of the reference samples; any feed entry replaces them."""
    rows = [(v, s, n, "ip", None, i) for i, (v, s, n) in enumerate(DEMO_INDICATORS)]
    return seed_frame(
        spark, rows, "value string, source string, note string, indicator_type string, last_seen string, seq bigint"
    )


def feed_kind(file_name: Column) -> Column:
    """Feed format by file name, NULL when the name is not a feed."""
    name = F.lower(file_name)
    return (
        F.when(name.startswith("threatfox"), "threatfox")
        .when(name.startswith("feodo"), "feodo")
        .when(name.startswith("urlhaus"), "urlhaus")
        .when(name.contains("dga") | name.contains("domain"), "domain")
        .when(name.contains("ja4"), "ja4")
        .when(name.contains("ja3"), "ja3")
    )


def parse_feeds(lines: DataFrame) -> DataFrame:
    """Indicators of many feed files: lines (file_name, seq, value), each by its own format."""
    tagged = lines.withColumn("_feed", feed_kind(F.col("file_name"))).filter(F.col("_feed").isNotNull())
    parts = []
    for kind, parser in (("threatfox", parse_threatfox), ("feodo", parse_feodo), ("urlhaus", parse_urlhaus)):
        chosen = tagged.filter(F.col("_feed") == kind)
        # The file name rides along in seq so that later files replace earlier ones.
        parts.append(parser(chosen.withColumn("seq", F.struct("file_name", "seq"))))
    plain = tagged.filter(F.col("_feed").isin("domain", "ja3", "ja4")).withColumn("seq", F.struct("file_name", "seq"))
    source = F.when(F.col("_feed") == "domain", "feed/dga").otherwise(F.concat(F.lit("feed/"), F.col("_feed")))
    parts.append(parse_indicator_list(plain, F.col("_feed"), source))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def merge_indicators(*sources: DataFrame) -> DataFrame:
    """One row per value: later sources and, inside a source, later rows win."""
    packed = None
    for rank, source in enumerate(sources):
        part = source.select(
            "value", F.lit(rank).alias("rank"), "seq", *[c for c in COLUMNS if c not in ("value", "seq")]
        )
        best = part.groupBy("value").agg(
            F.max(F.struct("rank", "seq", "source", "note", "indicator_type", "last_seen")).alias("r")
        ).select("value", "r.rank", "r.source", "r.note", "r.indicator_type", "r.last_seen")
        packed = best if packed is None else packed.unionByName(best)
    return (
        packed.groupBy("value")
        .agg(F.max(F.struct("rank", "source", "note", "indicator_type", "last_seen")).alias("r"))
        .select("value", "r.source", "r.note", "r.indicator_type", "r.last_seen")
    )


def refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The indicator table from every recognised feed file of a folder plus the built-in seeds."""
    raw = spark.read.text(folder).select("value", "_metadata.file_name", "_metadata.file_block_start")
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    lines = raw.select("file_name", (F.col("file_block_start") + row).alias("seq"), "value")
    return merge_indicators(demo_indicators(spark), known_fingerprints(spark), parse_feeds(lines))


def indicator_counts(intel: DataFrame) -> DataFrame:
    """Indicators per type; an untyped one counts as an address."""
    return intel.groupBy(F.coalesce("indicator_type", F.lit("ip")).alias("indicator_type")).agg(
        F.count(F.lit(1)).alias("indicators")
    )


def indicator_guard(intel: DataFrame, minimum: int = MIN_INDICATORS) -> DataFrame:
    """One row (indicators, minimum, enough): whether the table is large enough to be a complete one."""
    return intel.agg(F.count(F.lit(1)).alias("indicators")).select(
        "indicators", F.lit(minimum).alias("minimum"), (F.col("indicators") >= minimum).alias("enough")
    )


def require_indicators(intel: DataFrame, minimum: int = MIN_INDICATORS) -> int:
    """Raise when the table is suspiciously small; a broken feed must not look like a clean one."""
    found = indicator_guard(intel, minimum).first()
    if not found["enough"]:
        raise ValueError(f"only {found['indicators']} indicators, expected at least {minimum}")
    return found["indicators"]
