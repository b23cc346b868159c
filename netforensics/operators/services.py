"""Detectors over HTTP, SMTP, ICMP and named services."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netforensics.functions.lookup import literals, mapped
from netforensics.functions.numbers import round_even
from netforensics.functions.text import clean_name, name_suffixes
from netforensics.operators.keyed import first_per, last_per
from netforensics.vocab import (
    CLOUD_CONFIDENCE, CLOUD_SERVICES, GATE_PATTERNS, HTTP_PORTS, SUSPICIOUS_AGENTS, TLS_PORTS,
)


def match_service(host):
    """Position (1-based) of the first listed cloud service the host belongs to, else NULL."""
    position = {domain: i for i, (domain, _, _) in enumerate(CLOUD_SERVICES, start=1)}
    ranks = F.transform(name_suffixes(clean_name(host)), lambda s: mapped(s, position))
    return F.array_min(ranks)


def detect_cloud_exfil(tls: DataFrame, http: DataFrame, sessions: DataFrame) -> DataFrame:
    """Known cloud services by SNI or Host with risk and direction; one row per (dst, host)."""
    endpoint = ["case_id", "src_ip", "dst_ip", "dst_port"]
    seen = (
        tls.select(*endpoint, F.col("server_name").alias("host"), F.lit(0).alias("source"), "seq")
        .unionByName(http.select(*endpoint, "host", F.lit(1).alias("source"), "seq"))
        .filter(F.col("host").isNotNull() & (F.col("host") != ""))
        .withColumn("service_no", match_service(F.col("host")))
        .filter(F.col("service_no").isNotNull())
    )
    chosen = first_per(seen, ["case_id", "dst_ip", "host"], ["source", "seq"])
    # Last session bytes, only for the endpoints at hand.
    traffic = last_per(
        sessions.select(*endpoint, "seq", "orig_bytes", "resp_bytes").join(
            chosen.select(*endpoint).distinct(), endpoint, "left_semi"
        ),
        endpoint,
    ).drop("seq")
    sent = F.coalesce(F.col("orig_bytes"), F.lit(0))
    received = F.coalesce(F.col("resp_bytes"), F.lit(0))
    upload = (sent > received * 1.2) & (sent > 0)
    download = received > sent
    names = literals(name for _, name, _ in CLOUD_SERVICES)
    risks = literals(risk for _, _, risk in CLOUD_SERVICES)
    return chosen.join(traffic, endpoint, "left").select(
        "case_id", "source", "seq",
        F.element_at(names, F.col("service_no")).alias("service"),
        F.element_at(risks, F.col("service_no")).alias("risk"),
        F.col("host").alias("domain"),
        "dst_ip", "dst_port",
        F.when(upload, "upload").when(download, "download").otherwise("unknown").alias("direction"),
        F.when(~upload & download, "cloud_staging").otherwise("cloud_exfil").alias("category"),
        mapped(F.element_at(risks, F.col("service_no")), CLOUD_CONFIDENCE).alias("confidence"),
    )


def detect_smtp_exfil(smtp: DataFrame) -> DataFrame:
    """Outbound mail envelopes, graded by attachment and self-send."""
    sender = F.lower(F.coalesce("mail_from", F.lit("")))
    attached = F.size(F.coalesce("attachments", F.array().cast("array<string>"))) > 0
    recipients = F.coalesce("rcpt_to", F.array().cast("array<string>"))
    self_send = (sender != "") & F.exists(recipients, lambda r: F.lower(r) == sender)
    score = 0.6 + F.when(attached, 0.15).otherwise(0.0) + F.when(self_send, 0.15).otherwise(0.0)
    return smtp.filter((sender != "") | (F.size(recipients) > 0)).select(
        "case_id", "seq", "dst_ip", "mail_from",
        recipients.alias("rcpt_to"),
        "subject",
        attached.alias("has_attachment"),
        F.coalesce(self_send, F.lit(False)).alias("self_send"),
        round_even(F.least(score, F.lit(1.0)), 2).alias("confidence"),
    )


def detect_http_exfil(http: DataFrame) -> DataFrame:
    """Gate URIs (strong) and suspicious user agents (weak), first per (dst, uri)."""
    uri = F.coalesce("uri", F.lit(""))
    gate = uri.rlike("(?i)" + "|".join(GATE_PATTERNS))
    agent = F.col("user_agent").isNotNull() & F.lower(F.trim("user_agent")).isin(SUSPICIOUS_AGENTS)
    reason = F.concat_ws(
        "; ",
        F.when(gate, F.concat(F.lit("C2 gate pattern in URI ("), F.substr(uri, F.lit(1), F.lit(48)), F.lit(")"))),
        F.when(agent, F.concat(F.lit("suspicious/hardcoded user-agent ('"), F.col("user_agent"), F.lit("')"))),
    )
    hits = http.filter(gate | agent).select(
        "case_id", "dst_ip", uri.alias("_uri_key"), "seq", "dst_port", "host", "uri", "method",
        reason.alias("reason"),
        F.when(gate, "strong").otherwise("weak").alias("severity"),
        F.when(gate, 0.7).otherwise(0.45).alias("confidence"),
    )
    return first_per(hits, ["case_id", "dst_ip", "_uri_key"]).drop("_uri_key")


def detect_icmp_tunnel(icmp: DataFrame, min_packets: int = 8, min_avg_payload: int = 64) -> DataFrame:
    """Destinations with many oversized ICMP echoes."""
    stats = icmp.groupBy("case_id", "dst_ip").agg(
        F.count(F.lit(1)).alias("packets"), F.avg("data_len").alias("mean_len"), F.min("seq").alias("seq")
    )
    return stats.filter((F.col("packets") >= min_packets) & (F.col("mean_len") >= min_avg_payload)).select(
        "case_id", "seq",
        F.lit("icmp_tunnel").alias("kind"),
        "dst_ip",
        F.lit(0).alias("dst_port"),
        F.format_string(
            "%d ICMP echoes, avg payload %sB (normal ping ~32-48B)",
            F.col("packets"), F.rint("mean_len").cast("bigint").cast("string"),
        ).alias("detail"),
        F.lit(0.75).alias("confidence"),
        F.lit("strong").alias("severity"),
    )


def detect_port_mismatch(http: DataFrame, tls: DataFrame) -> DataFrame:
    """HTTP or TLS on a non-standard port, HTTP first, one row per (dst, port)."""
    odd = (
        http.filter(~F.col("dst_port").isin(HTTP_PORTS))
        .select("case_id", "dst_ip", "dst_port", F.lit(0).alias("source"), "seq")
        .unionByName(
            tls.filter(~F.col("dst_port").isin(TLS_PORTS)).select(
                "case_id", "dst_ip", "dst_port", F.lit(1).alias("source"), "seq"
            )
        )
    )
    protocol = F.when(F.col("source") == 0, "HTTP").otherwise("TLS")
    return first_per(odd, ["case_id", "dst_ip", "dst_port"], ["source", "seq"]).select(
        "case_id", "source", "seq",
        F.lit("port_mismatch").alias("kind"),
        "dst_ip", "dst_port",
        F.concat(protocol, F.lit(" on non-standard port "), F.col("dst_port").cast("string")).alias("detail"),
        F.lit(0.4).alias("confidence"),
        F.lit("weak").alias("severity"),
    )
