"""Provenance records, the kill-chain timeline and family verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netforensics.functions.lookup import mapped
from netforensics.functions.numbers import iso_utc
from netforensics.functions.rules import phase, provenance_statement, technique
from netforensics.operators.joins import allowlist_lookup, lookup_domains, lookup_indicators
from netforensics.operators.keyed import first_per
from netforensics.vocab import EXFIL_PROTOCOL, FAMILY_KEYWORDS, FAMILY_RANK, ITEM_TYPE, OTP_WORDS

DESCRIPTORS = ["http_uri", "smtp_subject", "cloud_service", "dns_evidence", "cert_reason", "covert_detail"]


def _optional(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _first_filled(columns: list[Column]) -> Column:
    return F.coalesce(*[F.when(c != "", c) for c in columns])


# --- provenance -----------------------------------------------------------------------


def build_provenance(
    correlated: DataFrame, findings: DataFrame, artifacts: DataFrame | None = None,
    allow_domains: DataFrame | None = None, allow_cidrs: DataFrame | None = None,
) -> DataFrame:
    """One record per link: what was taken, how, where to, and the recovered content if any."""
    described = findings.select(
        "case_id", F.coalesce("dst_ip", F.lit("")).alias("destination_ip"), "dst_port", "finding_no", "kind",
        "destination_domain", "plaintext_available",
        _first_filled([_optional(findings, c) for c in DESCRIPTORS]).alias("evidence"),
    )
    service = ["case_id", "destination_ip", "destination_port"]
    by_service = first_per(described.withColumnRenamed("dst_port", "destination_port"), service, ["finding_no"])
    by_ip = first_per(described.drop("dst_port"), ["case_id", "destination_ip"], ["finding_no"])

    def packed(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
        detail = F.struct("kind", "destination_domain", "plaintext_available", "evidence")
        return rows.select(*keys, detail.alias(name))

    if artifacts is None:
        artifacts = correlated.sparkSession.sql(
            "SELECT CAST(NULL AS STRING) case_id, CAST(NULL AS BIGINT) seq, CAST(NULL AS STRING) dest_ip, "
            "CAST(NULL AS BIGINT) total_bytes, CAST(NULL AS STRING) sha256, CAST(NULL AS STRING) preview WHERE false"
        )
    largest = (
        artifacts.select(
            "case_id", F.col("dest_ip").alias("destination_ip"), (-F.col("total_bytes")).alias("_neg"), "seq",
            "total_bytes", "sha256", "preview",
        )
        .groupBy("case_id", "destination_ip")
        .agg(F.min(F.struct("_neg", "seq", "total_bytes", "sha256", "preview")).alias("art"))
    )
    net = F.coalesce("_svc", "_ip")
    joined = (
        correlated.withColumn("_out_ip", F.col("destination_ip"))
        .withColumn("destination_ip", F.coalesce("destination_ip", F.lit("")))
        .join(packed(by_service, service, "_svc"), service, "left")
        .join(packed(by_ip, ["case_id", "destination_ip"], "_ip"), ["case_id", "destination_ip"], "left")
        .join(largest, ["case_id", "destination_ip"], "left")
        .withColumn("_net", net)
        .withColumn("destination_domain", F.col("_net.destination_domain"))
        .withColumn("destination_ip", F.col("_out_ip"))
    )
    looked = allowlist_lookup(joined, allow_domains, allow_cidrs, ip_column="destination_ip")
    base = F.coalesce(mapped(F.col("data_type_accessed"), ITEM_TYPE), F.col("data_type_accessed"))
    evidence = F.col("_net.evidence")
    names_otp = F.lower(evidence).rlike("|".join(OTP_WORDS))
    item = F.when(base.isin("clipboard_data", "keystroke_log") & names_otp, "otp").otherwise(base)
    tier = F.when(
        (F.col("confidence_tier") == "weak") & F.col("allowlist_match").isNotNull(), "allowlisted"
    ).otherwise(F.col("confidence_tier"))
    kind = F.coalesce("_net.kind", F.lit("exfil"))
    return (
        looked.select(
            "case_id", "access_seq", item.alias("item_type"), "data_type_accessed",
            F.col("access_api_call").alias("accessed_via"), F.col("access_ts").alias("accessed_at"),
            "destination_ip", "destination_port", "destination_domain",
            F.coalesce(mapped(kind, EXFIL_PROTOCOL), F.lit("unknown")).alias("exfil_protocol"),
            F.col("network_ts").alias("exfiltrated_at"), "time_delta_s", evidence.alias("evidence"),
            (~F.coalesce(F.col("_net.plaintext_available"), F.lit(False))).alias("inferred"),
            tier.alias("confidence_tier"),
            F.coalesce("art.total_bytes", F.lit(0).cast("bigint")).alias("recovered_bytes"),
            F.col("art.sha256").alias("recovered_sha256"), F.col("art.preview").alias("recovered_preview"),
            "accessed_object",
        )
        .withColumn("statement", provenance_statement())
    )


# --- timeline -------------------------------------------------------------------------------


def build_timeline(access: DataFrame, findings: DataFrame) -> DataFrame:
    """Host and network rows of a case with phase and description.

    Rows carry event_time and position; write them range-partitioned by (case_id, event_time),
    or use `ordered_timeline`.
    """
    host = access.select(
        "case_id", F.col("ts").alias("event_time"), F.lit(0).alias("part"),
        F.struct(F.lit(0).alias("kind_rank"), F.col("seq"), F.lit("").alias("name")).alias("position"),
        F.col("raw_timestamp").alias("timestamp"), F.lit("host").alias("actor"),
        phase(F.col("mitre_technique"), "collection").alias("phase"), F.col("mitre_technique").alias("mitre"),
        F.concat(F.lit("host accessed "), "data_type", F.lit(" via "), "api_call").alias("description"),
        F.lit(None).cast("string").alias("tier"),
    )
    static = F.col("kind") == "static_ioc"
    who = _first_filled([F.col("destination_domain"), F.col("dst_ip")])
    who = F.coalesce(who, F.lit("unknown"))
    detail = _first_filled(
        [_optional(findings, c) for c in ("http_reason", "dns_evidence", "cloud_service", "covert_detail", "smtp_subject")]
    )
    extra = F.when(detail.isNotNull(), F.concat(F.lit(" ("), detail, F.lit(")"))).otherwise("")
    network = findings.select(
        "case_id", "event_time", F.lit(1).alias("part"), F.col("finding_no").alias("position"),
        iso_utc(F.col("event_time")).alias("timestamp"),
        F.when(static, "static").otherwise("network").alias("actor"),
        F.when(static, "c2-indicator").otherwise(phase(technique(F.col("kind")), "exfiltration")).alias("phase"),
        technique(F.col("kind")).alias("mitre"),
        F.when(static, F.concat(F.lit("C2 in binary, not observed on network: "), who))
        .otherwise(F.concat(F.col("kind"), F.lit(" to "), who, extra)).alias("description"),
        F.col("confidence_tier").alias("tier"),
    )
    return host.unionByName(network)


def ordered_timeline(timeline: DataFrame) -> DataFrame:
    """Global order by case and time; rows without a readable time come last in their case."""
    return timeline.orderBy("case_id", F.col("event_time").asc_nulls_last(), "part", "position")


# --- families ---------------------------------------------------------------------------------


def intel_texts(findings: DataFrame, intel: DataFrame) -> DataFrame:
    """Distinct (case_id, text): notes on findings and notes looked up for hit destinations."""
    own = findings.select(
        "case_id",
        F.explode(
            F.array_compact(
                F.array(*[_optional(findings, c) for c in ("static_match", "static_note", "reputation_note", "dns_evidence")])
            )
        ).alias("text"),
    )
    hits = findings.filter(F.col("reputation_hit"))
    address = first_per(
        hits.filter(F.col("dst_ip") != "").select(
            "case_id", "dst_ip", "finding_no", F.col("ja3_hash").alias("ja3"), "ja4"
        ),
        ["case_id", "dst_ip"], ["finding_no"],
    )
    by_ip = lookup_indicators(address, intel).select("case_id", F.col("reputation_note").alias("text"))
    names = hits.filter(F.col("destination_domain") != "").select("case_id", "destination_domain").distinct()
    by_name = lookup_domains(names, intel).select("case_id", F.col("domain_note").alias("text"))
    return own.unionByName(by_ip).unionByName(by_name).filter(F.col("text") != "").distinct()


def behavioural_families(findings: DataFrame) -> DataFrame:
    """Families whose channel combination a case shows."""
    def has(test: Column) -> Column:
        return F.max(F.coalesce(test, F.lit(False)).cast("int")) == 1

    uri, subject = F.lower(_optional(findings, "http_uri")), F.lower(_optional(findings, "smtp_subject"))
    case = findings.groupBy("case_id").agg(
        has(F.col("kind").isin("dns_tunnel", "dga")).alias("dns"),
        (has(F.col("kind") == "http_c2") & has(F.col("kind") == "beacon")).alias("gate"),
        (
            has(F.col("kind") == "smtp_exfil") | has(uri.contains("pw_")) | has(uri.contains("stor pw"))
            | has(subject.contains("pc name"))
        ).alias("mail"),
    )

    def verdict(test: str, family: str, text: str) -> Column:
        return F.when(F.col(test), F.struct(F.lit(family).alias("family"), F.lit(text).alias("evidence")))

    found = F.array_compact(
        F.array(
            verdict("dns", "dnscat2", "DNS tunnelling (TXT/MX/CNAME, high-entropy subdomains)"),
            verdict("gate", "Cobalt Strike", "HTTP C2 gate + periodic beacon"),
            verdict("mail", "AgentTesla", "credential/system-info exfil over SMTP/FTP"),
        )
    )
    return case.select("case_id", F.explode(found).alias("v")).select("case_id", "v.family", "v.evidence")


def attribute_family(findings: DataFrame, intel: DataFrame, static_families: DataFrame | None = None) -> DataFrame:
    """Family verdicts per case: static (confirmed), intelligence text (likely), behaviour (possible).

    One row per (case, family, evidence) with the verdict the evidence supports; `family_verdicts`
    folds it to one row per family.
    """
    words = [(k, f) for f, keys in FAMILY_KEYWORDS.items() for k in keys]
    pattern = "|".join(k for k, _ in words)
    texts = intel_texts(findings, intel).filter(F.lower("text").rlike(pattern))
    matches = F.array_distinct(
        F.array_compact(F.array(*[F.when(F.lower("text").contains(k), F.lit(f)) for k, f in words]))
    )
    rows = texts.select(
        "case_id", F.explode(matches).alias("family"), F.lit("likely").alias("confidence"),
        F.lit("threat_intel").alias("basis"), F.concat(F.lit("threat-intel note: "), "text").alias("evidence"),
    ).unionByName(
        behavioural_families(findings).select(
            "case_id", "family", F.lit("possible").alias("confidence"), F.lit("behavioural").alias("basis"), "evidence"
        )
    )
    if static_families is not None:
        rows = rows.unionByName(
            static_families.filter(F.coalesce("family", F.lit("")) != "").select(
                "case_id", "family", F.lit("confirmed").alias("confidence"), F.lit("static_prior").alias("basis"),
                F.lit("family extracted from the binary by static analysis").alias("evidence"),
            )
        )
    return rows.distinct()


def family_verdicts(evidence: DataFrame) -> DataFrame:
    """One row per (case, family): best confidence, its basis, and the number of evidence texts."""
    rank = mapped(F.col("confidence"), FAMILY_RANK)
    best = (
        evidence.withColumn("_rank", rank)
        .groupBy("case_id", "family")
        .agg(
            F.max(F.struct("_rank", "confidence", "basis")).alias("b"),
            F.count(F.lit(1)).alias("evidence_count"),
            F.min("evidence").alias("first_evidence"),
        )
    )
    return best.select(
        "case_id", "family", F.col("b.confidence").alias("confidence"), F.col("b.basis").alias("basis"),
        F.col("b._rank").alias("rank"), "evidence_count", "first_evidence",
    )


def family_evidence(evidence: DataFrame) -> DataFrame:
    """(case_id, family, place, confidence, basis, evidence): the texts behind each verdict, the strongest first.

    Rows instead of a list in the verdict: a family may rest on any number of notes.
    """
    order = Window.partitionBy("case_id", "family").orderBy(F.desc(mapped(F.col("confidence"), FAMILY_RANK)), "evidence")
    return evidence.select("case_id", "family", F.row_number().over(order).alias("place"), "confidence", "basis", "evidence")
