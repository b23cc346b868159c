"""Registered queries: an adapter over the test tables followed by one operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netforensics.adapters import driver_tables as t
from netforensics.functions import ip as ipf
from netforensics.functions import rules
from netforensics.functions.text import host_header_domain, subdomain, registered_domain, entropy
from netforensics.operators import (
    connections as cn, correlate as co, custody as cu, dga, dns as dn, emit as em, evaluate as ev, flows as fl,
    joins as jn, services as sv, story as st, tiers as ti, tls as tl, traffic as tr,
)
from netforensics.plans.case import Context, analyse
from netforensics.plans.case import network_findings as case_findings
from netforensics.session import apply_settings, packed, reliable_checkpoint, stored, work_folder
from netforensics.sources import documents as doc
from netforensics.sources import feeds as fd
from netforensics.sources import cases as case_files
from netforensics.sources import zeek
from netforensics.vocab import KNOWN_BAD_JA3

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(apply_settings(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    REGISTRY[fn.__name__] = run
    return fn


# --- connections ---------------------------------------------------------------------


@query
def beaconing(spark, sf):
    return tr.detect_beaconing(t.connections(spark, sf))


@query
def exfil_volume(spark, sf):
    return tr.detect_exfil(t.connections(spark, sf))


@query
def ftp_store_exfil(spark, sf):
    return tr.detect_ftp_exfil(t.connections(spark, sf))


@query
def exfil_merged(spark, sf):
    conns = t.connections(spark, sf)
    merged = tr.merge_exfil(tr.detect_exfil(conns, min_raw_upload_bytes=40_000), tr.detect_ftp_exfil(conns))
    return merged.select("case_id", "seq", "dst_ip", "dst_port", "orig_bytes", "http_method", "http_uri", "confidence")


@query
def unclassified_egress(spark, sf):
    conns = t.connections(spark, sf)
    return tr.detect_unclassified_egress(conns, tr.detect_ftp_exfil(conns))


@query
def to_connections(spark, sf):
    return cn.to_connections(t.sessions(spark, sf), t.order_http(spark, sf), t.order_ftp(spark, sf)).select(
        "case_id", "seq", "dst_ip", "orig_bytes", "http_method", "http_host", "http_uri", "ftp_upload_cmd"
    )


@query
def record_counts(spark, sf):
    return cn.record_counts(
        {"sessions": t.sessions(spark, sf), "http": t.order_http(spark, sf), "dns": t.dns(spark, sf)}
    )


@query
def ip_classes(spark, sf):
    rows = t.read(spark, sf, "customer").selectExpr(
        "CASE c_custkey % 8 WHEN 0 THEN concat('10.', c_custkey % 256, '.0.', c_nationkey) "
        "WHEN 1 THEN concat('172.', c_custkey % 40, '.1.', c_nationkey) WHEN 2 THEN concat('203.0.113.', c_custkey % 300) "
        "WHEN 3 THEN concat('fe80::', c_nationkey) WHEN 4 THEN concat('2001:db8::', c_nationkey, ':1') "
        "WHEN 5 THEN concat('224.0.0.', c_nationkey) WHEN 6 THEN concat('host', c_custkey, '.example.com') "
        "ELSE concat('198.18.', c_nationkey, '.255') END AS ip"
    ).distinct()
    c = F.col("ip")
    return rows.select(
        "ip", ipf.is_ip_literal(c).alias("is_literal"), ipf.is_private(c).alias("is_private"),
        ipf.is_special(c).alias("is_special"), ipf.is_noise(c).alias("is_noise"),
    )


@query
def host_domains(spark, sf):
    return t.connections(spark, sf).filter(F.col("http_host").isNotNull()).select(
        "case_id", "seq", host_header_domain(F.col("http_host")).alias("domain")
    )


@query
def infer_guest(spark, sf):
    return cn.infer_guest(t.connections(spark, sf))


@query
def case_scope(spark, sf):
    sessions, http = t.sessions(spark, sf), t.order_http(spark, sf)
    rules_ = cn.scope_rules(t.manifests(spark, sf), sessions)
    return cn.scope_summary({"sessions": sessions, "http": http}, rules_)


@query
def simulated_scope(spark, sf):
    sessions = t.sessions(spark, sf)
    guest = cn.infer_guest(sessions).select("case_id", "guest_ip")
    return cn.simulated_scope(sessions, guest, cn.infrastructure(t.dns(spark, sf), guest))


# --- DNS --------------------------------------------------------------------------------


def _name_index(spark, sf):
    return reliable_checkpoint(dn.name_index(t.dns(spark, sf)))


@query
def dns_tunnel(spark, sf):
    return dn.detect_dns_tunneling(_name_index(spark, sf)).select(
        "case_id", "domain", "query_count", "avg_entropy", "avg_sub_len", "tunnel_rt_fraction", "unique_ratio",
        "nxdomain_ratio", "confidence", F.array_join("resolver_ips", ",").alias("resolvers"),
    )


@query
def dga_burst(spark, sf):
    return dn.detect_dga(t.dga_dns(spark, sf)).drop("resolver_ips", "evidence")


@query
def doh_endpoints(spark, sf):
    tables = t.cloud_tables(spark, sf)
    return dn.detect_doh(tables["tls"], tables["http"])


@query
def resolved_destinations(spark, sf):
    asked = _name_index(spark, sf)
    return dn.detect_resolved_destinations(asked, dn.detect_dns_tunneling(asked)).select(
        "case_id", "domain", "query_count", F.round("avg_entropy", 6).alias("avg_entropy"), "avg_sub_len", "confidence",
        "evidence",
    )


@query
def name_features(spark, sf):
    names = t.dns(spark, sf).select(F.lower("query").alias("q")).distinct()
    return names.select(
        "q", registered_domain(F.col("q")).alias("registered"), subdomain(F.col("q")).alias("sub"),
        F.round(entropy(F.col("q")), 6).alias("entropy"),
    )


# --- services ------------------------------------------------------------------------------


@query
def cloud_exfil(spark, sf):
    tables = t.cloud_tables(spark, sf)
    return sv.detect_cloud_exfil(tables["tls"], tables["http"], tables["sessions"]).drop("source", "seq")


@query
def smtp_exfil(spark, sf):
    return sv.detect_smtp_exfil(t.smtp(spark, sf)).withColumn("rcpt_to", F.array_join("rcpt_to", ","))


@query
def http_gate(spark, sf):
    return sv.detect_http_exfil(t.page_http(spark, sf))


@query
def icmp_tunnel(spark, sf):
    return sv.detect_icmp_tunnel(t.icmp(spark, sf))


@query
def port_mismatch(spark, sf):
    return sv.detect_port_mismatch(t.page_http(spark, sf), t.page_tls(spark, sf)).drop("source", "seq")


# --- TLS ---------------------------------------------------------------------------------------


def _hellos(spark, sf):
    """Hello components from line items, GREASE included; 'O' lines are client messages."""
    return t.read(spark, sf, "lineitem").selectExpr(
        "concat('case-', l_orderkey % 7) AS case_id", "l_orderkey * 8 + l_linenumber AS seq",
        f"{t.epoch('l_shipdate')} AS ts",
        "CASE WHEN l_linestatus = 'O' THEN 'client' ELSE 'server' END AS message",
        "CASE WHEN l_linestatus = 'O' THEN '10.0.0.1' ELSE concat('203.0.113.', l_suppkey % 250) END AS src_ip",
        "CASE WHEN l_linestatus = 'O' THEN CAST(40000 AS int) ELSE CAST(443 AS int) END AS src_port",
        "CASE WHEN l_linestatus = 'O' THEN concat('203.0.113.', l_suppkey % 250) ELSE '10.0.0.1' END AS dst_ip",
        "CASE WHEN l_linestatus = 'O' THEN CAST(443 AS int) ELSE CAST(40000 AS int) END AS dst_port",
        "771 AS version",
        "array(2570, CAST(4865 + l_linenumber AS int), CAST(l_partkey % 60000 AS int), CAST(49195 AS int)) AS ciphers",
        "array(0, 16, CAST(l_suppkey % 50 AS int), 14906, 43) AS extensions",
        "array(29, 23, 10794) AS curves", "array(0) AS formats", "array(1027, CAST(l_linenumber AS int)) AS sig_algs",
        "CASE WHEN l_returnflag = 'R' THEN array('h2', 'http/1.1') ELSE CAST(array() AS array<string>) END AS alpns",
        "CASE WHEN l_returnflag = 'A' THEN NULL ELSE concat('s', l_suppkey, '.example.com') END AS sni",
        "CASE WHEN l_linenumber > 3 THEN array(772, 771, 35466) ELSE CAST(array() AS array<int>) END AS supported_versions",
    )


@query
def ja3_hash(spark, sf):
    return tl.fingerprint_hellos(_hellos(spark, sf)).groupBy("case_id", "message", "ja3", "ja3s").agg(
        F.count(F.lit(1)).alias("hellos")
    )


@query
def ja4_hash(spark, sf):
    rows = tl.fingerprint_hellos(_hellos(spark, sf)).filter("message = 'client'")
    return rows.groupBy("case_id", "ja4").agg(F.count(F.lit(1)).alias("hellos"))


@query
def hello_pairs(spark, sf):
    return tl.pair_hellos(tl.fingerprint_hellos(_hellos(spark, sf)))


@query
def first_client_hello(spark, sf):
    return tl.first_client_hello(tl.fingerprint_hellos(_hellos(spark, sf))).drop("ts")


@query
def tls_certificate(spark, sf):
    return tl.certificate_findings(t.page_tls(spark, sf)).select(
        "case_id", "seq", "dst_ip", "dst_port", "server_name", "reason", "severity"
    )


@query
def ja3_records(spark, sf):
    return tl.fingerprint_records(t.page_tls(spark, sf)).drop("first_seq")


@query
def service_fingerprint(spark, sf):
    return tl.service_fingerprint(t.page_tls(spark, sf))


def _page_intel(spark, sf):
    """Suppliers as fingerprint indicators and customers as addresses of page destinations."""
    host = "regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)"
    prints = t.read(spark, sf, "pages").selectExpr(
        f"CASE WHEN page_id % 10 = 3 THEN md5({host}) ELSE concat('listed.', {host}) END AS value", "'pages' AS source",
        "'Trickbot' AS note", "CASE WHEN page_id % 10 = 3 THEN 'ja3' ELSE 'domain' END AS indicator_type",
        "CAST(NULL AS string) AS last_seen",
    )
    hosts = t.read(spark, sf, "supplier").filter("s_acctbal < 0").selectExpr(
        "concat('203.0.113.', s_suppkey % 60) AS value", "'suppliers' AS source", "'C2' AS note", "'ip' AS indicator_type",
        "CAST(NULL AS string) AS last_seen",
    )
    return prints.unionByName(hosts).distinct()


@query
def tls_reputation(spark, sf):
    covered = t.read(spark, sf, "supplier").selectExpr(
        "CASE WHEN s_nationkey = 7 THEN 'case-1' ELSE concat('other-', s_nationkey) END AS case_id",
        "concat('203.0.113.', s_suppkey % 60) AS dst_ip",
    )
    return tl.tls_findings(t.page_tls(spark, sf), covered, _page_intel(spark, sf)).select(
        "case_id", "seq", "kind", "dst_ip", "dst_port", "server_name", "confidence", "reputation_hit", "severity",
        "match_on",
    )


@query
def known_bad_ja3(spark, sf):
    listed = [value for value, _ in KNOWN_BAD_JA3][:4]
    rows = t.page_tls(spark, sf).withColumn(
        "ja3",
        F.when(
            F.col("seq") % 3 == 0, F.element_at(F.array(*[F.lit(x) for x in listed]), (F.col("seq") % 4 + 1).cast("int"))
        ).otherwise(F.col("ja3")),
    )
    return tl.known_bad_ja3(rows).groupBy("ja3", "description").agg(F.count(F.lit(1)).alias("n"))


# --- packets --------------------------------------------------------------------------------------


@query
def flow_assembly(spark, sf):
    return fl.assemble_flows(t.packets(spark, sf)).drop("proto", "history")


def _mail_packets(spark, sf):
    return t.read(spark, sf, "conversations").selectExpr(
        "concat('case-', conv_id % 7) AS case_id", "conv_id * 1000 + turn AS seq", "1704067200.0D + conv_id AS ts",
        "'10.0.0.5' AS src_ip", "40000 AS src_port", "concat('198.51.100.', conv_id % 200) AS dst_ip",
        "CASE WHEN conv_id % 2 = 0 THEN 25 ELSE 587 END AS dst_port", "'tcp' AS proto",
        "CAST(concat('MAIL FROM:<', role, turn, '@a.example>\\r\\nRCPT TO:<r', turn % 3, '@b.example>\\r\\nSubject: t', "
        "turn, '\\r\\n', CASE WHEN length(text) % 2 = 0 THEN 'Content-Disposition: attachment\\r\\n' ELSE '' END) "
        "AS binary) AS payload",
    )


@query
def smtp_envelopes(spark, sf):
    packets = _mail_packets(spark, sf)
    return fl.smtp_with_lists(fl.smtp_envelopes(packets), fl.smtp_items(packets)).select(
        "case_id", "seq", "src_ip", "dst_ip", "dst_port", "mail_from", F.array_join("rcpt_to", ",").alias("rcpt_to"),
        "subject", F.size("attachments").alias("attachments"),
    )


@query
def smtp_items(spark, sf):
    return fl.smtp_items(_mail_packets(spark, sf))


@query
def outbound_content(spark, sf):
    return fl.outbound_content(t.packets(spark, sf), min_bytes=64, head_bytes=100).select(
        "case_id", "seq", "source_ip", "dest_ip", "total_bytes", "sha256", "head_sha256", "preview"
    )


@query
def outbound_artifacts(spark, sf):
    files = t.read(spark, sf, "orders").selectExpr(
        "concat('case-', o_orderkey % 3) AS case_id", "o_orderkey AS seq", f"{t.epoch('o_orderdate')} AS ts",
        "CAST(NULL AS string) AS filename", "CAST(NULL AS string) AS mime_type",
        "CAST(floor(o_totalprice) AS bigint) AS total_bytes", "CAST(NULL AS string) AS md5",
        "sha2(CAST(o_orderkey AS string), 256) AS sha256",
        "CASE WHEN o_orderstatus = 'O' THEN '10.0.0.9' ELSE '203.0.113.9' END AS source_ip",
        f"{t.address('o_custkey')} AS dest_ip", "o_orderstatus = 'P' AND o_custkey % 9 = 0 AS is_outbound",
        "CAST(NULL AS string) AS uid", "CAST(NULL AS string) AS preview",
    )
    return fl.outbound_artifacts(files, t.packets(spark, sf)).select(
        "case_id", "seq", "total_bytes", "sha256", "head_sha256", "source_ip", "dest_ip", "is_outbound", "preview"
    )


# --- intelligence -------------------------------------------------------------------------------------


@query
def intel_lookup(spark, sf):
    rows = t.connections(spark, sf).select(
        "case_id", "seq", "dst_ip", F.md5(F.concat(F.lit("host"), (F.col("seq") % 300).cast("string"))).alias("ja3")
    )
    return jn.lookup_indicators(rows, t.intel(spark, sf)).select(
        "case_id", "seq", "reputation_hit", "reputation_source", "reputation_note", "match_on"
    )


@query
def domain_reputation(spark, sf):
    names = t.dns(spark, sf).select("case_id", F.col("query").alias("destination_domain")).distinct()
    return jn.lookup_domains(names, t.intel(spark, sf))


def _site_allowlist(spark, sf):
    domains = t.read(spark, sf, "supplier").selectExpr("concat('Site', s_suppkey, '.com') AS domain")
    cidrs = t.read(spark, sf, "nation").selectExpr(
        "CASE WHEN n_nationkey % 2 = 0 THEN concat('203.0.', n_nationkey * 4, '.0/22') "
        "ELSE concat('203.0.', n_nationkey * 4, '.128/25') END AS cidr"
    )
    return domains, cidrs


@query
def suffix_allowlist(spark, sf):
    domains, cidrs = _site_allowlist(spark, sf)
    names = t.dns(spark, sf).select(F.col("query").alias("destination_domain"), "dst_ip").distinct()
    conns = t.connections(spark, sf).select(F.lit(None).cast("string").alias("destination_domain"), "dst_ip").distinct()
    return jn.allowlist_lookup(names.unionByName(conns), domains, cidrs)


@query
def geo_range(spark, sf):
    """Ranges of both families, given as address texts, against addresses of both."""
    v4 = "concat('203.0.', ({0}) div 256, '.', ({0}) % 256)"
    v6 = "concat('2001:db8:', lower(hex({0})), '::', '{1}')"
    bounds = [
        (v4.format("n_nationkey * 1000"), v4.format("n_nationkey * 1000 + 799")),
        (v6.format("n_nationkey * 16", "1000"), v6.format("n_nationkey * 16 + 11", "1fff")),
    ]
    ranges = t.read(spark, sf, "nation").select(
        F.inline(F.array(*[F.struct(F.expr(lo).alias("lo"), F.expr(hi).alias("hi")) for lo, hi in bounds])),
        F.col("n_name").alias("geo_country"), F.expr("concat('AS', n_nationkey)").alias("asn"),
        F.expr("concat('Org ', n_regionkey)").alias("asn_org"),
    )
    rows = t.connections(spark, sf).select("case_id", "dst_ip").unionByName(
        t.read(spark, sf, "lineitem").selectExpr(
            "concat('case-', l_orderkey % 7) AS case_id",
            "concat('2001:db8:', lower(hex(l_suppkey % 400)), '::', lower(hex(l_orderkey % 9000))) AS dst_ip",
        )
    )
    return jn.geo_enrich(rows.distinct(), ranges)


@query
def geo_network(spark, sf):
    networks = t.read(spark, sf, "nation").selectExpr(
        "CASE WHEN n_nationkey % 3 = 0 THEN concat('203.0.', n_nationkey * 2, '.0/23') "
        "ELSE concat('203.0.', n_nationkey * 2 - n_nationkey * 2 % 8, '.0/21') END AS network",
        "n_name AS geo_country", "concat('AS', n_nationkey) AS asn", "concat('Org ', n_regionkey) AS asn_org",
    )
    narrow = networks.filter("network LIKE '%/23'")
    wide = networks.filter("network LIKE '%/21'").groupBy("network").agg(
        F.min("geo_country").alias("geo_country"), F.min("asn").alias("asn"), F.min("asn_org").alias("asn_org")
    )
    rows = t.connections(spark, sf).select("case_id", "dst_ip").distinct()
    return jn.geo_enrich(rows, narrow.unionByName(wide))


# --- tiers ------------------------------------------------------------------------------------------------


def _intel(spark, sf):
    """The merged indicators; staged, since every lookup below reads them again."""
    return reliable_checkpoint(t.intel(spark, sf))


def _tiered(spark, sf, intel=None):
    intel = _intel(spark, sf) if intel is None else intel
    found = ti.apply_reputation(
        t.findings(spark, sf).withColumns(
            {c: F.lit(None).cast("string") for c in ("reputation_hit", "reputation_source", "reputation_note", "match_on")}
        ),
        intel,
    )
    return ti.apply_corroboration(ti.apply_domain_reputation(found, intel))


@query
def corroboration_tier(spark, sf):
    return _tiered(spark, sf).select(
        "case_id", F.col("finding_no.seq").alias("seq"), "kind", "dst_ip", "reputation_hit", "reputation_note",
        "reputation_source", "beacon_note", "confidence_tier",
    )


@query
def allowlist_tier(spark, sf):
    domains, cidrs = _site_allowlist(spark, sf)
    return ti.apply_allowlist(_tiered(spark, sf), domains, cidrs).select(
        "case_id", F.col("finding_no.seq").alias("seq"), "confidence_tier", "allowlist_match"
    )


@query
def gate_findings(spark, sf):
    return ti.gate_findings(_tiered(spark, sf), t.manifests(spark, sf)).select(
        "case_id", F.col("finding_no.seq").alias("seq"), "confidence_tier", "capped_by_caveat", "network_mode",
        "plaintext_available",
    )


@query
def case_notes(spark, sf):
    """The ledger of caveats with the notes of all gates and of the clock check."""
    manifests, access, network = t.manifests(spark, sf), t.access(spark, sf), t.network(spark, sf)
    correlated = ti.gate_correlated(co.apply_veto(co.correlate_best(access, network), manifests), manifests)
    minutes = access.withColumn("ts", F.col("ts") * 60), network.withColumn("event_time", F.col("event_time") * 60)
    aligned = co.verify_clock_alignment(*minutes, manifests=manifests)
    return ti.case_notes(manifests, ti.gate_findings(_tiered(spark, sf), manifests), correlated, aligned)


@query
def static_prior_match(spark, sf):
    dns = t.dns(spark, sf).select("case_id", F.lower("query").alias("domain"))
    return ti.correlate_static_prior(t.static_iocs(spark, sf), t.connections(spark, sf), dns).select(
        "case_id", "seq", "type", "value", "observed", F.array_join("matched", ",").alias("matched"), "config"
    )


@query
def infrastructure_removal(spark, sf):
    """Static indicators without the addresses that answered the orders of their case."""
    servers = cn.infrastructure(t.order_http(spark, sf))
    return ti.without_infrastructure(t.static_iocs(spark, sf), servers).select("case_id", "seq", "type", "value")


@query
def static_prior_tiers(spark, sf):
    dns = t.dns(spark, sf).select("case_id", F.lower("query").alias("domain"))
    found = ti.apply_static_prior(reliable_checkpoint(_tiered(spark, sf)), t.static_iocs(spark, sf), t.connections(spark, sf), dns)
    return found.select(
        "case_id", F.col("finding_no.seq").alias("seq"), "kind", "dst_ip", "destination_domain", "confidence",
        "confidence_tier", "reputation_hit", "static_match", "static_note",
    )


# --- correlation -----------------------------------------------------------------------------------------------


@query
def correlate_pairs(spark, sf):
    return co.correlate_pairs(t.access(spark, sf), t.network(spark, sf)).select(
        "case_id", "access_seq", F.col("finding_no.seq").alias("network_seq"), "data_type_accessed", "access_ts",
        "destination_ip", "destination_port", "time_delta_s", "network_confidence", "reputation_hit",
        "correlation_confidence", "confidence_tier", "mitre_technique_id", "accessed_object",
    )


@query
def correlate_best(spark, sf):
    return co.correlate_best(t.access(spark, sf), t.network(spark, sf)).select(
        "case_id", "access_seq", F.col("finding_no.seq").alias("network_seq"), "data_type_accessed", "access_ts",
        "destination_ip", "destination_port", "time_delta_s", "correlation_confidence", "confidence_tier",
    )


@query
def clock_sync(spark, sf):
    return co.assess_clock_sync(t.access(spark, sf), t.network(spark, sf)).select(
        "case_id", "min_forward_delta_s", "correlatable", "likely_skew", "note"
    )


@query
def clock_alignment(spark, sf):
    host = t.access(spark, sf).withColumn("ts", F.col("ts") * 60)
    net = t.network(spark, sf).withColumn("event_time", F.col("event_time") * 60)
    return co.verify_clock_alignment(host, net, manifests=t.manifests(spark, sf)).select(
        "case_id", F.round("gap_s", 6).alias("gap_s"), "note"
    )


@query
def gate_correlated(spark, sf):
    manifests = t.manifests(spark, sf)
    best = co.correlate_best(t.access(spark, sf), t.network(spark, sf))
    return ti.gate_correlated(co.apply_veto(best, manifests), manifests).select(
        "case_id", "access_seq", "data_type_accessed", "confidence_tier", "capped_by_caveat"
    )


def _sample_documents(spark, sf):
    """One sample metadata document per customer."""
    return t.read(spark, sf, "customer").selectExpr(
        "concat('case-', c_custkey) AS case_id",
        "concat('{\"sample_sha256\":\"', sha2(CAST(c_custkey AS string), 256), '\",\"static_risk_score\":', "
        "CASE WHEN c_custkey % 10 = 0 THEN '\"high\"' ELSE CAST(c_nationkey AS string) END, "
        "',\"static_hypotheses\":', CASE WHEN c_custkey % 12 = 0 THEN '\"packed\"' "
        "ELSE '[\"packed\",\"suspicious_imports:BitBlt\",\"packed\",\"dotnet\"]' END, "
        "',\"yara\":{\"fast_hits\":[', CASE WHEN c_nationkey % 3 = 0 THEN '\"Win_RedLine_1\"' ELSE '' END, "
        "'],\"deep_hits\":[', CASE WHEN c_nationkey % 5 = 0 THEN '\"x\",\"MAL_Agent-Tesla\"' ELSE '' END, ']},"
        "\"clamav\":{\"status\":\"', CASE WHEN c_custkey % 7 = 0 THEN 'FOUND' ELSE 'clean' END, "
        "'\",\"signature\":\"', CASE WHEN c_custkey % 14 = 0 THEN 'Win.Trojan.Remcos' ELSE '' END, '\"},"
        "\"vt_lookup\":\"', CASE c_custkey % 4 WHEN 0 THEN '54/72' WHEN 1 THEN '0/70' WHEN 2 THEN 'not_configured' "
        "ELSE '3 / 60' END, '\"}') AS raw",
    )


@query
def sample_meta(spark, sf):
    meta = doc.parse_sample_meta(_sample_documents(spark, sf))
    return meta.select(
        "case_id", "sample_sha256", "static_risk_score", rules.sample_family().alias("family"),
        F.array_join(rules.corroborating_signals(), "|").alias("signals"),
        F.array_join(rules.capability_techniques(F.col("static_hypotheses")), ",").alias("techniques"),
        F.array_join("errors", "|").alias("errors"),
    )


@query
def static_promotion(spark, sf):
    best = co.correlate_best(t.access(spark, sf), t.network(spark, sf)).withColumn(
        "capped_by_caveat", F.when(F.col("access_seq") % 5 == 0, F.lit("clock_quality"))
    )
    meta = doc.parse_sample_meta(_sample_documents(spark, sf))
    return ti.promote_static(best, meta).select(
        "case_id", "access_seq", "confidence_tier", F.array_join("static_corroboration", "|").alias("signals")
    )


# --- story ----------------------------------------------------------------------------------------------------------


@query
def provenance(spark, sf):
    best = co.correlate_best(t.access(spark, sf), t.network(spark, sf))
    return st.build_provenance(best, t.network(spark, sf), t.artifacts(spark, sf)).drop("exfiltrated_at", "statement")


@query
def provenance_statements(spark, sf):
    best = co.correlate_best(t.access(spark, sf), t.network(spark, sf)).withColumn("network_ts", F.lit("T"))
    return st.build_provenance(best, t.network(spark, sf), t.artifacts(spark, sf)).select(
        "case_id", "access_seq", "statement"
    )


@query
def timeline(spark, sf):
    return st.build_timeline(t.access(spark, sf), t.network(spark, sf)).select(
        "case_id", F.round("event_time", 4).alias("event_time"), F.col("position.seq").alias("seq"), "actor", "phase",
        "mitre", "description", "tier",
    )


def _families(spark, sf):
    stated = t.static_iocs(spark, sf).groupBy("case_id").agg(F.max("family").alias("family"))
    intel = _intel(spark, sf)
    return st.attribute_family(reliable_checkpoint(_tiered(spark, sf, intel)), intel, stated)


@query
def family(spark, sf):
    return _families(spark, sf)


@query
def family_verdicts(spark, sf):
    return st.family_verdicts(_families(spark, sf))


@query
def family_evidence(spark, sf):
    return st.family_evidence(_families(spark, sf))


# --- custody and export --------------------------------------------------------------------------------------------------


def _chain_rows(spark, sf):
    return t.read(spark, sf, "events").selectExpr(
        "concat('user-', user_id) AS case_id", "event_id",
        "concat(event_id, '|', event_type, '|', CAST(CAST(floor(value * 100) AS bigint) AS string)) AS row_text",
        "CASE WHEN user_id % 2 = 0 THEN sha2(CAST(user_id AS string), 256) END AS seed",
    )


@query
def hash_chain(spark, sf):
    return cu.hash_chain(_chain_rows(spark, sf), ["event_id"], seed="seed").select(
        "case_id", "event_id", "chain_pos", "evidence_hash"
    )


@query
def chain_verify(spark, sf):
    chained = cu.hash_chain(_chain_rows(spark, sf), ["event_id"], seed="seed")
    edited = chained.withColumn(
        "row_text",
        F.when((F.substr("case_id", F.lit(6)).cast("int") % 3 == 0) & (F.col("chain_pos") % 20 == 7), F.lit("edited"))
        .otherwise(F.col("row_text")),
    )
    return cu.verify_chain(edited)


@query
def chain_tamper(spark, sf):
    """Sealed chains tampered in a way that depends on the user, verified against the stored record."""
    chained = cu.hash_chain(_chain_rows(spark, sf), ["event_id"], seed="seed", segment_rows=16)
    record = cu.seal_segments(chained).select("case_id", "rows", "seal")
    way, place = F.substr("case_id", F.lit(6)).cast("bigint") % 6, F.col("chain_pos")
    last = place == F.col("_rows") - 1
    gone = ((way == 1) & (place == 0)) | ((way == 2) & (place == 7)) | ((way == 3) & last)
    kept = chained.join(record.select("case_id", F.col("rows").alias("_rows")), "case_id").filter(~gone)
    edited = kept.withColumn("row_text", F.when((way == 5) & (place == 5), "edited").otherwise(F.col("row_text")))
    return cu.verify_chain(edited.unionByName(edited.filter((way == 4) & (place == 3))), record=record)


@query
def chain_segments(spark, sf):
    chained = cu.hash_chain(_chain_rows(spark, sf), ["event_id"], seed="seed", segment_rows=16)
    return cu.seal_segments(chained).select("case_id", "rows", "segments", "seal")


@query
def case_manifest(spark, sf):
    inputs = t.read(spark, sf, "documents").selectExpr(
        "concat('case-', doc_id div 10) AS case_id", "sha2(text, 256) AS sha256",
        "CAST(octet_length(text) AS bigint) AS size_bytes",
    )
    return cu.case_manifest(inputs)


@query
def evidence_hashes(spark, sf):
    """Evidence files, one per case with a line for each document, hashed range by range."""
    folder = work_folder(spark, "evidence")
    docs = t.read(spark, sf, "documents").selectExpr("concat('case-', doc_id % 50) AS case_id", "doc_id", "text")
    ordered = docs.repartition("case_id").sortWithinPartitions("case_id", "doc_id")
    ordered.select("case_id", "text").write.partitionBy("case_id").text(folder)
    return cu.hash_inputs(spark, folder, range_bytes=64 << 10).select("case_id", "role", "sha256", "size_bytes")


def _events(spark, sf):
    """Tiered orders in the shape of event rows, in chain order."""
    rows = _tiered(spark, sf).withColumns(
        {
            "destination_ip": F.when(F.col("finding_no.seq") % 6 != 0, F.col("dst_ip")),
            "destination_port": F.col("dst_port"),
            "chain_pos": F.col("finding_no.seq"),
            "event_id": rules.uuid5(F.col("finding_no.seq").cast("string")),
            "sample_id": F.sha2(F.col("case_id"), 256),
            "reputation_score": F.when(F.col("reputation_hit"), 1.0).otherwise(0.0),
            "confidence_score": F.col("confidence"),
            "mitre_technique_id": rules.technique(F.col("kind")),
            "asn_org": F.lit(None).cast("string"),
            "geo_country": F.when(F.col("finding_no.seq") % 4 == 0, F.lit("DE")),
            "data_type_accessed": F.lit(None).cast("string"),
            "timestamp": F.concat(F.lit("T"), F.col("finding_no.seq").cast("string")),
            "evidence_hash": F.sha2(F.col("finding_no.seq").cast("string"), 256),
        }
    )
    return ti.apply_allowlist(rows)


@query
def ioc_export(spark, sf):
    return em.ioc_rows(_events(spark, sf)).drop("reputation_score", "asn_org", "data_type_accessed")


CREATED = "2026-01-01T00:00:00+00:00"
STIX_FIELDS = [
    "type", "spec_version", "id", "created", "modified", "name", "description", "pattern", "pattern_type", "valid_from",
    "confidence", "labels", "external_references", "first_observed", "last_observed", "number_observed", "object_refs",
    "relationship_type", "source_ref", "target_ref",
]


def _stix_fields(rows, *more):
    """Every field of the objects, as text; parsed once per object."""
    schema = ", ".join(f"{f} string" for f in STIX_FIELDS)
    return rows.select(*more, F.inline(F.array(F.from_json("json", schema))))


def _staged_events(spark, sf):
    """What an export reads of the events, made once for its two passes."""
    return stored(_events(spark, sf).select(*em.STIX_COLUMNS, "chain_pos"), "events")


@query
def stix_objects(spark, sf):
    return _stix_fields(em.stix_objects(_staged_events(spark, sf), CREATED), "case_id")


@query
def stix_bundles(spark, sf):
    """One bundle document per case, written and read back."""
    folder = work_folder(spark, "bundles")
    em.write_stix(em.stix_objects(_staged_events(spark, sf), CREATED), folder, compress=True)
    return _stix_fields(em.read_stix(spark, folder), "case_id", "bundle_id").select(
        "case_id", "bundle_id", "type", "id", "name", "pattern", "source_ref", "target_ref"
    )


@query
def plain_language(spark, sf):
    return _events(spark, sf).select(
        "case_id", F.col("finding_no.seq").alias("seq"),
        rules.finding_kind(F.col("kind"), F.col("reputation_hit")).alias("finding_kind"),
        rules.plain_language(F.col("kind")).alias("plain_language"),
    )


@query
def evidence_refs(spark, sf):
    return _events(spark, sf).select(
        "case_id", F.col("finding_no.seq").alias("seq"), em.evidence_refs(F.col("kind"), False).alias("evidence_refs")
    )


@query
def contract_violations(spark, sf):
    rows = _events(spark, sf).withColumns(
        {
            "platform": F.when(F.col("chain_pos") % 11 == 0, "linux").otherwise("windows"),
            "case_id": F.when(F.col("chain_pos") % 17 == 0, F.col("case_id")).otherwise(rules.uuid5(F.col("case_id"))),
            "destination_port": F.when(F.col("chain_pos") % 13 == 0, 70000).otherwise(F.col("dst_port")),
            "timestamp": F.when(F.col("chain_pos") % 19 == 0, F.lit(None)).otherwise("2026-01-01T00:00:00+00:00"),
            "finding_kind": rules.finding_kind(F.col("kind"), F.col("reputation_hit")),
            "plain_language": F.when(F.col("chain_pos") % 23 == 0, "").otherwise("x"),
            "evidence_refs": F.lit("[]"),
            "manifest_sha256": F.when(F.col("chain_pos") % 29 == 0, "zz"),
        }
    )
    return em.contract_violations(rows)


@query
def sample_tiers(spark, sf):
    stored = t.read(spark, sf, "nation").selectExpr(
        "sha2(concat('case-', n_nationkey), 256) AS sample_id", "'windows' AS platform", "'weak' AS confidence_tier"
    )
    return em.sample_tiers(_events(spark, sf), stored)


@query
def new_events(spark, sf):
    events = _events(spark, sf)
    stored = t.read(spark, sf, "lineitem").select(rules.uuid5(F.col("l_orderkey").cast("string")).alias("event_id"))
    return em.new_events(events, stored).select("case_id", "event_id", "destination_ip", "confidence_tier")


@query
def event_sinks(spark, sf):
    """Events through each sink and back; the store is written twice and keeps one row of each."""
    events = reliable_checkpoint(_events(spark, sf).select("case_id", "event_id", "confidence_tier", "chain_pos"))
    folder = work_folder(spark, "sinks")
    em.write_table(events, f"{folder}/table")
    em.write_json(events, f"{folder}/json")
    em.store_events(events, f"{folder}/store")
    em.store_events(events, f"{folder}/store")
    out = None
    for name, back in (("table", spark.read.parquet(f"{folder}/table")), ("json", spark.read.json(f"{folder}/json")), ("store", spark.read.parquet(f"{folder}/store"))):
        rows = back.select(F.lit(name).alias("sink"), F.col("case_id").cast("string").alias("case_id"), "event_id", "confidence_tier", "chain_pos")
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def correlated_events(spark, sf):
    """Event rows of correlated accesses, enriched by the first finding on their service."""
    network = t.network(spark, sf)
    best = co.correlate_best(t.access(spark, sf), network)
    samples = t.manifests(spark, sf).select("case_id", F.sha2("case_id", 256).alias("sample_id"))
    rows = em.event_rows(network, best, samples).filter("chain_order.stage = 0")
    return rows.select(
        "case_id", "sample_id", F.col("chain_order.access").alias("access_seq"), "destination_ip", "destination_port", "destination_domain",
        "plaintext_available", "confidence_score", "confidence_tier", "finding_kind", "plain_language", "evidence_refs",
    )


# --- evaluation ---------------------------------------------------------------------------------------------------------------


def _outcomes(spark, sf):
    intel = _intel(spark, sf)
    truth = intel.filter("indicator_type = 'ip'").withColumn(
        "c", F.explode(F.sequence(F.lit(0), F.lit(7)))
    ).selectExpr("concat('case-', c) AS case_id", "CASE WHEN c < 5 THEN value END AS indicator", "c < 5 AS is_malware").distinct()
    return ev.case_outcomes(ev.flagged_by_threshold(_tiered(spark, sf, intel)), truth)


@query
def flagged_indicators(spark, sf):
    return ev.flagged_by_threshold(_tiered(spark, sf))


@query
def case_outcomes(spark, sf):
    return _outcomes(spark, sf)


@query
def precision_recall(spark, sf):
    return ev.precision_recall(_outcomes(spark, sf)).select(
        "threshold", "tp", "fp", "fn", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall")
    )


# --- learned model ---------------------------------------------------------------------------------------------------------------


def _labels(spark, sf, dns=None):
    return (t.dns(spark, sf) if dns is None else dns).select(F.lower(F.substring_index(registered_domain(F.col("query")), ".", 1)).alias("name")).distinct()


@query
def ngram_features(spark, sf):
    return dga.name_features(_labels(spark, sf)).groupBy("feature").agg(
        F.count(F.lit(1)).alias("names"), F.round(F.sum("value"), 6).alias("total")
    )


@query
def dga_vocabulary(spark, sf):
    return dga.build_vocabulary(dga.name_features(_labels(spark, sf)), min_df=3, max_features=200)


@query
def dga_score(spark, sf):
    names = _labels(spark, sf)
    weights = dga.name_features(names).select("feature").distinct().withColumn(
        "weight", ((F.ascii(F.substr("feature", F.lit(4))) % 7) - 3) * 2.0
    )
    return dga.score_names(names, weights, bias=-0.25).select("name", "probability", "is_dga")


def _training_samples(spark, sf):
    """Words of documents against names made of two neighbouring words of conversations."""
    def words(table):
        return t.read(spark, sf, table).select(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), F.lit(1)).alias("w"))

    single = words("documents").select(F.explode("w").alias("name"))
    pairs = F.zip_with(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", 2, F.size("w")), lambda a, b: F.concat(a, b))
    joined = words("conversations").filter(F.size("w") > 0).select(F.explode(pairs).alias("name"))
    return dga.training_set((single, 0), (joined, 1))


@query
def dga_split(spark, sf):
    train, held = dga.split_training(_training_samples(spark, sf))
    parts = train.withColumn("part", F.lit("train")).unionByName(held.withColumn("part", F.lit("held_out")))
    return parts.groupBy("part", "label").agg(F.count(F.lit(1)).alias("names"), F.sum(F.length("name")).alias("letters"))


@query
def dga_training(spark, sf):
    """Train on single words against joined words; metrics on both splits."""
    train, held = dga.split_training(reliable_checkpoint(_training_samples(spark, sf)))
    weights, bias = dga.train(train, max_iter=20)
    out = None
    for name, part in (("train", train), ("held_out", held)):
        scored = dga.score_names(part, weights, bias).join(part, "name")
        row = dga.evaluate_scores(scored).withColumn("part", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


# --- sources ------------------------------------------------------------------------------------------------------------------------


def _zeek_lines(spark, sf):
    """conn.log lines of both encodings, one file per case, odd cases in JSON."""
    base = t.sessions(spark, sf).withColumn("file", F.concat("case_id", F.lit("/conn.log")))
    base = base.withColumn("is_json", F.substr("case_id", F.lit(6)).cast("int") % 2 == 1)
    names = ["ts", "uid", "id.orig_h", "id.orig_p", "id.resp_h", "id.resp_p", "proto", "orig_bytes", "resp_bytes", "history"]
    values = [
        F.format_string("%.6f", F.col("ts")), F.coalesce("uid", F.lit("-")), F.col("src_ip"),
        F.col("src_port").cast("string"), F.col("dst_ip"), F.col("dst_port").cast("string"), F.col("proto"),
        F.when(F.col("orig_bytes") % 7000 == 0, "-").otherwise(F.col("orig_bytes").cast("string")),
        F.col("resp_bytes").cast("string"), F.col("history"),
    ]
    tsv = F.concat_ws("\t", *values)
    as_json = F.to_json(F.struct(*[v.alias(n) for n, v in zip(names, values)]))
    body = base.select(
        "case_id", "file", "seq", F.when(F.col("is_json"), as_json).otherwise(tsv).alias("value")
    )
    head = base.filter(~F.col("is_json")).select("case_id", "file").distinct()
    lines = head.select("case_id", "file", F.lit(-2).cast("bigint").alias("seq"), F.lit("#separator \\x09").alias("value")).unionByName(
        head.select("case_id", "file", F.lit(-1).cast("bigint").alias("seq"), F.lit("#fields\t" + "\t".join(names)).alias("value"))
    )
    broken = base.filter("is_json").select("case_id", "file", F.lit(-1).cast("bigint").alias("seq"), F.lit('{"ts": ').alias("value")).distinct()
    # The generator keeps filters on the text from evaluating its construction again.
    return body.unionByName(lines).unionByName(broken).select(
        F.inline(F.array(F.struct("case_id", "file", "seq", "value")))
    )


@query
def zeek_conn(spark, sf):
    return zeek.typed_table("conn", zeek.parse_log(_zeek_lines(spark, sf), zeek.LOG_FIELDS["conn"])).select(
        "case_id", "seq", "ts", "src_ip", "src_port", "dst_ip", "dst_port", "proto", "orig_bytes", "resp_bytes", "history", "uid"
    )


@query
def zeek_connections(spark, sf):
    return zeek.connections_from_conn_log(zeek.parse_log(_zeek_lines(spark, sf), zeek.LOG_FIELDS["conn"])).groupBy(
        "case_id", "dst_ip", "dst_port"
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("orig_bytes").alias("orig_bytes"))


def _parsed_log(base, log, values):
    """A typed log written as lines and read again: one file per case, odd cases in JSON, the others in TSV."""
    base = base.withColumn("file", F.concat("case_id", F.lit(f"/{log}.log")))
    is_json = F.substr("case_id", F.lit(6)).cast("int") % 2 == 1
    tsv = F.concat_ws("\t", *[F.coalesce(F.nullif(F.concat_ws(",", v), F.lit("")), F.lit("-")) for v in values.values()])
    as_json = F.to_json(F.struct(*[v.alias(n) for n, v in values.items()]))
    body = base.select("case_id", "file", F.col("seq").cast("bigint").alias("seq"), F.when(is_json, as_json).otherwise(tsv).alias("value"))
    head = base.filter(~is_json).select("case_id", "file").distinct().select(
        "case_id", "file", F.lit(-1).cast("bigint").alias("seq"), F.lit("#fields\t" + "\t".join(values)).alias("value")
    )
    lines = body.unionByName(head).select(F.inline(F.array(F.struct("case_id", "file", "seq", "value"))))
    return zeek.typed_table(log, zeek.parse_log(lines, zeek.LOG_FIELDS[log]))


@query
def zeek_dns(spark, sf):
    answers = F.when(F.col("seq") % 3 == 0, F.array(F.lit("[x]"), "qtype")).when(F.col("seq") % 3 == 1, F.array("dst_ip"))
    return _parsed_log(t.dns(spark, sf), "dns", {
        "ts": F.col("ts").cast("string"), "id.orig_h": F.col("src_ip"), "id.resp_h": F.col("dst_ip"), "query": F.col("query"),
        "qtype_name": F.col("qtype"), "rcode_name": F.col("rcode"), "answers": answers,
    }).select("case_id", "seq", "dst_ip", "query", "qtype", "rcode", F.array_join("answers", " ").alias("answers"))


@query
def zeek_http(spark, sf):
    return _parsed_log(t.page_http(spark, sf), "http", {
        "id.resp_h": F.col("dst_ip"), "id.resp_p": F.when(F.col("seq") % 11 != 0, F.col("dst_port").cast("string")),
        "method": F.col("method"), "host": F.col("host"), "uri": F.col("uri"), "user_agent": F.col("user_agent"),
        "status_code": F.when(F.col("seq") % 3 == 0, "404").when(F.col("seq") % 3 == 1, "x").otherwise("200.0"),
        "request_body_len": F.when(F.col("seq") % 2 == 0, F.col("seq").cast("string")),
        "response_body_len": F.concat(F.col("seq").cast("string"), F.lit(".0")),
    }).select("case_id", "seq", "dst_ip", "dst_port", "method", "host", "uri", "user_agent", "status_code", "req_body_len", "resp_body_len")


@query
def zeek_ftp(spark, sf):
    return _parsed_log(t.order_ftp(spark, sf), "ftp", {
        "uid": F.col("uid"), "id.orig_h": F.col("src_ip"), "id.resp_h": F.col("dst_ip"), "command": F.col("command"),
        "arg": F.col("arg"), "reply_code": F.when(F.col("seq") % 2 == 0, "226"),
    }).select("case_id", "seq", "src_ip", "dst_ip", "command", "arg", "reply_code", "uid")


@query
def zeek_smtp(spark, sf):
    """One envelope per turn of every role."""
    base = t.read(spark, sf, "conversations").selectExpr(
        "concat('case-', conv_id % 7) AS case_id", "conv_id * 1000 + turn AS seq", "conv_id % 16 AS k",
        "concat('U', conv_id % 9, '@Example.com') AS sender", "concat('conversation ', conv_id, ' ', role) AS subject",
        "array(concat('u', turn % 9, '@example.com'), concat('c', conv_id, '@drop.example')) AS both",
    )
    return _parsed_log(base, "smtp", {
        "mailfrom": F.when(F.col("k") % 8 != 0, F.col("sender")), "rcptto": F.when(F.col("k") != 0, F.col("both")),
        "subject": F.col("subject"), "fuids": F.when(F.col("k") % 3 == 0, F.array(F.lit("F1"), F.lit("F2"))),
    }).select(
        "case_id", "seq", "mail_from", F.array_join("rcpt_to", " ").alias("rcpt_to"), "subject",
        F.array_join("attachments", " ").alias("attachments"),
    )


@query
def zeek_files(spark, sf):
    base = t.read(spark, sf, "events").selectExpr(
        "concat('case-', event_id % 7) AS case_id", "event_id AS seq", "concat('item ', event_id) AS filename",
        "CAST(floor(value * 10) AS bigint) AS size", "concat('10.0.0.', user_id) AS sender", "concat('198.51.100.', user_id) AS receiver",
        "sha2(CAST(event_id AS string), 256) AS digest", "array(concat('C', event_id), 'D') AS uids",
    )
    return _parsed_log(base, "files", {
        "filename": F.when(F.col("seq") % 5 != 0, F.col("filename")), "total_bytes": F.col("size").cast("string"), "sha256": F.col("digest"),
        "tx_hosts": F.array("sender", F.lit("192.0.2.1")), "rx_hosts": F.when(F.col("seq") % 4 != 0, F.array("receiver")),
        "conn_uids": F.col("uids"),
    }).select("case_id", "seq", "filename", "total_bytes", "sha256", "source_ip", "dest_ip", "uid")


def _raw_access(spark, sf):
    return t.read(spark, sf, "events").selectExpr(
        "concat('case-', event_id % 7) AS case_id", "event_id AS seq",
        "CASE event_id % 9 WHEN 0 THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") WHEN 1 THEN 'yesterday' "
        "WHEN 2 THEN NULL ELSE date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") END AS timestamp",
        "CASE user_id % 8 WHEN 0 THEN 'keystrokes' WHEN 1 THEN 'clipboard' WHEN 2 THEN 'bad_type' ELSE 'file_access' END AS data_type",
        "CASE WHEN event_id % 31 = 0 THEN '' ELSE 'NtCreateFile' END AS api_call",
        "CAST(NULL AS string) AS process", "concat(' C:/f', user_id, ' ') AS object_path", "'' AS object_name",
        "CAST(NULL AS string) AS access_operation",
        "CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS string) ELSE 'x' END AS process_id",
        "CAST(NULL AS string) AS process_path",
    )


@query
def access_ingest(spark, sf):
    return doc.validate_access_events(_raw_access(spark, sf)).select(
        "case_id", "seq", "ts", "data_type", "mitre_technique", "object_path", "object_name", "process_id", "error"
    )


@query
def access_report(spark, sf):
    return doc.access_report(doc.validate_access_events(_raw_access(spark, sf)))


@query
def static_prior_ingest(spark, sf):
    """One prior per customer, alternately in both accepted shapes."""
    docs = t.read(spark, sf, "customer").selectExpr(
        "concat('case-', c_custkey) AS case_id",
        "concat('{\"sample_sha256\":\"h', c_custkey, '\",', CASE WHEN c_custkey % 2 = 0 THEN '\"family\":\"F\"' "
        "ELSE '\"family_attribution\":{\"family\":\"G\"}' END, ',\"', "
        "CASE WHEN c_nationkey % 2 = 0 THEN 'c2_indicators' ELSE 'iocs' END, '\":[{\"type\":\"ip\",\"value\":\" 1.2.3.', "
        "c_nationkey, ' \",\"source\":\"cape_config\"},{\"type\":\"mutex\",\"value\":\"m\"},{\"value\":\"v\"},"
        "{\"type\":\"domain\",\"value\":\" \"},{\"type\":\"url\",\"value\":\"http://x', c_custkey, '.example/g\"}]}') AS raw",
    )
    return doc.parse_static_priors(docs).select("case_id", "seq", "sample_sha256", "family", "type", "value", "source", "error")


@query
def handoff_manifest(spark, sf):
    m = t.manifests(spark, sf)
    return m.select(
        "case_id", "session_id", "cape_task_id", rules.network_mode(F.col("network_mode")).alias("mode"),
        "clock_quality_acceptable", "telemetry_degraded", F.array_join("providers_unavailable", ",").alias("providers"),
        cn.normal_guest(F.col("guest_ip")).alias("guest_ip"), "host_network_correlation_enabled", "correlation_reason",
        "access_events_path", rules.pinning_suspected(F.col("tls_interception_status")).alias("pinned"),
        F.array_join(F.array_sort(rules.degraded_types(F.col("providers_unavailable"))), ",").alias("blind_types"),
        rules.degraded_everywhere(F.col("providers_unavailable")).alias("blind_everywhere"),
    )


@query
def manifest_sidecars(spark, sf):
    """Manifests with their clock and access-status documents."""
    cases = t.read(spark, sf, "nation")
    clock = cases.selectExpr(
        "concat('case-', n_nationkey) AS case_id",
        "concat('{\"algorithm\":\"a', n_regionkey, '\",\"measurements\":{\"start\":{\"uncertainty_ns\":', n_nationkey * 1000000L, "
        "'},\"end\":{\"uncertainty_ns\":', n_regionkey * 5000000L, '}},\"quality\":{\"acceptable\":', "
        "CASE WHEN n_nationkey % 2 = 0 THEN 'true' ELSE 'false' END, '}}') AS raw",
    )
    status = cases.selectExpr(
        "concat('case-', n_nationkey) AS case_id",
        "concat('{\"source\":\"etw', n_regionkey, '\",\"correlation_eligible\":', CASE WHEN n_nationkey % 3 = 0 THEN 'false' ELSE 'true' END, "
        "',\"rejected_event_count\":', n_nationkey % 4, ',\"reason_code\":\"c', n_nationkey, '\"}') AS raw",
    )
    return doc.parse_manifests(t.manifest_documents(spark, sf), clock, status).select(
        "case_id", "clock_uncertainty_ms", "clock_algorithm", "clock_quality_reported", "access_events_source",
        "access_events_correlation_eligible", "access_events_rejected_count", "correlation_reason",
    )


@query
def allowlist_file(spark, sf):
    """The built-in names and those of one site document per supplier; malformed networks are left out."""
    docs = t.read(spark, sf, "supplier").selectExpr(
        "concat('{\"domains\":[\" Site', s_suppkey, '.COM \",\"all.example\"],\"cidrs\":[\"203.0.', s_nationkey, '.0/', "
        "CASE WHEN s_suppkey % 5 = 0 THEN '99' ELSE '24' END, '\"]}') AS raw"
    )
    domains, cidrs = doc.parse_allowlist(docs)
    return domains.select(F.lit("domain").alias("kind"), F.col("domain").alias("value")).unionByName(
        cidrs.select(F.lit("cidr").alias("kind"), F.col("cidr").alias("value"))
    )


@query
def clock_quality(spark, sf):
    docs = t.read(spark, sf, "supplier").selectExpr(
        "concat('case-', s_suppkey) AS case_id",
        "concat('{\"algorithm\":\"linear\",\"measurements\":{\"start\":{\"uncertainty_ns\":', s_suppkey * 1000000L, "
        "'},\"end\":{\"uncertainty_ns\":', s_nationkey * 2000000L, '}},\"quality\":{\"acceptable\":', "
        "CASE WHEN s_suppkey % 2 = 0 THEN 'true' ELSE 'false' END, "
        "CASE WHEN s_suppkey % 3 = 0 THEN ',\"maximum_observed_uncertainty_ns\":502000000' ELSE '' END, '}}') AS raw",
    )
    return doc.parse_clock_quality(docs).withColumn("slack_s", rules.window_slack_s(F.col("clock_uncertainty_ms")))


def _feodo_lines(spark, sf):
    return t.read(spark, sf, "customer").selectExpr(
        "c_custkey AS seq",
        "CASE WHEN c_custkey % 50 = 0 THEN '# comment' WHEN c_custkey % 51 = 0 THEN "
        "'\"first_seen_utc\",\"dst_ip\",\"dst_port\",\"c2_status\",\"last_online\",\"malware\"' ELSE "
        f"concat('\"2026-01-01\",\"', {t.address('c_custkey')}, '\",\"', 400 + c_nationkey, '\",\"online\",\"x\",\"', "
        "c_mktsegment, '\"') END AS value",
    )


def _urlhaus_lines(spark, sf):
    return t.read(spark, sf, "pages").selectExpr(
        "page_id AS seq",
        "CASE WHEN page_id % 40 = 0 THEN '\"id\",\"dateadded\",\"url\",\"s\",\"l\",\"threat\",\"tags\"' ELSE "
        "concat('\"', page_id, '\",\"d', page_id, '\",\"', CASE page_id % 5 WHEN 0 THEN 'https://Raw.GithubUserContent.com/x' "
        "WHEN 1 THEN concat('http://203.0.113.', page_id % 250, ':8080/a') WHEN 2 THEN 'https://urlhaus.abuse.ch/u/1' "
        "ELSE regexp_replace(url, ',', '') END, '\",\"online\",\"x\",\"malware_download\",\"', "
        "CASE WHEN page_id % 2 = 0 THEN 'exe' ELSE '' END, '\"') END AS value",
    )


def _threatfox_lines(spark, sf):
    return t.read(spark, sf, "orders").selectExpr(
        "o_orderkey AS seq",
        "concat('\"d', o_orderkey, '\", \"', o_orderkey, '\", \"', CASE o_orderkey % 5 "
        f"WHEN 0 THEN concat({t.address('o_custkey')}, ':', 1000 + o_orderkey % 9) WHEN 1 THEN concat('C', o_custkey, '.Example.com') "
        "WHEN 2 THEN 'cdn.discordapp.com' WHEN 3 THEN 'http://x/y' ELSE concat('198.51.100.', o_custkey % 250) END, '\", \"', "
        "CASE o_orderkey % 5 WHEN 0 THEN 'ip:port' WHEN 1 THEN 'domain' WHEN 2 THEN 'domain' WHEN 3 THEN 'url' ELSE 'other' END, "
        "'\", \"botnet_cc\", \"win.x\", \"None\", \"', CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'Remcos' END, '\", \"\", \"75\"') AS value",
    )


@query
def feed_feodo(spark, sf):
    return fd.parse_feodo(_feodo_lines(spark, sf))


@query
def feed_urlhaus(spark, sf):
    return fd.parse_urlhaus(_urlhaus_lines(spark, sf))


@query
def feed_threatfox(spark, sf):
    return fd.parse_threatfox(_threatfox_lines(spark, sf))


@query
def feed_list(spark, sf):
    lines = t.read(spark, sf, "supplier").selectExpr(
        "s_suppkey AS seq",
        "CASE WHEN s_suppkey % 9 = 0 THEN '# note' ELSE concat('\"Evil', s_suppkey % 40, '.example\", x') END AS value",
    )
    return fd.parse_indicator_list(lines).drop("last_seen")


def _feed_files(spark, sf):
    parts = [("threatfox.csv", _threatfox_lines(spark, sf)), ("feodo_ipblocklist.csv", _feodo_lines(spark, sf)),
             ("urlhaus.csv", _urlhaus_lines(spark, sf))]
    out = None
    for name, lines in parts:
        part = lines.withColumn("file_name", F.lit(name))
        out = part if out is None else out.unionByName(part)
    listed = t.read(spark, sf, "supplier").selectExpr(
        "s_suppkey AS seq", "concat('c', s_suppkey, '.example.com') AS value", "'dga_list.txt' AS file_name"
    )
    return out.unionByName(listed)


@query
def feed_refresh(spark, sf):
    return fd.merge_indicators(fd.demo_indicators(spark), fd.known_fingerprints(spark), fd.parse_feeds(_feed_files(spark, sf)))


@query
def feed_guard(spark, sf):
    return fd.indicator_guard(fd.merge_indicators(fd.demo_indicators(spark), fd.known_fingerprints(spark), fd.parse_feeds(_feed_files(spark, sf))))


@query
def intel_counts(spark, sf):
    return fd.indicator_counts(t.intel(spark, sf))


@query
def ground_truth(spark, sf):
    docs = t.read(spark, sf, "supplier").selectExpr(
        "'gt' AS case_id",
        "concat('{\"cap', s_suppkey, '\":{\"malicious_ips\":[', CASE WHEN s_nationkey % 3 = 0 THEN '' ELSE "
        "concat('\"1.2.3.', s_nationkey, '\"') END, '],\"malicious_domains\":[\"d', s_suppkey, '.example\"],\"benign\":', "
        "CASE WHEN s_suppkey % 4 = 0 THEN 'true' ELSE 'false' END, '}}') AS raw",
    )
    return doc.parse_ground_truth(docs)


# --- the whole analysis ---------------------------------------------------------------------------------------------------------


def _case_tables(spark, sf):
    sessions = t.sessions(spark, sf)
    http = t.page_http(spark, sf).unionByName(t.order_http(spark, sf))
    return {
        "sessions": sessions, "http": http, "ftp": t.order_ftp(spark, sf), "dns": t.dns(spark, sf),
        "tls": t.page_tls(spark, sf), "smtp": t.smtp(spark, sf), "icmp": t.icmp(spark, sf),
    }


def _context(spark, sf):
    # The manifests end their detonation before the events and pages of the test tables begin.
    manifests = t.manifests(spark, sf).withColumn("detonation_end_utc", F.lit("2030-01-01T00:00:00+00:00"))
    return Context(
        intel=t.intel(spark, sf), static_iocs=t.static_iocs(spark, sf), manifests=manifests,
        access=t.access(spark, sf).withColumn("ts", F.col("ts") * 60), artifacts=t.artifacts(spark, sf),
        samples=t.manifests(spark, sf).select("case_id", F.sha2("case_id", 256).alias("sample_id")),
        stage=reliable_checkpoint,
    )


@query
def network_findings(spark, sf):
    """Every finding of every case after scope, enrichment, tiers and gates."""
    return case_findings(_case_tables(spark, sf), _context(spark, sf)).select(
        "case_id", "kind", "dst_ip", "dst_port", "destination_domain", "confidence", "confidence_tier",
        "reputation_hit", "reputation_note", "static_match", "allowlist_match", "capped_by_caveat",
    )


@query
def case_events(spark, sf):
    """The 29-column event rows of every case, hash-chained."""
    return analyse(_case_tables(spark, sf), _context(spark, sf))["events"]


@query
def case_event_rows(spark, sf):
    """The event rows of every case in full but for the columns that hash or name other rows."""
    rows = analyse(_case_tables(spark, sf), _context(spark, sf))["chained_events"]
    return rows.select(
        "case_id", F.col("chain_order.stage").alias("stage"), F.col("chain_order.access").alias("access_seq"), "timestamp", "data_type_accessed",
        "destination_ip", "destination_port", "destination_domain", "reputation_score", "reputation_note", "reputation_source", "plaintext_available",
        "confidence_score", "confidence_tier", "mitre_technique_id", "finding_kind", "plain_language", "capped_by_caveat",
    )


@query
def dga_learned(spark, sf):
    asked = reliable_checkpoint(dn.name_index(t.dns(spark, sf).withColumn("query", F.lower("query"))))
    weights = dga.name_features(_labels(spark, sf, asked)).select("feature").distinct().withColumn(
        "weight", ((F.ascii(F.substr("feature", F.lit(4))) % 7) - 3) * 2.0
    )
    return dga.detect_dga_ml(asked, weights, -0.25, min_prob=0.6).select(
        "case_id", "kind", "domain", "query_count", "avg_sub_len", "confidence",
        F.array_join("resolver_ips", ",").alias("resolvers"),
    )


@query
def zeek_ssl(spark, sf):
    """ssl.log lines built from pages, then fingerprint records (last row of a key wins)."""
    base = t.page_tls(spark, sf).withColumn("file", F.concat("case_id", F.lit("/ssl.log")))
    names = ["ts", "id.orig_h", "id.resp_h", "id.resp_p", "server_name", "ja3", "ja3s", "subject"]
    values = [F.lit("1.0"), F.col("src_ip"), F.col("dst_ip"), F.col("dst_port").cast("string"),
              F.when(F.col("seq") % 7 == 0, "(empty)").otherwise(F.col("server_name")), F.col("ja3"), F.col("ja3s"),
              F.when(F.col("seq") % 3 == 0, "-").otherwise(F.col("subject"))]
    body = base.select("case_id", "file", "seq", F.concat_ws("\t", *values).alias("value"))
    head = base.select("case_id", "file").distinct().select(
        "case_id", "file", F.lit(-1).cast("bigint").alias("seq"), F.lit("#fields\t" + "\t".join(names)).alias("value")
    )
    return zeek.fingerprints_from_ssl_log(zeek.parse_log(body.unionByName(head), zeek.LOG_FIELDS["ssl"]))


def _dns_messages(spark, sf):
    return t.dns(spark, sf).select(
        "case_id", "seq", "ts", "src_ip", "dst_ip", F.concat("query", F.lit(".")).alias("query"),
        F.when(F.col("qtype") == "TXT", 16).otherwise(1).alias("qtype"),
        F.when(F.col("rcode") == "NXDOMAIN", 3).otherwise(0).alias("rcode"),
        (F.col("seq") % 10 == 0).alias("is_response"),
    )


def _icmp_packets(spark, sf):
    return t.packets(spark, sf).withColumn(
        "icmp_type", F.when(F.col("seq") % 9 == 0, 8).when(F.col("seq") % 9 == 1, 0).when(F.col("seq") % 9 == 2, 3)
    )


@query
def packet_tables(spark, sf):
    """The rows of the case tables derived from packets, for the cases without logs."""
    logged = t.read(spark, sf, "region").selectExpr("concat('case-', r_regionkey) AS case_id")
    tables = fl.tables_from_packets(
        _icmp_packets(spark, sf), _dns_messages(spark, sf), tl.fingerprint_hellos(_hellos(spark, sf)), logged
    )
    detail = {
        "sessions": F.concat_ws("|", "src_ip", "dst_port", "orig_bytes", "resp_bytes"),
        "dns": F.concat_ws("|", "query", "qtype", "rcode"), "http": F.concat_ws("|", "method", "host", "uri"),
        "ftp": F.concat_ws("|", "command", "arg"), "tls": F.concat_ws("|", "server_name", "ja3", "ja4"),
        "smtp": F.concat_ws("|", "mail_from", "subject"), "icmp": F.col("data_len").cast("string"),
    }
    out = None
    for name, text in detail.items():
        rows = tables[name].select("case_id", F.lit(name).alias("table_name"), "seq", "dst_ip", text.alias("detail"))
        out = rows if out is None else out.unionByName(rows)
    return out


# Lines of a log that are written in one piece, below one header.
PIECE_LINES = 1 << 18
# A task writes so many pieces at least, if there are as many lines.
TASK_PIECES = 8


def _write_case_logs(logs, decoded, header, folder, piece_lines=PIECE_LINES, compress=False):
    """Logs and decoded packets (case_id, log, seq, value) as the folder layout of `sources.cases`.

    A log is written in pieces, as rotated logs are, and each begins with the header. Every task sorts and writes
    the lines it has made: they are not dealt, so no shuffle holds the whole text beside the files. Lines without
    a place come before any header, in files of their own.
    """
    # The header is that of a CSV file with one column, whose text is neither quoted nor trimmed; # is no comment there.
    plain = {
        "header": True, "sep": "\u0001", "comment": "\u0002", "quote": "", "nullValue": "", "emptyValue": "",
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    }
    unplaced = F.col("seq").isNull()
    bare = decoded.unionByName(logs.filter(unplaced))
    for lines, kind, name, options in ((logs.filter(~unplaced), "csv", header, plain), (bare, "text", "value", {})):
        # Where most splits have few lines, they are written together: else their pieces are many and short.
        splits, total = lines.groupBy(F.spark_partition_id()).count().agg(F.count(F.lit(1)), F.sum("count")).first()
        tasks = max(-(-(total or 0) // (TASK_PIECES * piece_lines)), 1)
        place = ["case_id", "log"]
        own = (lines.coalesce(tasks) if 2 * tasks <= splits else lines).sortWithinPartitions(*place, "seq")
        own = own.select(*place, F.col("value").alias(name))
        writer = own.write.mode("append").partitionBy(*place).option("maxRecordsPerFile", piece_lines).options(**options)
        (packed(writer) if compress else writer).format(kind).save(folder)


@query
def case_sources(spark, sf):
    """A folder with decoded packets of all cases, read by what each case has.

    Cases 0 to 3 have a connection log; the others have a log of no known type and are read from their packets.
    """
    number = F.substr("case_id", F.lit(6)).cast("int")
    names = ["ts", "id.orig_h", "id.orig_p", "id.resp_h", "id.resp_p", "proto", "orig_bytes", "resp_bytes", "history"]
    values = ["ts", "src_ip", "src_port", "dst_ip", "dst_port", "proto", "orig_bytes", "resp_bytes", "history"]
    sessions = t.sessions(spark, sf).withColumn("log", F.when(number <= 3, "conn").otherwise("conn-summary"))
    conn = sessions.select("case_id", "log", "seq", F.concat_ws("\t", *[F.col(v).cast("string") for v in values]).alias("value"))
    packets = _icmp_packets(spark, sf).withColumn("payload", F.base64("payload"))
    decoded = packets.select(
        "case_id", F.lit("packets").alias("log"), "seq", F.to_json(F.struct(*[c for c in packets.columns if c != "case_id"])).alias("value")
    )
    folder = work_folder(spark, "cases")
    _write_case_logs(conn, decoded, "#fields\t" + "\t".join(names), folder, compress=True)
    tables = case_files.read_case_tables(spark, folder)
    return tables["sessions"].join(stored(tables["case_sources"], "case-sources"), "case_id").select(
        "case_id", "source", "src_ip", "dst_ip", "dst_port", "orig_bytes", "resp_bytes"
    )


@query
def object_labels(spark, sf):
    """Whole document texts as object names, elided in the middle when over-long."""
    return t.read(spark, sf, "documents").select("doc_id", rules.object_label(F.col("text")).alias("label"))
