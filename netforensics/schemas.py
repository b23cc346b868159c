"""Table schemas. Every record table carries `case_id` and `seq` (input order within the case)."""

SESSIONS = (
    "case_id string, seq bigint, ts double, src_ip string, src_port int, dst_ip string, dst_port int, proto string, "
    "service string, orig_bytes bigint, resp_bytes bigint, history string, duration double, conn_state string, uid string"
)
DNS = (
    "case_id string, seq bigint, ts double, src_ip string, dst_ip string, query string, qtype string, rcode string, "
    "answers array<string>, uid string"
)
HTTP = (
    "case_id string, seq bigint, ts double, src_ip string, dst_ip string, dst_port int, method string, host string, "
    "uri string, user_agent string, status_code int, req_body_len bigint, resp_body_len bigint, uid string"
)
TLS = (
    "case_id string, seq bigint, ts double, src_ip string, dst_ip string, dst_port int, server_name string, ja3 string, "
    "ja3s string, ja4 string, subject string, issuer string, validation_status string, version string, uid string"
)
FTP = (
    "case_id string, seq bigint, ts double, src_ip string, dst_ip string, command string, arg string, "
    "reply_code int, uid string"
)
SMTP = (
    "case_id string, seq bigint, ts double, src_ip string, dst_ip string, mail_from string, rcpt_to array<string>, "
    "subject string, attachments array<string>, uid string"
)
ICMP = "case_id string, seq bigint, src_ip string, dst_ip string, data_len int"
ARTIFACTS = (
    "case_id string, seq bigint, ts double, filename string, mime_type string, total_bytes bigint, md5 string, "
    "sha256 string, source_ip string, dest_ip string, is_outbound boolean, uid string, preview string"
)
ACCESS = (
    "case_id string, seq bigint, ts double, raw_timestamp string, data_type string, api_call string, process string, "
    "mitre_technique string, capability string, object_path string, object_name string, access_operation string, "
    "process_id int, process_path string"
)
INTEL = "value string, source string, note string, indicator_type string, last_seen string"
STATIC_IOCS = (
    "case_id string, seq bigint, sample_sha256 string, family string, type string, value string, source string, "
    "evidence_origin string"
)
MANIFEST = (
    "case_id string, schema_version string, session_id string, cape_task_id int, network_mode string, "
    "clock_quality_acceptable boolean, telemetry_degraded boolean, providers_unavailable array<string>, "
    "guest_ip string, detonation_start_utc string, detonation_end_utc string, hash_manifest_sha256 string, "
    "access_events_path string, access_event_count int, host_network_correlation_enabled boolean, "
    "correlation_reason string, clock_uncertainty_ms double, clock_algorithm string, clock_quality_reported boolean, "
    "access_events_source string, access_events_correlation_eligible boolean, access_events_rejected_count int, "
    "etw_corroboration_state string, tls_interception_status string"
)
FINDINGS = (
    "case_id string, kind string, kind_rank int, seq bigint, dst_ip string, dst_port int, event_time double, "
    "confidence double, reputation_hit boolean, reputation_source string, reputation_note string, "
    "geo_country string, asn string, asn_org string, destination_domain string, ja3_hash string, ja4 string, "
    "plaintext_available boolean, preset_tier string, http_uri string, http_reason string, dns_evidence string, "
    "cert_reason string, cloud_service string, cloud_direction string, smtp_subject string, smtp_rcpt array<string>, "
    "covert_detail string, egress_detail string, beacon_note string, mean_interval_s double, jitter_ratio double, "
    "handshake_ratio double, match_on string"
)
EVENT_COLUMNS = [
    "event_id", "sample_id", "session_id", "cape_task_id", "platform", "timestamp", "data_type_accessed",
    "access_api_call", "destination_ip", "destination_port", "destination_domain", "asn", "asn_org", "geo_country",
    "reputation_score", "reputation_note", "reputation_source", "ja3_hash", "plaintext_available",
    "confidence_score", "confidence_tier", "mitre_technique_id", "manifest_sha256", "evidence_hash", "case_id",
    "finding_kind", "plain_language", "capped_by_caveat", "evidence_refs",
]


def field_types(schema: str) -> list[tuple[str, str]]:
    """(name, type) pairs of a schema text."""
    return [tuple(part.strip().split(" ", 1)) for part in schema.split(", ")]
