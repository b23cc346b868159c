"""Network-forensics record tables derived from the general test tables.

The test data holds no logs, so each query starts from one of these projections. Every adapter
maps whole tables; nothing is sampled or cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Tables = dict[str, DataFrame]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, in the splits that Spark's reader makes of it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def address(key: str) -> str:
    """Destination address of a numeric key; every eleventh one is internal."""
    return (
        f"CASE WHEN {key} % 11 = 0 THEN concat('192.168.', ({key} div 250) % 250, '.', {key} % 250 + 1) "
        f"ELSE concat('203.', ({key} div 62500) % 250, '.', ({key} div 250) % 250, '.', {key} % 250 + 1) END"
    )


def epoch(column: str) -> str:
    return f"unix_micros(CAST({column} AS timestamp)) / 1e6"


def connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: one connection per line item."""
    return read(spark, sf_dir, "lineitem").selectExpr(
        "concat('case-', l_orderkey % 7) AS case_id",
        "l_orderkey * 8 + l_linenumber AS seq",
        f"{epoch('l_shipdate')} AS ts",
        "concat('10.0.0.', l_orderkey % 200 + 1) AS src_ip",
        f"{address('l_orderkey')} AS dst_ip",
        "443 AS dst_port",
        "'tcp' AS proto",
        "CAST(l_quantity * 1000 AS bigint) AS orig_bytes",
        "CASE WHEN l_orderkey % 13 = 0 THEN 0L ELSE CAST(floor(l_extendedprice) AS bigint) END AS resp_bytes",
        "CASE WHEN l_linestatus = 'O' AND l_orderkey % 13 <> 0 THEN 'Sh' ELSE 'S' END AS history",
        "CASE l_returnflag WHEN 'R' THEN 'POST' WHEN 'A' THEN 'GET' END AS http_method",
        "CASE WHEN l_returnflag <> 'N' THEN concat('Host', l_suppkey % 97, '.example.com:8080') END AS http_host",
        "CASE l_returnflag WHEN 'R' THEN concat('/gate.php?item=', l_partkey) WHEN 'A' THEN '/index.html' END AS http_uri",
        "CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN concat('STOR part', l_partkey, '.zip') END AS ftp_upload_cmd",
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions without application data; half of them carry a uid."""
    return read(spark, sf_dir, "lineitem").selectExpr(
        "concat('case-', l_orderkey % 7) AS case_id",
        "l_orderkey * 8 + l_linenumber AS seq",
        f"{epoch('l_shipdate')} AS ts",
        "concat('10.0.0.', l_orderkey % 200 + 1) AS src_ip",
        "40000 + l_linenumber AS src_port",
        f"{address('l_orderkey')} AS dst_ip",
        "443 AS dst_port",
        "'tcp' AS proto",
        "CAST(NULL AS string) AS service",
        "CAST(l_quantity * 1000 AS bigint) AS orig_bytes",
        "CAST(floor(l_extendedprice) AS bigint) AS resp_bytes",
        "CASE WHEN l_linestatus = 'O' THEN 'Sh' ELSE 'S' END AS history",
        "0.0D AS duration",
        "CAST(NULL AS string) AS conn_state",
        "CASE WHEN l_linestatus = 'O' THEN concat('C', l_orderkey, '-', l_linenumber) END AS uid",
    )


def order_http(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One HTTP request per order; the first line of an open order is linked by uid."""
    return read(spark, sf_dir, "orders").selectExpr(
        "concat('case-', o_orderkey % 7) AS case_id",
        "o_orderkey AS seq",
        f"{epoch('o_orderdate')} AS ts",
        "concat('10.0.0.', o_orderkey % 200 + 1) AS src_ip",
        f"{address('o_orderkey')} AS dst_ip",
        "CASE WHEN o_orderkey % 3 = 0 THEN 8081 ELSE 443 END AS dst_port",
        "CASE WHEN o_orderstatus = 'P' THEN 'POST' ELSE 'GET' END AS method",
        "concat('cust', o_custkey % 50, '.example.net') AS host",
        "concat('/o/', o_orderkey) AS uri",
        "CAST(NULL AS string) AS user_agent",
        "CASE WHEN o_orderstatus = 'O' THEN concat('C', o_orderkey, '-1') END AS uid",
    )


def order_ftp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One FTP command per order."""
    return read(spark, sf_dir, "orders").selectExpr(
        "concat('case-', o_orderkey % 7) AS case_id",
        "o_orderkey AS seq",
        f"{epoch('o_orderdate')} AS ts",
        "concat('10.0.0.', o_orderkey % 200 + 1) AS src_ip",
        f"{address('o_orderkey')} AS dst_ip",
        "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'STOR' WHEN '2' THEN 'appe' ELSE 'RETR' END AS command",
        "concat('doc', o_custkey, '.zip') AS arg",
        "CASE WHEN o_orderstatus = 'O' THEN concat('C', o_orderkey, '-2') END AS uid",
    )


def dns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: one query per event plus one per page host."""
    events = read(spark, sf_dir, "events").selectExpr(
        "concat('case-', event_id % 7) AS case_id",
        "event_id * 2 AS seq",
        f"{epoch('ts')} AS ts",
        "concat('10.0.0.', user_id % 200 + 1) AS src_ip",
        "concat('10.0.1.', 53 + user_id % 3) AS dst_ip",
        "CASE event_type WHEN 'error' THEN concat(md5(CAST(event_id AS string)), '.com') "
        "WHEN 'purchase' THEN concat(md5(CAST(event_id AS string)), '.t', user_id % 5, '-update.com') "
        "WHEN 'view' THEN concat('WWW.Site', user_id, '.com') "
        "WHEN 'click' THEN 'v10.events.data.microsoft.com' ELSE 'drive.google.com' END AS query",
        "CASE WHEN event_type = 'purchase' THEN 'TXT' ELSE 'A' END AS qtype",
        "CASE WHEN event_type = 'error' THEN 'NXDOMAIN' ELSE 'NOERROR' END AS rcode",
    )
    pages = read(spark, sf_dir, "pages").selectExpr(
        "concat('case-', page_id % 7) AS case_id",
        "page_id * 2 + 1 AS seq",
        "1704067200.0D + page_id AS ts",
        "concat('10.0.0.', page_id % 200 + 1) AS src_ip",
        "'10.0.1.53' AS dst_ip",
        "regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS query",
        "'A' AS qtype",
        "'NOERROR' AS rcode",
    )
    return events.unionByName(pages)


def dga_dns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: clicks and signups as names that exist, all other events as names that do not."""
    return read(spark, sf_dir, "events").selectExpr(
        "concat('case-', event_id % 7) AS case_id", "event_id AS seq", f"{epoch('ts')} AS ts",
        "'10.0.0.5' AS src_ip", "'10.0.1.53' AS dst_ip",
        "CASE WHEN event_type IN ('click', 'signup') THEN concat('www.site', user_id, '.com') "
        "ELSE concat(md5(CAST(event_id AS string)), '.com') END AS query", "'A' AS qtype",
        "CASE WHEN event_type IN ('click', 'signup') THEN 'NOERROR' ELSE 'NXDOMAIN' END AS rcode",
    )


def _cloud_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").selectExpr(
        "concat('case-', event_id % 7) AS case_id", "event_id AS seq", f"{epoch('ts')} AS ts",
        "concat('10.0.0.', user_id % 200 + 1) AS src_ip",
        "concat('203.0.', user_id % 6, '.', user_id % 250 + 1) AS dst_ip",
        "443 AS dst_port",
        "CASE user_id % 7 WHEN 0 THEN 'api.telegram.org' WHEN 1 THEN 'Drive.Google.com' "
        "WHEN 2 THEN 'cdn.discordapp.com' WHEN 3 THEN 'www.dropbox.com' WHEN 4 THEN 'www.example.org' "
        "WHEN 5 THEN 'dns.google' ELSE 'mega.nz' END AS host",
        "event_type", "CAST(floor(value * 10) AS bigint) AS orig_bytes", "event_id % 997 AS resp_bytes",
    )


def cloud_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """A5: clicks and signups are TLS rows, all other events HTTP rows; every event is a session."""
    base = _cloud_base(spark, sf_dir)
    none = F.lit(None).cast("string")
    tls = base.filter("event_type IN ('click', 'signup')").withColumnRenamed("host", "server_name").drop("event_type")
    http = base.filter("event_type NOT IN ('click', 'signup')").drop("event_type")
    return {
        "tls": tls.select(
            "case_id", "seq", "ts", "src_ip", "dst_ip", "dst_port", "server_name",
            *[none.alias(c) for c in ("ja3", "ja3s", "ja4", "subject", "issuer", "validation_status")],
        ),
        "http": http.select(
            "case_id", "seq", "ts", "src_ip", "dst_ip", "dst_port", "host",
            *[none.alias(c) for c in ("method", "uri", "user_agent", "uid")],
        ),
        "sessions": base.select("case_id", "seq", "ts", "src_ip", "dst_ip", "dst_port", "orig_bytes", "resp_bytes"),
    }


def page_http(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6: one HTTP request per page, some of them to gate paths."""
    return read(spark, sf_dir, "pages").selectExpr(
        "concat('case-', page_id % 7) AS case_id", "page_id AS seq", "1704067200.0D + page_id AS ts",
        "concat('10.0.0.', page_id % 200 + 1) AS src_ip",
        "concat('203.0.113.', page_id % 40) AS dst_ip",
        "CASE page_id % 4 WHEN 0 THEN 80 WHEN 1 THEN 8080 WHEN 2 THEN 55123 ELSE 443 END AS dst_port",
        "CASE WHEN page_id % 2 = 0 THEN 'GET' ELSE 'POST' END AS method",
        "regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host",
        "CASE page_id % 9 WHEN 0 THEN '/Gate.PHP' WHEN 1 THEN '/panel/x' WHEN 2 THEN '/gate' "
        "ELSE regexp_replace(url, '^[a-z]+://[^/]+', '') END AS uri",
        "CASE page_id % 5 WHEN 0 THEN 'curl' WHEN 1 THEN 'Mozilla/5.0' WHEN 2 THEN '' "
        "WHEN 3 THEN 'Mozilla/5.0 (X11)' END AS user_agent",
        "CAST(NULL AS string) AS uid",
    )


def page_tls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: one TLS session per page."""
    host = "regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)"
    return read(spark, sf_dir, "pages").selectExpr(
        "concat('case-', page_id % 7) AS case_id", "page_id AS seq", "1704067200.0D + page_id AS ts",
        "concat('10.0.0.', page_id % 3 + 1) AS src_ip",
        "concat('203.0.113.', page_id % 60) AS dst_ip",
        "CASE WHEN page_id % 4 = 0 THEN 4444 ELSE 443 END AS dst_port",
        f"{host} AS server_name",
        f"md5({host}) AS ja3",
        f"md5(concat('s', {host})) AS ja3s",
        "CAST(NULL AS string) AS ja4",
        f"concat('CN=', {host}) AS subject",
        f"CASE WHEN page_id % 5 = 0 THEN concat('CN=', {host}) ELSE 'CN=Root' END AS issuer",
        "CASE page_id % 6 WHEN 1 THEN 'Certificate expired' WHEN 2 THEN 'ok' WHEN 3 THEN '-' END AS validation_status",
    )


def smtp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7: one envelope per turn; those of other roles are written by the conversation's service."""
    return read(spark, sf_dir, "conversations").selectExpr(
        "concat('case-', conv_id % 7) AS case_id", "conv_id * 1000 + turn AS seq", "1704067200.0D + conv_id AS ts",
        "concat('10.0.0.', conv_id % 200 + 1) AS src_ip", "concat('198.51.100.', conv_id % 50) AS dst_ip",
        "CASE WHEN role <> 'user' THEN concat('bot', conv_id % 5, '@service.example') "
        "WHEN conv_id % 8 <> 0 THEN concat('U', conv_id % 9, '@Example.com') END AS mail_from",
        "CASE WHEN conv_id % 16 = 0 THEN CAST(array() AS array<string>) "
        "ELSE array(concat('u', turn % 9, '@example.com'), concat('c', conv_id, '@drop.example')) END AS rcpt_to",
        "concat('conversation ', conv_id, ' turn ', turn) AS subject",
        "CASE WHEN length(text) % 3 = 0 THEN array('attachment') ELSE CAST(array() AS array<string>) END AS attachments",
        "CAST(NULL AS string) AS uid",
    )


def icmp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8: one echo per event; only those of errors carry as much data as the event's value."""
    return read(spark, sf_dir, "events").selectExpr(
        "concat('case-', event_id % 2) AS case_id", "event_id AS seq", "'10.0.0.5' AS src_ip",
        "CASE WHEN event_type = 'error' THEN concat('198.51.', user_id div 250, '.', user_id % 250) "
        "ELSE concat('198.52.', user_id div 250, '.', user_id % 250) END AS dst_ip",
        "CAST(CASE WHEN event_type = 'error' THEN floor(value) ELSE 56 END AS int) AS data_len",
    )


ACCESS_TYPES = ["browser_credentials", "keystrokes", "screenshot", "clipboard", "crypto_wallet", "system_info",
                "file_access"]


def access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9, host side: all events but purchases and signups (those are the network side), minutes read as seconds."""
    types = ", ".join(f"'{t}'" for t in ACCESS_TYPES)
    rows = read(spark, sf_dir, "events").filter("event_type NOT IN ('purchase', 'signup')").selectExpr(
        "concat('case-', event_id % 7) AS case_id", "event_id AS seq", f"{epoch('ts')} / 60 AS ts",
        f"concat('t', CAST(rint({epoch('ts')} / 60 * 1e6) AS bigint)) AS raw_timestamp",
        f"element_at(array({types}), CAST(user_id % 7 AS int) + 1) AS data_type",
        "CASE WHEN event_type = 'click' THEN 'GetClipboardData' ELSE 'NtReadFile' END AS api_call",
        "concat('proc', user_id % 5, '.exe') AS process",
        "CASE WHEN user_id % 3 = 0 THEN concat('C:/Users/u', user_id, '/Login Data') END AS object_path",
        "CASE WHEN user_id % 2 = 0 THEN 'Login Data' END AS object_name",
        "CAST(user_id AS int) AS process_id",
        "CAST(NULL AS string) AS process_path",
    )
    technique = (
        "CASE data_type WHEN 'browser_credentials' THEN 'T1555.003' WHEN 'keystrokes' THEN 'T1056.001' "
        "WHEN 'screenshot' THEN 'T1113' WHEN 'clipboard' THEN 'T1115' WHEN 'system_info' THEN 'T1082' ELSE 'T1005' END"
    )
    return rows.selectExpr("*", f"{technique} AS mitre_technique")


def network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9, network side: purchases and signups as findings (all other events are the host side)."""
    return read(spark, sf_dir, "events").filter("event_type IN ('purchase', 'signup')").selectExpr(
        "concat('case-', event_id % 7) AS case_id",
        "named_struct('kind_rank', 0, 'seq', event_id, 'name', '') AS finding_no",
        "CASE WHEN event_type = 'purchase' THEN 'exfil' ELSE 'http_c2' END AS kind",
        "0 AS kind_rank",
        "concat('198.51.100.', user_id) AS dst_ip",
        "CAST(443 + user_id % 2 AS int) AS dst_port",
        f"{epoch('ts')} / 60 AS event_time",
        "0.5D + (user_id % 5) / 10 AS confidence",
        "event_type = 'signup' AND user_id % 2 = 0 AS reputation_hit",
        "CASE WHEN user_id % 4 = 0 THEN 'events.data.microsoft.com' WHEN user_id % 4 = 1 "
        "THEN concat('drop', user_id, '.example.com') END AS destination_domain",
        "event_type = 'signup' AS plaintext_available",
        "CASE WHEN event_type = 'signup' THEN concat('/gate.php?otp=', user_id) END AS http_uri",
        "CASE WHEN user_id % 3 = 0 THEN 'weak' ELSE 'strong' END AS confidence_tier",
        "CAST(NULL AS string) AS ja3_hash", "CAST(NULL AS string) AS ja4",
        "CAST(NULL AS string) AS reputation_note", "CAST(NULL AS string) AS reputation_source",
    )


def artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recovered content: that of purchases and signups went to their destination, that of other events elsewhere."""
    return read(spark, sf_dir, "events").selectExpr(
        "concat('case-', event_id % 7) AS case_id", "event_id AS seq",
        "concat(CASE WHEN event_type IN ('purchase', 'signup') THEN '198.51.100.' ELSE '198.51.101.' END, user_id) AS dest_ip",
        "CAST(floor(value * 10) AS bigint) AS total_bytes", "sha2(CAST(event_id AS string), 256) AS sha256",
        "concat('item ', event_id) AS preview",
    )


def intel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11: customers and suppliers in debt as indicators, keyed like A1 destinations."""
    note = (
        "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'RedLine Stealer C2' WHEN 'BUILDING' THEN 'Emotet C2' "
        "WHEN 'FURNITURE' THEN 'Cobalt Strike 4.x' WHEN 'HOUSEHOLD' THEN 'generic C2' ELSE 'XLoader panel' END"
    )
    customers = read(spark, sf_dir, "customer").filter("c_acctbal < 0").selectExpr(
        f"{address('c_custkey')} AS value", "'customers' AS source", f"{note} AS note", "'ip' AS indicator_type",
        "CAST(NULL AS string) AS last_seen", "c_custkey AS seq",
    )
    suppliers = read(spark, sf_dir, "supplier").filter("s_acctbal < 0").selectExpr(
        "concat('t', s_suppkey % 5, '-update.com') AS value", "'suppliers' AS source",
        "'DNS tunnel domain' AS note", "'domain' AS indicator_type", "CAST(NULL AS string) AS last_seen",
        "s_suppkey AS seq",
    )
    prints = read(spark, sf_dir, "supplier").filter("s_acctbal < 0").selectExpr(
        "md5(concat('host', s_suppkey)) AS value", "'suppliers' AS source", "'Trickbot' AS note", "'ja3' AS indicator_type",
        "CAST(NULL AS string) AS last_seen", "s_suppkey AS seq",
    )
    from netforensics.sources.feeds import merge_indicators

    return merge_indicators(customers, suppliers, prints)


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12: one packet per line item; the flow is (order, supplier)."""
    client = "concat('10.0.0.', l_orderkey % 200 + 1)"
    server = address("l_orderkey")
    port = "CAST(40000 + l_suppkey % 20000 AS int)"
    up = "l_linestatus = 'O'"
    payload = (
        "CASE l_returnflag WHEN 'R' THEN concat('POST /gate.php?p=', l_partkey, ' HTTP/1.1\\r\\nHost: h', "
        "l_suppkey % 10, '.example.com\\r\\n\\r\\n', repeat('x', CAST(l_quantity AS int))) "
        "WHEN 'N' THEN concat('STOR part', l_partkey, '.zip\\r\\n') ELSE repeat('y', CAST(l_quantity AS int)) END"
    )
    return read(spark, sf_dir, "lineitem").selectExpr(
        "concat('case-', l_orderkey % 7) AS case_id",
        "(l_orderkey * 8 + l_linenumber) * 100000 + l_partkey % 100000 AS seq",
        f"{epoch('l_shipdate')} AS ts",
        f"CASE WHEN {up} THEN {client} ELSE {server} END AS src_ip",
        f"CASE WHEN {up} THEN {port} ELSE 443 END AS src_port",
        f"CASE WHEN {up} THEN {server} ELSE {client} END AS dst_ip",
        f"CASE WHEN {up} THEN 443 ELSE {port} END AS dst_port",
        "'tcp' AS proto",
        f"CAST({payload} AS binary) AS payload",
    )


def findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as untiered findings on A1 destinations."""
    return read(spark, sf_dir, "orders").selectExpr(
        "concat('case-', o_orderkey % 7) AS case_id",
        "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'beacon' WHEN '2' THEN 'exfil' WHEN '3' THEN 'dns_tunnel' "
        "WHEN '4' THEN 'http_c2' ELSE 'smtp_exfil' END AS kind",
        "0 AS kind_rank",
        "named_struct('kind_rank', 0, 'seq', o_orderkey, 'name', '') AS finding_no",
        f"{address('o_custkey')} AS dst_ip",
        "443 AS dst_port",
        f"{epoch('o_orderdate')} AS event_time",
        "0.5D AS confidence",
        "CASE o_orderkey % 5 WHEN 0 THEN concat('x', o_orderkey % 40, '.t', o_orderkey % 5, '-update.com') "
        "WHEN 1 THEN 'V10.events.data.microsoft.com' WHEN 2 THEN concat('t', o_orderkey % 5, '-update.com') END "
        "AS destination_domain",
        "CAST(NULL AS string) AS ja3_hash", "CAST(NULL AS string) AS ja4", "false AS plaintext_available",
        "CASE WHEN o_orderstatus = 'P' THEN 'weak' END AS preset_tier",
        "CASE WHEN o_orderstatus = 'P' THEN 'note' END AS beacon_note",
        "CAST(NULL AS string) AS http_uri",
        "CASE WHEN o_orderpriority LIKE '5%' THEN concat('PC Name: ', o_custkey) END AS smtp_subject",
    )


def manifest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One manifest per nation as raw JSON."""
    text = (
        "concat('{\"schema_version\":\"1.0\",\"session_id\":\"s', n_nationkey, '\",\"cape_task_id\":', n_nationkey, "
        "',\"network_mode\":\"', CASE n_nationkey % 4 WHEN 0 THEN 'Simulated-INetSim' WHEN 1 THEN 'live egress' "
        "WHEN 2 THEN 'odd' ELSE 'isolated' END, "
        "'\",\"correlation\":{', CASE n_nationkey % 3 WHEN 0 THEN '\"clock_quality_acceptable\":true' "
        "WHEN 1 THEN concat('\"maximum_uncertainty_ns\":', n_nationkey * 1000000000L) ELSE '\"reason\":\"r\"' END, "
        "CASE WHEN n_nationkey % 5 = 0 THEN ',\"host_network_correlation_enabled\":false' ELSE '' END, "
        "'},\"telemetry\":{\"telemetry_degraded\":', CASE WHEN n_nationkey % 2 = 0 THEN 'true' ELSE 'false' END, "
        "',\"providers_unavailable\":[', CASE n_nationkey % 3 WHEN 0 THEN '{\"provider\":\"Kernel-File\"},{\"x\":1}' "
        "WHEN 1 THEN '{\"provider\":\"Other\"}' ELSE '' END, ']},"
        "\"guest_vm_identity\":{\"guest_ip\":\"', CASE WHEN n_nationkey % 6 = 0 THEN 'Unknown' ELSE "
        "concat('10.0.0.', n_nationkey + 1) END, '\"},"
        "\"detonation_start_utc\":\"1995-01-01T00:00:00Z\",\"detonation_end_utc\":\"1999-01-01T00:00:00+00:00\","
        "\"capabilities\":{\"dynamic\":{\"tls_interception\":{\"status\":\"', CASE WHEN n_nationkey % 4 = 1 "
        "THEN 'certificate_rejected' ELSE 'intercepted' END, '\"}}}}')"
    )
    return read(spark, sf_dir, "nation").selectExpr("concat('case-', n_nationkey) AS case_id", f"{text} AS raw")


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    from netforensics.sources.documents import parse_manifests

    return parse_manifests(manifest_documents(spark, sf_dir))


def static_iocs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as static indicators of four types."""
    return read(spark, sf_dir, "customer").selectExpr(
        "concat('case-', c_custkey % 7) AS case_id", "c_custkey AS seq", "CAST(NULL AS string) AS sample_sha256",
        "CASE WHEN c_nationkey % 2 = 0 THEN 'RedLine' END AS family",
        "CASE c_custkey % 4 WHEN 0 THEN 'ip' WHEN 1 THEN 'domain' WHEN 2 THEN 'url' ELSE 'email' END AS type",
        f"CASE c_custkey % 4 WHEN 0 THEN {address('c_custkey')} WHEN 1 THEN concat('www.site', c_custkey % 500, '.com') "
        f"WHEN 2 THEN concat('http://', {address('c_custkey')}, ':8080/gate.php') "
        "ELSE concat('Drop@www.Site', c_custkey % 500, '.com') END AS value",
        "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'CAPE_config' ELSE 'strings' END AS source",
        "CAST(NULL AS string) AS evidence_origin",
    )
