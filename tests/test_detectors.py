from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from netforensics import schemas
from netforensics.operators import dns as dn, services as sv, tls as tl


def table(spark, schema, rows):
    names = [n for n, _ in schemas.field_types(schema)]
    out = []
    for i, r in enumerate(rows):
        base = {"case_id": "c1", "seq": i, "ts": 1000.0 + i, "src_ip": "10.0.0.5", "dst_ip": "10.0.0.1", **r}
        out.append(tuple(base.get(n) for n in names))
    return spark.createDataFrame(out, schema)


def queries(spark, names, **extra):
    return table(spark, schemas.DNS, [{"query": n, "qtype": "A", "rcode": "NOERROR", **extra} for n in names])


def test_tunnel_scores_and_benign_does_not(spark):
    labels = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(60)]
    tunnel = queries(spark, [f"{x}.cisco-update.com" for x in labels], qtype="TXT")
    row = dn.detect_dns_tunneling(tunnel).first()
    assert row.domain == "cisco-update.com" and row.confidence == 1.0 and row.tunnel_rt_fraction == 1.0
    assert row.resolver_ips == ["10.0.0.1"]
    assert dn.detect_dns_tunneling(queries(spark, ["www.example.com"] * 60)).count() == 0
    assert dn.detect_dns_tunneling(queries(spark, [f"{x}.few.com" for x in labels[:4]], qtype="TXT")).count() == 0


def test_dga_burst_needs_missing_names(spark):
    names = [hashlib.md5(str(i).encode()).hexdigest() + ".com" for i in range(15)]
    assert dn.detect_dga(queries(spark, names, rcode="NXDOMAIN")).first().domain == "<15 algorithmic domains>"
    assert dn.detect_dga(queries(spark, names)).count() == 0
    assert dn.detect_dga(queries(spark, names[:9], rcode="NXDOMAIN")).count() == 0


def test_resolved_names_background_abused_and_claimed(spark):
    names = ["v10.events.data.microsoft.com", "drive.google.com", "evil.example", "a1.cisco-update.com", "nodots", "Evil.Example."]
    claimed = spark.createDataFrame([("c1", "cisco-update.com")], "case_id string, domain string")
    got = {r.domain: (r.confidence, r.query_count) for r in dn.detect_resolved_destinations(queries(spark, names), claimed).collect()}
    assert got == {"v10.events.data.microsoft.com": (0.0, 1), "drive.google.com": (0.4, 1), "evil.example": (0.4, 2)}
    allowed = dn.detect_resolved_destinations(queries(spark, ["x.evil.example"]), None, ["evil.example"]).first()
    assert allowed.confidence == 0.0


def test_cloud_direction_and_dedup(spark):
    tls = table(spark, schemas.TLS, [
        {"dst_ip": "1.1.1.1", "dst_port": 443, "server_name": "api.telegram.org"},
        {"dst_ip": "1.1.1.1", "dst_port": 443, "server_name": "api.telegram.org"},
        {"dst_ip": "1.1.1.2", "dst_port": 443, "server_name": "dl.dropbox.com"},
        {"dst_ip": "1.1.1.3", "dst_port": 443, "server_name": "notdropbox.com"}])
    http = table(spark, schemas.HTTP, [])
    sess = table(spark, schemas.SESSIONS, [
        {"dst_ip": "1.1.1.1", "dst_port": 443, "orig_bytes": 5000, "resp_bytes": 100},
        {"dst_ip": "1.1.1.2", "dst_port": 443, "orig_bytes": 10, "resp_bytes": 9000}])
    got = {r.domain: (r.service, r.direction, r.category, r.confidence) for r in sv.detect_cloud_exfil(tls, http, sess).collect()}
    assert got == {"api.telegram.org": ("Telegram Bot API", "upload", "cloud_exfil", 0.75),
                   "dl.dropbox.com": ("Dropbox", "download", "cloud_staging", 0.4)}


@pytest.mark.parametrize("uri, agent, want", [
    ("/gate.php", None, ("strong", 0.7)), ("/x/GATE/", None, ("strong", 0.7)), ("/index.php?id=4", "curl", ("strong", 0.7)),
    ("/news", "curl", ("weak", 0.45)), ("/news", "", ("weak", 0.45)), ("/news", "Mozilla/5.0 (X11)", None), ("/news", None, None)])
def test_http_gate(spark, uri, agent, want):
    http = table(spark, schemas.HTTP, [{"dst_ip": "1.1.1.1", "dst_port": 80, "uri": uri, "user_agent": agent}] * 2)
    rows = sv.detect_http_exfil(http).collect()
    assert [(r.severity, r.confidence) for r in rows] == ([want] if want else [])


def test_mail_icmp_ports(spark):
    mail = table(spark, schemas.SMTP, [
        {"mail_from": "A@x", "rcpt_to": ["a@X"], "attachments": ["f"]}, {"mail_from": "a@x", "rcpt_to": ["b@x"], "attachments": []},
        {"mail_from": None, "rcpt_to": [], "attachments": []}])
    assert sorted(r.confidence for r in sv.detect_smtp_exfil(mail).collect()) == [0.6, 0.9]
    echo = table(spark, schemas.ICMP, [{"dst_ip": "8.8.8.8", "data_len": 900}] * 9 + [{"dst_ip": "9.9.9.9", "data_len": 40}] * 20)
    assert [r.dst_ip for r in sv.detect_icmp_tunnel(echo).collect()] == ["8.8.8.8"]
    http = table(spark, schemas.HTTP, [{"dst_ip": "1.1.1.1", "dst_port": 55123}, {"dst_ip": "1.1.1.1", "dst_port": 80}])
    tls = table(spark, schemas.TLS, [{"dst_ip": "1.1.1.1", "dst_port": 55123}, {"dst_ip": "1.1.1.1", "dst_port": 4444}])
    assert {r.detail for r in sv.detect_port_mismatch(http, tls).collect()} == {
        "HTTP on non-standard port 55123", "TLS on non-standard port 4444"}


def test_ja4_known_components(spark):
    row = spark.range(1).select(
        tl.ja4_text(F.lit(771), F.array(F.lit(772), F.lit(0x0A0A)), F.array(F.lit(0x1301), F.lit(0x0A0A)),
                    F.array(F.lit(0), F.lit(16), F.lit(43)), F.array(F.lit(0x0403)), F.array(F.lit("h2")), F.lit("x")).alias("j")
    ).first().j
    b = hashlib.sha256(b"1301").hexdigest()[:12]
    c = hashlib.sha256(b"002b_0403").hexdigest()[:12]
    assert row == f"t13d0103h2_{b}_{c}"


def test_certificate_before_and_after_a_hit(spark):
    tls = table(spark, schemas.TLS, [
        {"dst_ip": "198.51.100.1", "dst_port": 443, "subject": "a", "issuer": "a"},
        {"dst_ip": "198.51.100.1", "dst_port": 443, "ja3": "bad", "subject": "a", "issuer": "a"},
        {"dst_ip": "198.51.100.1", "dst_port": 443, "subject": "a", "issuer": "a"},
        {"dst_ip": "10.0.0.9", "dst_port": 443, "ja3": "bad"}])
    intel = spark.createDataFrame([("bad", "s", "n", "ja3", None)], schemas.INTEL)
    none = spark.createDataFrame([], "case_id string, dst_ip string")
    got = sorted((r.seq, r.kind) for r in tl.tls_findings(tls, none, intel).collect())
    assert got == [(0, "tls_cert"), (1, "ja3")]
