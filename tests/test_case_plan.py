from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from netforensics import schemas
from netforensics.operators import custody as cu, emit as em
from netforensics.plans.case import Context, analyse

MINIMAL = {
    "sessions": schemas.SESSIONS, "dns": schemas.DNS, "http": schemas.HTTP, "tls": schemas.TLS, "ftp": schemas.FTP,
    "smtp": schemas.SMTP, "icmp": schemas.ICMP,
}
CASE = "0b0f6c39-5b55-4f0f-8a8c-1c7f6a3b2d11"


def make(spark, name, rows):
    schema = MINIMAL[name]
    names = [n for n, _ in schemas.field_types(schema)]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def tables(spark):
    sess, base = [], dict(case_id=CASE, src_ip="10.0.0.5", src_port=1, proto="tcp", history="Sh", orig_bytes=100, resp_bytes=900)
    for i in range(8):  # beacon and upload to one host
        sess.append({**base, "seq": i, "ts": 1000.0 + 60 * i, "dst_ip": "198.51.100.7", "dst_port": 443, "uid": f"C{i}"})
    sess.append({**base, "seq": 20, "ts": 1001.0, "dst_ip": "198.51.100.7", "dst_port": 80, "orig_bytes": 9000, "resp_bytes": 10, "uid": "H"})
    sess.append({**base, "seq": 21, "ts": 1100.0, "dst_ip": "198.51.100.9", "dst_port": 4000, "orig_bytes": 9000, "resp_bytes": 10, "uid": "E"})
    sess.append({**base, "seq": 22, "ts": 1200.0, "dst_ip": "198.51.100.66", "dst_port": 21, "uid": "F"})
    http = [dict(case_id=CASE, seq=0, ts=1001.0, src_ip="10.0.0.5", dst_ip="198.51.100.7", dst_port=80, method="POST",
                 host="evil.example.com:80", uri="/gate.php?otp=1", uid="H")]
    ftp = [dict(case_id=CASE, seq=0, ts=1200.0, src_ip="10.0.0.5", dst_ip="198.51.100.66", command="STOR", arg="pw.txt", uid="F")]
    dns = [dict(case_id=CASE, seq=i, ts=990.0 + i, src_ip="10.0.0.5", dst_ip="10.0.0.1", query=q, qtype="A", rcode="NOERROR")
           for i, q in enumerate(["v10.events.data.microsoft.com", "drive.google.com", "evil.example.com"])]
    tls = [dict(case_id=CASE, seq=0, ts=1000.0, src_ip="10.0.0.5", dst_ip="198.51.100.7", dst_port=443, server_name="c2.example.net", ja3="j1"),
           dict(case_id=CASE, seq=1, ts=1000.0, src_ip="10.0.0.5", dst_ip="198.51.100.80", dst_port=443, server_name="x.example.net",
                ja3="72a589da586844d7f0818ce684948eea")]
    smtp = [dict(case_id=CASE, seq=0, ts=1300.0, src_ip="10.0.0.5", dst_ip="198.51.100.25", mail_from="A@x.example",
                 rcpt_to=["a@x.example"], subject="PC Name: x", attachments=[])]
    return {"sessions": make(spark, "sessions", sess), "http": make(spark, "http", http), "ftp": make(spark, "ftp", ftp),
            "dns": make(spark, "dns", dns), "tls": make(spark, "tls", tls), "smtp": make(spark, "smtp", smtp),
            "icmp": make(spark, "icmp", [])}


@pytest.fixture(scope="module")
def result(spark):
    from netforensics.session import reliable_checkpoint
    from netforensics.sources.documents import parse_static_priors
    from netforensics.sources.feeds import demo_indicators, known_fingerprints, merge_indicators

    prior = spark.createDataFrame(
        [(CASE, '{"family":"RedLine","c2_indicators":[{"type":"ip","value":"198.51.100.9","source":"cape_config"},'
                '{"type":"domain","value":"dormant.example.org"}]}')], "case_id string, raw string")
    access = spark.createDataFrame(
        [(CASE, 0, 988.0, "1970-01-01T00:16:28Z", "clipboard", "GetClipboardData", "p.exe", "T1115", None, None, 7, None)],
        "case_id string, seq bigint, ts double, raw_timestamp string, data_type string, api_call string, process string, "
        "mitre_technique string, object_path string, object_name string, process_id int, process_path string")
    ctx = Context(
        intel=merge_indicators(demo_indicators(spark), known_fingerprints(spark)),
        static_iocs=parse_static_priors(prior).filter("error is null").drop("error"), access=access,
        samples=spark.createDataFrame([(CASE, "ab" * 32)], "case_id string, sample_id string"), stage=reliable_checkpoint,
    )
    return analyse(tables(spark), ctx)


def test_findings_and_tiers(result):
    rows = result["findings"].collect()
    by = {}
    for r in rows:
        by.setdefault((r.kind, r.dst_ip or r.destination_domain), []).append(r)
    beacon = by[("beacon", "198.51.100.7")][0]
    assert beacon.confidence_tier == "strong" and beacon.destination_domain == "evil.example.com" and beacon.ja3_hash == "j1"
    assert by[("exfil", "198.51.100.7")][0].confidence_tier == "strong"
    assert by[("http_c2", "198.51.100.7")][0].confidence_tier == "strong"
    ja3 = by[("ja3", "198.51.100.80")][0]
    assert ja3.confidence_tier == "confirmed" and ja3.reputation_note == "JA3 match: Cobalt Strike default"
    egress = by[("unclassified_egress", "198.51.100.9")][0]
    assert egress.confidence_tier == "confirmed" and egress.static_match == "matches static-extracted C2 (RedLine)"
    assert by[("exfil", "198.51.100.66")][0].http_uri == "STOR pw.txt"
    assert by[("smtp_exfil", "198.51.100.25")][0].confidence_tier == "strong"
    assert by[("resolved_domain", "v10.events.data.microsoft.com")][0].confidence_tier == "allowlisted"
    assert by[("resolved_domain", "drive.google.com")][0].confidence_tier == "weak"
    dormant = by[("static_ioc", "dormant.example.org")] if ("static_ioc", "dormant.example.org") in by else [
        r for r in rows if r.kind == "static_ioc"]
    assert dormant[0].confidence_tier == "weak" and "dormant" in dormant[0].static_note
    assert ("static_ioc", "198.51.100.9") not in by


def test_events_follow_the_contract_and_verify(result):
    chained = result["chained_events"]
    assert em.contract_violations(chained).count() == 0
    assert em.unexpected_columns(result["events"]) == [] and len(result["events"].columns) == 29
    assert all(r.is_valid for r in cu.verify_chain(chained).collect())
    first = chained.orderBy("chain_pos").first()
    assert first.finding_kind == "correlation" and "clipboard" in first.plain_language
    assert result["events"].count() == result["findings"].count() + result["correlated"].count()


def test_reports(result):
    iocs = result["iocs"].collect()
    assert all(r.confidence_tier != "allowlisted" for r in iocs)
    record = result["provenance"].first()
    assert record.accessed_via == "GetClipboardData" and record.statement
    actors = {r.actor for r in result["timeline"].collect()}
    assert actors == {"host", "network", "static"}
    fams = {(r.family, r.confidence) for r in result["families"].collect()}
    assert ("Cobalt Strike", "likely") in fams and ("AgentTesla", "possible") in fams


def test_events_come_with_their_seal(result):
    chained, record = result["chained_events"], result["seals"]
    assert [r.rows for r in record.collect()] == [result["events"].count()]
    last = chained.agg(F.max("chain_pos")).first()[0]
    assert [r.is_valid for r in cu.verify_chain(chained.where(F.col("chain_pos") < last), record=record).collect()] == [False]
