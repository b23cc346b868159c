from __future__ import annotations

import hashlib

import pytest

from netforensics.functions import rules
from netforensics.operators import emit as em, flows as fl, tiers as ti
from netforensics.sources import documents as doc, feeds as fd, zeek

CONN = """#separator \\x09
#fields\tts\tuid\tid.orig_h\tid.orig_p\tid.resp_h\tid.resp_p\tproto\torig_bytes\tresp_bytes\thistory
1000.5\tC1\t10.0.0.5\t4000\t198.51.100.7\t443\ttcp\t100\t-\tSh
1001.5\tC2\t10.0.0.5\tx\t198.51.100.7\t443\t-\t(empty)\t5\t-
#close
"""
JSON = """{"ts": 1000.5, "id.orig_h": "10.0.0.5", "id.resp_h": "10.0.0.1", "query": "a.example", "answers": ["1.2.3.4", "5.6.7.8"]}
{"ts": broken
{"ts": 2.0, "query": "-", "answers": "x,y,"}
"""


def test_log_folders(spark, tmp_path):
    for case in ("case-a", "case-b"):
        (tmp_path / case).mkdir()
        (tmp_path / case / "conn.log").write_text(CONN)
    (tmp_path / "case-a" / "dns.log").write_text(JSON)
    (tmp_path / "no-conn").mkdir()
    (tmp_path / "no-conn" / "dns.log").write_text(JSON)
    tables = zeek.read_cases(spark, str(tmp_path))
    rows = tables["sessions"].orderBy("case_id", "seq").collect()
    assert [r.case_id for r in rows] == ["case-a", "case-a", "case-b", "case-b"]
    assert (rows[0].src_port, rows[0].orig_bytes, rows[0].resp_bytes, rows[0].history) == (4000, 100, 0, "Sh")
    assert (rows[1].src_port, rows[1].proto, rows[1].orig_bytes, rows[1].history) == (0, "tcp", 0, "")
    dns = tables["dns"].orderBy("seq").collect()
    assert [(r.case_id, r.query, r.answers) for r in dns] == [
        ("case-a", "a.example", ["1.2.3.4", "5.6.7.8"]), ("case-a", "", ["x", "y"])]
    assert tables["smtp"].count() == 0


def test_lists_follow_the_encoding_of_their_line(spark):
    head = "#fields\tts\tquery\tanswers"
    lines = [head, "1.0\ta\t[x],y", "2.0\tb\t-", "#fields\tanswers\tts", "p,q\t3.0",
             '{"ts": 4, "query": "c", "answers": ["[u", "v"]}', '{"ts": 5, "id.resp_p": 53.0, "answers": "s,,t"}']
    rows = [("c", "f", i, value) for i, value in enumerate(lines)] + [("c", "g", 0, "9.0\tno header\tz")]
    frame = spark.createDataFrame(rows, "case_id string, file string, seq bigint, value string")
    got = zeek.typed_table("dns", zeek.parse_log(frame, zeek.LOG_FIELDS["dns"])).orderBy("seq").collect()
    assert [(r.ts, r.query, r.answers) for r in got] == [
        (1.0, "a", ["[x]", "y"]), (2.0, "b", []), (3.0, "", ["p", "q"]), (4.0, "c", ["[u", "v"]), (5.0, "", ["s", "t"])]


def test_feed_folder(spark, tmp_path):
    (tmp_path / "feodo_ipblocklist.csv").write_text(
        '# c\n"first_seen_utc","dst_ip","dst_port","s","l","malware"\n"2022","162.243.103.246","8080","o","l","Emotet"\n')
    (tmp_path / "urlhaus.csv").write_text(
        '"1","d","https://github.com/x/p.exe","o","l","malware_download","exe","u"\n'
        '"2","d","http://198.51.100.4:80/p","o","l","malware_download","","u"\n"3","d","http://bad.example/p","o","l","t","a","u"\n')
    (tmp_path / "threatfox.csv").write_text('"d", "1", "203.0.113.9:2404", "ip:port", "botnet_cc", "win.r", "", "Remcos, new", "", "75"\n')
    (tmp_path / "my_domains.txt").write_text("# x\nEvil.example\n")
    (tmp_path / "readme.md").write_text("no")
    got = {r.value: (r.indicator_type, r.note) for r in fd.refresh(spark, str(tmp_path)).collect()}
    assert got["162.243.103.246"] == ("ip", "Emotet C2 (port 8080)")
    assert got["198.51.100.4"] == ("ip", "malware_download") and got["bad.example"] == ("domain", "t (a)")
    assert got["203.0.113.9"] == ("ip", "Remcos, new C2 (port 2404)") and got["evil.example"] == ("domain", "domain blocklist")
    assert "github.com" not in got and got["188.190.10.10"][0] == "ip" and len(got) == 5 + 3 + 4
    with pytest.raises(ValueError):
        fd.require_indicators(fd.demo_indicators(spark))


def test_later_sources_win(spark):
    def rows(source, seq):
        return spark.createDataFrame([("v", source, "n", "ip", None, seq)], "value string, source string, note string, "
                                     "indicator_type string, last_seen string, seq bigint")

    assert fd.merge_indicators(rows("a", 9), rows("b", 1)).first().source == "b"
    assert fd.merge_indicators(rows("a", 1).unionByName(rows("c", 2))).first().source == "c"


def test_access_events(spark, tmp_path):
    (tmp_path / "c1").mkdir()
    (tmp_path / "c1" / "access_events.json").write_text(
        '[{"timestamp":"2024-10-23T19:15:30+00:00","data_type":"keystrokes","api_call":"k","process_id":7},'
        '{"timestamp":"2024-10-23T19:15:30","data_type":"keystrokes","api_call":"k"},'
        '{"timestamp":"2024-10-23T19:15:30Z","data_type":"nope","api_call":"k"},{"data_type":"keystrokes","api_call":"k"}]')
    raw = doc.read_access_events(spark, str(tmp_path / "*" / "access_events.json"))
    good, bad = doc.ingest_access_events(raw)
    row = good.first()
    assert (row.case_id, row.ts, row.mitre_technique, row.process_id) == ("c1", 1729710930.0, "T1056.001", 7)
    errors = [r.error for r in bad.orderBy("seq").collect()]
    assert "no timezone" in errors[0] and "invalid data_type" in errors[1] and "missing required" in errors[2]
    with pytest.raises(ValueError):
        doc.ingest_access_events(raw, strict=True)


def test_manifest_defaults_and_sidecars(spark):
    def docs(raw):
        return spark.createDataFrame([("c1", raw)], "case_id string, raw string")

    bare = doc.parse_manifests(docs("{}")).first()
    assert bare.clock_quality_acceptable is False and bare.host_network_correlation_enabled is True
    assert bare.telemetry_degraded is False and bare.access_events_correlation_eligible is True
    full = doc.parse_manifests(
        docs('{"correlation":{"maximum_uncertainty_ns":5000000000}}'),
        docs('{"algorithm":"linear","measurements":{"start":{"uncertainty_ns":2000000},"end":{"uncertainty_ns":9000000}}}'),
        docs('{"correlation_eligible":false,"rejected_event_count":3,"reason_code":"x"}')).first()
    assert full.clock_quality_acceptable is True and full.clock_uncertainty_ms == 9.0
    assert full.access_events_correlation_eligible is False and full.access_events_rejected_count == 3 and full.correlation_reason == "x"


def test_allowlist_and_truth_documents(spark):
    site = spark.createDataFrame([("s", '{"domains":[" Corp.Example "],"cidrs":["203.0.113.0/24","bad"]}')], "case_id string, raw string")
    domains, cidrs = doc.parse_allowlist(site)
    assert domains.filter("domain = 'corp.example'").count() == 1 and domains.count() == 24
    assert [r.cidr for r in cidrs.collect()] == ["203.0.113.0/24"]
    found = spark.createDataFrame(
        [("c", "weak", "x.corp.example", "1.1.1.1"), ("c", "strong", "x.corp.example", "1.1.1.1"), ("c", "weak", None, "203.0.113.9"),
         ("c", "weak", "notcorp.example", "8.8.8.8")],
        "case_id string, confidence_tier string, destination_domain string, dst_ip string")
    got = sorted((r.confidence_tier, r.allowlist_match or "") for r in ti.apply_allowlist(found, domains, cidrs).collect())
    assert got == [("allowlisted", "203.0.113.0/24"), ("allowlisted", "corp.example"), ("strong", ""), ("weak", "")]


def test_flows_orientation_and_content(spark):
    schema = ("case_id string, seq bigint, ts double, src_ip string, src_port int, dst_ip string, dst_port int, proto string, "
              "payload binary")
    rows = [("c", 1, 2.0, "198.51.100.7", 80, "10.0.0.5", 4000, "tcp", bytearray(b"HTTP/1.1 200 OK")),
            ("c", 2, 3.0, "10.0.0.5", 4000, "198.51.100.7", 80, "tcp", bytearray(b"POST /a HTTP/1.1\r\nHost: x.example\r\n\r\n")),
            ("c", 3, 4.0, "10.0.0.5", 4000, "198.51.100.7", 80, "tcp", bytearray(b"GET /b HTTP/1.1\r\n\r\n" + b"z" * 60)),
            ("c", 4, 5.0, "10.0.0.5", 4000, "198.51.100.7", 80, "tcp", None)]
    packets = spark.createDataFrame(rows, schema)
    flow = fl.assemble_flows(packets).first()
    assert (flow.src_ip, flow.dst_port, flow.ts, flow.resp_bytes) == ("10.0.0.5", 80, 2.0, 15)
    assert (flow.http_method, flow.http_uri, flow.http_host) == ("GET", "/b", "x.example")
    item = fl.outbound_content(packets, head_bytes=40).first()
    sent = bytes(rows[1][8] + rows[2][8])
    assert item.total_bytes == flow.orig_bytes and item.preview == sent.decode().replace("\r", ".").replace("\n", ".")
    assert (item.sha256, item.head_sha256) == (hashlib.sha256(sent).hexdigest(), hashlib.sha256(sent[:40]).hexdigest())


def test_sinks(spark, tmp_path):
    events = spark.createDataFrame([("e1", "c1", "s", "weak"), ("e2", "c1", "s", "strong")],
                                   "event_id string, case_id string, sample_id string, confidence_tier string")
    path = str(tmp_path / "events")
    em.store_events(events, path)
    em.store_events(events, path)
    assert spark.read.parquet(path).count() == 2
    assert em.sample_tiers(events).first().confidence_tier == "strong"
    em.write_json(events, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2


def test_sample_metadata(spark):
    raw = '{"static_risk_score":"x","yara":{"deep_hits":["foo","MAL_agent_tesla"]},"clamav":{"status":"infected"},"vt_lookup":"0/70"}'
    meta = doc.parse_sample_meta(spark.createDataFrame([("c", raw)], "case_id string, raw string"))
    row = meta.select("errors", rules.sample_family().alias("f"), rules.corroborating_signals().alias("s")).first()
    assert row.errors == ["static_risk_score is not numeric"] and row.f == "AgentTesla"
    assert row.s == ["yara_deep:foo,MAL_agent_tesla", "clamav:detected"]
