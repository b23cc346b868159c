"""Content of any size, evidence files in ranges, bundles, address ranges, the note ledger and mixed case folders."""

from __future__ import annotations

import base64
import gzip
import hashlib
import ipaddress
import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from netforensics.operators import correlate as co, custody as cu, emit as em, flows as fl, joins as jn, story as st, tiers as ti
from netforensics.session import checkpoint_folder
from netforensics.sources import cases, zeek

PACKETS = (
    "case_id string, seq bigint, ts double, src_ip string, src_port int, dst_ip string, dst_port int, proto string, payload binary"
)


def test_every_byte_of_a_flow_is_hashed(spark):
    rng = random.Random(1)
    parts = [rng.randbytes(rng.randint(1, 1400)) for _ in range(3000)]
    other = [rng.randbytes(100) for _ in range(30)]
    rows = [("c", i, float(i), "10.0.0.5", 4000, "198.51.100.7", 443, "tcp", bytearray(p)) for i, p in enumerate(parts)]
    rows += [("c", 5000 + i, 1.0, "10.0.0.5", 4000, "198.51.100.8", 443, "tcp", bytearray(p)) for i, p in enumerate(other)]
    rows += [("c", 1, 1.0, "198.51.100.7", 443, "10.0.0.5", 4000, "tcp", bytearray(b"answer" * 50)),
             ("c", 2, 1.0, "10.0.0.5", 1, "198.51.100.9", 80, "udp", bytearray(b"u" * 99)),
             ("c", 3, 1.0, "10.0.0.5", 1, "198.51.100.9", 80, "tcp", bytearray(b"short")),
             ("c", 4, 1.0, "10.0.0.5", 1, "198.51.100.9", 80, "tcp", None)]
    rng.shuffle(rows)
    got = {r.dest_ip: r for r in fl.outbound_content(spark.createDataFrame(rows, PACKETS).repartition(5), head_bytes=1000).collect()}
    assert set(got) == {"198.51.100.7", "198.51.100.8"}
    for ip, sent in (("198.51.100.7", b"".join(parts)), ("198.51.100.8", b"".join(other))):
        row = got[ip]
        assert (row.total_bytes, row.sha256) == (len(sent), hashlib.sha256(sent).hexdigest())
        assert row.head_sha256 == hashlib.sha256(sent[:1000]).hexdigest() and len(row.preview) == 300
    # Flows that differ behind the head have one head hash and two content hashes.
    tail = [("c", i, 1.0, "10.0.0.5", 1, f"198.51.100.{ip}", 443, "tcp", bytearray(p)) for ip in (1, 2) for i, p in enumerate([b"x" * 500, bytes([ip])])]
    one, two = fl.outbound_content(spark.createDataFrame(tail, PACKETS), head_bytes=500).collect()
    assert one.head_sha256 == two.head_sha256 and one.sha256 != two.sha256
    assert fl.outbound_content(spark.createDataFrame([], PACKETS)).count() == 0


def test_requests_deep_in_a_payload(spark):
    body = b"POST /" + b"a" * 400 + b" HTTP/1.1\r\nHost: deep.example\r\n\r\nhost: body.example\r\n"
    packets = spark.createDataFrame([("c", 1, 1.0, "10.0.0.5", 4000, "198.51.100.7", 80, "tcp", bytearray(body))], PACKETS)
    assert fl.assemble_flows(packets).first().http_host == "deep.example"
    assert fl.assemble_flows(packets, head_bytes=200).first().http_host is None


def test_mail_items_keep_order_and_number(spark):
    lines = [f"RCPT TO:<r{i % 700}@x.example>" for i in range(1500)] + ["Content-Disposition: attachment; a"] * 90 + ["Subject: s"]
    rows = [("c", i, 1.0, "10.0.0.5", 4000, "198.51.100.7", 25, "tcp", bytearray("\r\n".join(lines[i : i + 7]).encode())) for i in range(0, len(lines), 7)]
    packets = spark.createDataFrame(rows, PACKETS)
    items = fl.smtp_items(packets)
    got = [r.value for r in items.where("kind = 'recipient'").orderBy("position").collect()]
    assert got == [f"r{i}@x.example" for i in range(700)]
    assert items.where("kind = 'attachment'").count() == fl.smtp_envelopes(packets).first().attached == 90
    mail = fl.smtp_with_lists(fl.smtp_envelopes(packets), items).first()
    assert mail.rcpt_to == got and len(mail.attachments) == 90 and mail.subject == "s"


def test_files_are_hashed_in_ranges(spark, tmp_path):
    rng, wanted = random.Random(2), {}
    for case, name, size in (("a", "conn.log", 0), ("a", "x.pcap", 1_000_003), ("b", "s ample+%41é.bin", 64), ("b", "y.pcapng", 4096)):
        (tmp_path / case).mkdir(exist_ok=True)
        data = rng.randbytes(size)
        (tmp_path / case / name).write_bytes(data)
        wanted[case, name] = (hashlib.sha256(data).hexdigest(), size)

    class Ranges:
        """Refuses to read more than a range at once."""

        def __init__(self, path):
            self.stream = cu.shared_file(path)

        def read(self, n):
            assert n <= 1000
            return self.stream.read(n)

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.stream.close()

    rows = cu.hash_inputs(spark, str(tmp_path), range_bytes=1000, opener=Ranges).collect()
    assert {(r.case_id, r.path.rsplit("/", 1)[1]): (r.sha256, r.size_bytes) for r in rows} == wanted
    assert {r.role for r in rows} == {"zeek_log", "pcap", "sample"}
    with pytest.raises(EOFError):
        cu.file_digest(open(tmp_path / "a" / "x.pcap", "rb"), 2_000_000, 1000)


def test_a_case_with_many_inputs_has_one_identity(spark):
    hashes = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(20_000)]
    rows = spark.createDataFrame([("c", h, 2) for h in hashes] + [("d", None, None)], "case_id string, sha256 string, size_bytes bigint")
    got = {r.case_id: r for r in cu.case_manifest(rows, F.lit('{"w":15}')).collect()}
    basis = '{"inputs":["' + '","'.join(sorted(hashes)) + '"],"parameters":{"w":15}}'
    assert (got["c"].inputs, got["c"].total_bytes, got["c"].manifest_id) == (20_000, 40_000, hashlib.sha256(basis.encode()).hexdigest())
    assert (got["d"].inputs, got["d"].total_bytes) == (1, 0)


def test_aligned_prefixes_cover_exactly():
    rng = random.Random(3)
    for digits in (3, 8, 32):
        for _ in range(60):
            low, high = sorted(rng.randrange(16 ** min(digits, 4)) for _ in range(2))
            shift = rng.choice([0, 16**digits - 16 ** min(digits, 4)])
            low, high = low + shift, high + shift
            spans = [(int(p or "0", 16) << 4 * (digits - len(p)), ((int(p or "0", 16) + 1) << 4 * (digits - len(p))) - 1)
                     for p in jn.aligned_prefixes(low, high, digits)]
            assert spans[0][0] == low and spans[-1][1] == high and all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:]))
            assert len(spans) <= 30 * digits
    assert list(jn.aligned_prefixes(0, 16**8 - 1, 8)) == [""]


def test_ranges_of_both_families(spark):
    rng = random.Random(4)

    def address(version, number):
        return str(ipaddress.ip_address(number) if version == 4 else ipaddress.IPv6Address(number))

    base = {4: int(ipaddress.ip_address("203.0.113.0")), 6: int(ipaddress.ip_address("2001:db8::"))}
    ranges, wanted = [], {}
    for version in (4, 6):
        for i in range(40):
            low = base[version] + rng.randrange(0, 3000)
            ranges.append((version, low, low + rng.randrange(0, 500), f"{version}-{i}"))
    probes = [(v, base[v] + rng.randrange(0, 3600)) for v in (4, 6) for _ in range(150)]
    for v, n in probes:
        inside = [(hi - lo, lo, name) for version, lo, hi, name in ranges if version == v and lo <= n <= hi]
        wanted[address(v, n)] = min(inside)[2] if inside else None
    wanted |= {"not an address": None, "::ffff:1": None}
    table = spark.createDataFrame(
        [(address(v, lo), address(v, hi), name) for v, lo, hi, name in ranges] + [("x", "1.2.3.4", "bad"), ("1.2.3.4", "::1", "mixed"), ("9.9.9.9", "1.1.1.1", "empty"), (None, "1.1.1.1", "null")],
        "lo string, hi string, geo_country string",
    ).selectExpr("*", "'AS1' AS asn", "CAST(NULL AS string) AS asn_org")
    rows = spark.createDataFrame([(a,) for a in wanted] + [(None,)], "dst_ip string")
    assert {r.dst_ip: r.geo_country for r in jn.geo_enrich(rows, table).collect()} == wanted | {None: None}
    numbers = spark.createDataFrame([(lo, hi, name) for v, lo, hi, name in ranges if v == 4], "lo bigint, hi bigint, geo_country string").selectExpr("*", "'AS1' AS asn", "'' AS asn_org")
    assert {r.dst_ip: r.geo_country for r in jn.geo_enrich(rows.where("dst_ip LIKE '203.%'"), numbers).collect()} == {k: v for k, v in wanted.items() if k.startswith("203.")}


def test_bundles_are_documents_of_one_case(spark, tmp_path):
    n = 3000
    events = spark.range(n).selectExpr(
        "concat('case-', id % 3) AS case_id", "id AS chain_pos", "concat('e', id) AS event_id", "concat('198.51.100.', id % 40) AS destination_ip",
        "443 AS destination_port", "CAST(NULL AS string) AS destination_domain", "CASE WHEN id % 7 = 0 THEN 'allowlisted' ELSE 'strong' END AS confidence_tier",
        "CASE WHEN id % 2 = 0 THEN 'a \"quoted\" note' END AS reputation_note", "CAST(NULL AS string) AS reputation_source", "'T1041' AS mitre_technique_id",
        "'2026-01-01T00:00:00+00:00' AS timestamp",
    ).repartition(7)
    objects = em.stix_objects(events, "2026-01-01T00:00:00+00:00")
    em.write_stix(objects, str(tmp_path / "out"))
    wanted = {}
    for r in objects.orderBy("case_id", "position").collect():
        wanted.setdefault(r.case_id, []).append(json.loads(r.json))
    for case, own in wanted.items():
        files = list((tmp_path / "out" / f"case_id={case}").glob("part-*"))
        bundle = json.loads("".join(f.read_text() for f in files))
        assert len(files) == 1 and bundle["type"] == "bundle" and bundle["id"].startswith("bundle--") and bundle["objects"] == own
        kinds = [o["type"] for o in own]
        assert kinds[: kinds.count("indicator")] == ["indicator"] * kinds.count("indicator")
    back = em.read_stix(spark, str(tmp_path / "out"))
    assert back.count() == sum(map(len, wanted.values())) and back.where("bundle_id IS NULL").count() == 0


def test_large_bundles_go_on_in_the_next_file(spark, tmp_path):
    objects = spark.range(6000).selectExpr(
        "IF(id % 100 = 7, 'small', 'large') AS case_id", "named_struct('part', 0, 'place', id DIV 200, 'kind', 0) AS position",
        "'indicator' AS object_type", "'x' AS object_id", "concat('{\"id\":', id DIV 2, '}') AS json",
    ).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        em.write_stix(objects, str(tmp_path / "out"), file_lines=1000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for case, several in (("large", True), ("small", False)):
        own = sorted((r.position.place, r.json) for r in objects.where(f"case_id = '{case}'").collect())
        files = sorted((tmp_path / "out" / f"case_id={case}").glob("part-*"))
        assert (len(files) > 1) == several
        assert json.loads("".join(f.read_text() for f in files))["objects"] == [json.loads(j) for _, j in own]
    back = em.read_stix(spark, str(tmp_path / "out"))
    assert back.count() == 6000 and back.where("bundle_id IS NULL").count() == 0


def test_bundles_are_stored_once_and_compressed(spark, tmp_path):
    objects = spark.range(3000).selectExpr(
        "'c' AS case_id", "named_struct('part', 0, 'place', id, 'kind', 0) AS position", "'indicator' AS object_type",
        "uuid() AS object_id", "concat('{\"id\":', id, '}') AS json",
    )
    em.write_stix(objects, str(tmp_path / "out"), file_lines=1000, compress=True)
    files = [gzip.open(f, "rt").read().splitlines() for f in sorted(tmp_path.glob("out/case_id=c/part-*.gz"))]
    assert len(files) >= 3 and all(len(lines) <= 1002 for lines in files)
    assert [o["id"] for o in json.loads("".join(line for lines in files for line in lines))["objects"]] == list(range(3000))
    back = em.read_stix(spark, str(tmp_path / "out"))
    assert sorted(json.loads(r.json)["id"] for r in back.collect()) == list(range(3000))
    # Between the two only the texts and their places are on disk.
    folder = checkpoint_folder(spark).removeprefix("file:")
    kept = max(Path(folder).glob("bundle-objects-*"), key=lambda p: p.stat().st_mtime)
    assert spark.read.parquet(str(kept)).columns == ["case_id", "position", "json"]
    assert all(f.name.endswith(".zstd.parquet") for f in kept.glob("part-*"))


def test_note_ledger_counts_what_each_gate_capped(spark):
    manifest = spark.range(2).selectExpr(
        "concat('c', id) AS case_id", "'live egress' AS network_mode", "id = 1 AS clock_quality_acceptable", "'certificate_rejected' AS tls_interception_status",
        "true AS telemetry_degraded", "array('Kernel-File') AS providers_unavailable", "true AS host_network_correlation_enabled",
        "true AS access_events_correlation_eligible", "CAST(NULL AS string) AS correlation_reason", "CAST(id * 4 AS int) AS access_events_rejected_count",
        "'linear' AS clock_algorithm",
    )
    findings = spark.sql("SELECT 'c0' AS case_id, 'clock_quality' AS capped_by_caveat UNION ALL SELECT 'c0', 'clock_quality' UNION ALL SELECT 'c1', NULL")
    linked = spark.sql("SELECT 'c0' AS case_id, 'clock_quality' AS capped_by_caveat UNION ALL SELECT 'c1', 'telemetry_degraded' UNION ALL SELECT 'c1', 'telemetry_degraded'")
    late = spark.sql("SELECT 'c1' AS case_id, 500.0D AS gap_s, 'late' AS note")
    got = {(r.case_id, r.code): (r.gate, r.affected, r.note) for r in ti.case_notes(manifest, findings, linked, late).collect()}
    assert {k: v[1] for k, v in got.items()} == {
        ("c0", "network_live"): None, ("c1", "network_live"): None, ("c0", "clock_quality"): 2, ("c0", "tls_not_intercepted"): None,
        ("c1", "tls_not_intercepted"): None, ("c0", "correlation_clock"): 1, ("c0", "telemetry_degraded"): 0, ("c1", "telemetry_degraded"): 2,
        ("c1", "access_events_rejected"): None, ("c1", "clock_alignment"): None}
    assert got["c1", "telemetry_degraded"][2].endswith("[file_access]; 2 link(s) lowered to weak.") and got["c1", "clock_alignment"][0] == "clock"


def test_family_evidence_is_ranked(spark):
    rows = spark.createDataFrame(
        [("c", "X", "possible", "behavioural", "b"), ("c", "X", "likely", "threat_intel", "z"), ("c", "X", "likely", "threat_intel", "a"), ("c", "X", "confirmed", "static_prior", "s")],
        "case_id string, family string, confidence string, basis string, evidence string")
    assert [r.evidence for r in st.family_evidence(rows).orderBy("place").collect()] == ["s", "a", "z", "b"]


def test_median_reads_each_table_twice(spark):
    rng = random.Random(6)
    values = [(f"k{rng.randrange(3)}", rng.choice([rng.randrange(10**9), 5_000_000 + rng.randrange(50)])) for _ in range(999)]
    df = spark.createDataFrame(values, "k string, us bigint")
    for k, got in {r.k: r["median"] for r in co.upper_median(df, ["k"]).collect()}.items():
        own = sorted(v for key, v in values if key == k)
        assert got == own[len(own) // 2]


def test_folders_with_logs_and_captures(spark, tmp_path):
    def packet(seq, dst, data, **more):
        return json.dumps({"seq": seq, "ts": 5.0 + seq, "src_ip": "10.0.0.5", "src_port": 4000, "dst_ip": dst, "dst_port": 80, "proto": "tcp",
                           "payload": base64.b64encode(data).decode(), **more})

    for case in ("logged", "captured"):
        (tmp_path / case).mkdir()
        (tmp_path / case / "packets.jsonl").write_text("\n".join([
            packet(1, "198.51.100.7", b"POST /p HTTP/1.1\r\nHost: h.example\r\n\r\n"), "{broken", packet(2, "198.51.100.7", b"abc"),
            packet(3, "198.51.100.9", b"xx", icmp_type=8)]) + "\n")
    (tmp_path / "logged" / "conn.log").write_text("#fields\tts\tid.orig_h\tid.resp_h\tid.resp_p\n1.0\t10.0.0.5\t198.51.100.1\t443\n")
    (tmp_path / "captured" / "dns.log").write_text('{"query": "not.read"}\n')
    (tmp_path / "captured" / "dns_messages.jsonl").write_text('{"seq": 1, "ts": 1.0, "src_ip": "10.0.0.5", "dst_ip": "10.0.0.1", "query": "a.example.", "qtype": 16, "rcode": 3, "is_response": false}\n')
    tables = cases.read_case_tables(spark, str(tmp_path))
    assert {(r.case_id, r.source) for r in tables["case_sources"].collect()} == {("logged", "logs"), ("captured", "capture")}
    assert sorted((r.case_id, r.dst_ip, r.dst_port) for r in tables["sessions"].collect()) == [
        ("captured", "198.51.100.7", 80), ("captured", "198.51.100.9", 80), ("logged", "198.51.100.1", 443)]
    assert [(r.case_id, r.host) for r in tables["http"].collect()] == [("captured", "h.example")]
    assert [(r.case_id, r.query, r.qtype, r.rcode) for r in tables["dns"].collect()] == [("captured", "a.example", "TXT", "NXDOMAIN")]
    assert [r.dst_ip for r in tables["icmp"].collect()] == ["198.51.100.9"]


def test_lines_of_a_large_log_are_not_dealt_by_file(spark):
    lines = spark.range(2000).selectExpr(
        "concat('c', id % 2) AS case_id", "concat('c', id % 2, '/conn.log') AS file", "id AS seq",
        "CASE WHEN id % 1000 < 2 THEN '#fields\tts\tid.orig_h\tid.resp_p' ELSE concat(id, '.0\t10.0.0.5\t', id) END AS value")
    rows = zeek.typed_table("conn", zeek.parse_log(lines, zeek.LOG_FIELDS["conn"]))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert rows.where("dst_port = seq AND ts = seq").count() == 1996


def test_case_logs_are_written_in_pieces(spark, tmp_path):
    from netforensics.adapters.queries import _write_case_logs

    logs = spark.range(5000).selectExpr("'a' AS case_id", "'conn' AS log", "id AS seq", "concat(id, '.0\t198.51.100.', id % 9) AS value")
    packets = spark.range(300).selectExpr("'b' AS case_id", "'packets' AS log", "id AS seq", "concat('{\"seq\":', id, '}') AS value")
    _write_case_logs(logs, packets, "#fields\tts\tid.resp_h", str(tmp_path / "out"), piece_lines=500)
    files = [f.read_text().splitlines() for f in (tmp_path / "out" / "case_id=a" / "log=conn").glob("part-*")]
    assert all(f[0].startswith("#fields") for f in files) and sum(line.startswith("#fields") for f in files for line in f) == 10
    got = zeek.read_log(spark, f"{tmp_path}/out/*/log=conn", "conn")
    assert sorted(int(r.ts) for r in got.collect()) == list(range(5000))
    assert spark.read.text(f"{tmp_path}/out/case_id=b/log=packets").count() == 300


def test_case_logs_are_written_where_they_are_made(spark, tmp_path):
    from netforensics.adapters.queries import _write_case_logs

    logs = spark.range(0, 8000, 1, 4).selectExpr("concat('c', id % 2) AS case_id", "'conn' AS log", "id AS seq", "concat(id, '.0\t \"q\"\\\\ ', id) AS value")
    packets = spark.range(40).selectExpr("concat('c', id % 4) AS case_id", "'packets' AS log", "id AS seq",
                                         "concat('{\"seq\":', id, ',\"ts\":1.0,\"src_ip\":\"10.0.0.5\",\"dst_ip\":\"198.51.100.7\",\"src_port\":1,\"dst_port\":2,\"proto\":\"tcp\"}') AS value")
    root = str(tmp_path / "out")
    _write_case_logs(logs, packets, "#fields\tts\tid.resp_h", root, piece_lines=100, compress=True)
    # Nothing is dealt: a file has lines of one split only, and it is compressed.
    for f in tmp_path.glob("out/case_id=*/log=conn/part-*"):
        lines = gzip.open(f, "rt").read().splitlines()
        places = [int(line.split(".")[0]) for line in lines[1:]]
        assert lines[0] == "#fields\tts\tid.resp_h" and places == sorted(places) and len(places) <= 100 and len({p // 2000 for p in places}) == 1
    got = zeek.read_log(spark, f"{root}/*/log=conn", "conn").collect()
    assert sorted((int(r.ts), r.dst_ip) for r in got) == [(i, f' "q"\\ {i}') for i in range(8000)]
    # A line without a place comes before any header, so it is not read.
    odd = logs.limit(1).selectExpr("case_id", "log", "CAST(NULL AS bigint) AS seq", "'9.0\t198.51.100.9' AS value")
    _write_case_logs(logs.limit(9).unionByName(odd), packets, "#fields\tts\tid.resp_h", str(tmp_path / "odd"))
    assert zeek.read_log(spark, f"{tmp_path}/odd/*/log=conn", "conn").count() == 9
    # Packets of cases with a connection log are not even parsed.
    logged = spark.createDataFrame([("c0",), ("c1",)], "case_id string")
    assert {r.case_id for r in cases.read_decoded(spark, root, "packets", logged).collect()} == {"c2", "c3"}
    assert {(r.case_id, r.source) for r in cases.read_case_tables(spark, root)["case_sources"].collect()} == {
        ("c0", "logs"), ("c1", "logs"), ("c2", "capture"), ("c3", "capture")}
