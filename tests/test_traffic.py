from __future__ import annotations

import random
import statistics

from pyspark.sql import functions as F

from netforensics.operators import traffic as tr


def test_regular_callbacks_are_a_beacon(conns):
    df = conns([{"ts": 1000.0 + 30 * i, "dst_ip": "198.51.100.22"} for i in range(10)])
    row = tr.detect_beaconing(df).first()
    assert row.is_beacon and row.mean_interval_s == 30.0 and row.jitter_ratio == 0.0
    assert row.confidence == 1.0 and row.connection_count == 10


def test_irregular_private_and_few_are_not(conns):
    rng = random.Random(42)
    df = conns(
        [{"ts": 1000 + rng.uniform(0, 600), "dst_ip": "198.51.100.33"} for _ in range(10)]
        + [{"ts": 1000.0 + 30 * i, "dst_ip": "192.168.1.9"} for i in range(10)]
        + [{"ts": 1000.0 + 30 * i, "dst_ip": "198.51.100.1"} for i in range(3)]
    )
    rows = tr.detect_beaconing(df).collect()
    assert [(r.dst_ip, r.is_beacon) for r in rows] == [("198.51.100.33", False)]


def test_near_zero_interval_is_not_a_beacon(conns):
    df = conns([{"ts": 1000.0 + 0.01 * i} for i in range(6)])
    assert tr.detect_beaconing(df).first().is_beacon is False


def test_retry_storm_is_unanswered_and_capped(conns):
    df = conns([{"ts": 1000.0 + 60 * i, "resp_bytes": 0, "history": "S"} for i in range(12)])
    row = tr.detect_beaconing(df).first()
    assert row.is_beacon and row.unanswered and row.confidence <= 0.3 and row.handshake_ratio == 0.0


def test_interval_stats_match_plain_statistics_across_chunks(spark):
    rng = random.Random(7)
    times = sorted(round(rng.uniform(0, 20_000), 3) for _ in range(400)) + [5.0, 5.0, 5.0]
    rows = [("k", t, rng.randint(1, 500), True) for t in times]
    df = spark.createDataFrame(rows, "k string, ts double, orig_bytes bigint, responded boolean")
    got = tr.interval_stats(df, ["k"]).first()
    ordered = sorted(times)
    gaps = [b - a for a, b in zip(ordered, ordered[1:])]
    assert got.connection_count == len(times)
    assert abs(got.mean_interval - statistics.mean(gaps)) < 1e-9
    assert abs(got.interval_stddev - statistics.pstdev(gaps)) < 1e-6
    sizes = [r[2] for r in rows]
    assert abs(got.size_variation - statistics.pstdev(sizes) / statistics.mean(sizes)) < 1e-9


def test_hot_destination_is_never_sorted_whole(spark):
    """One key holds nearly all rows; no window may be partitioned by the key alone over raw rows."""
    df = spark.range(200_000).select(
        F.lit("k").alias("k"), (F.col("id") * 0.5).alias("ts"), F.lit(10).cast("bigint").alias("orig_bytes"),
        F.lit(True).alias("responded"),
    )
    got = tr.interval_stats(df, ["k"]).first()
    assert got.connection_count == 200_000 and abs(got.mean_interval - 0.5) < 1e-9 and got.interval_stddev < 1e-6


def test_exfil_rules(conns):
    df = conns(
        [
            {"dst_ip": "198.51.100.44", "orig_bytes": 5000, "resp_bytes": 200, "http_method": "POST"},
            {"dst_ip": "198.51.100.55", "orig_bytes": 200, "resp_bytes": 50000},
            {"dst_ip": "198.51.100.66", "orig_bytes": 500, "resp_bytes": 200, "http_method": "POST"},
            {"dst_ip": "198.51.100.77", "orig_bytes": 300_000, "resp_bytes": 10},
            {"dst_ip": "10.1.1.1", "orig_bytes": 300_000, "resp_bytes": 10},
        ]
    )
    got = {r.dst_ip: r.confidence for r in tr.detect_exfil(df).collect()}
    assert got == {"198.51.100.44": 1.0, "198.51.100.77": 0.7}
    limited = {r.dst_ip for r in tr.detect_exfil(df, min_raw_upload_bytes=500_000).collect()}
    assert limited == {"198.51.100.44"}


def test_simulated_scope_keeps_private_responder(conns, spark):
    df = conns([{"dst_ip": "10.1.1.1", "orig_bytes": 300_000, "resp_bytes": 10}])
    allow = spark.createDataFrame([("c1", "10.1.1.1")], "case_id string, dst_ip string")
    assert tr.detect_exfil(df, allow=allow).count() == 1


def test_ftp_and_egress(conns):
    df = conns(
        [
            {"dst_ip": "198.51.100.9", "dst_port": 21, "ftp_upload_cmd": "STOR a.txt", "orig_bytes": 90},
            {"dst_ip": "198.51.100.9", "dst_port": 21, "ftp_upload_cmd": "STOR b.txt"},
            {"dst_ip": "198.51.100.8", "orig_bytes": 5000, "resp_bytes": 100},
            {"dst_ip": "198.51.100.8", "orig_bytes": 9000, "resp_bytes": 100},
            {"dst_ip": "198.51.100.7", "orig_bytes": 100, "resp_bytes": 1},
        ]
    )
    ftp = tr.detect_ftp_exfil(df)
    assert [(r.http_uri, r.confidence) for r in ftp.collect()] == [("STOR a.txt", 0.8)]
    egress = tr.detect_unclassified_egress(df, ftp).collect()
    assert [(r.dst_ip, r.orig_bytes, r.upload_ratio) for r in egress] == [("198.51.100.8", 5000, 0.98)]
