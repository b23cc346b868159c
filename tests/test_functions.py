from __future__ import annotations

import ipaddress
import math
import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from netforensics.functions import ip, numbers, rules, text
from netforensics.operators import tiers as ti
from netforensics.vocab import GREASE


def one(spark, *columns):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def test_address_classes(spark):
    values = [
        "10.0.0.1", "172.16.0.1", "172.32.0.1", "192.168.1.1", "127.0.0.1", "169.254.1.1", "0.1.2.3", "203.0.113.9",
        "8.8.8.8", "::1", "fe80::1", "fd00::5", "2001:4860:4860::8888", "999.1.1.1", "01.2.3.4", "example.com", "", "1.2.3",
    ]
    internal = [ipaddress.ip_network(n) for n in (
        "10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16", "127.0.0.0/8", "169.254.0.0/16", "0.0.0.0/8", "::1/128",
        "fe80::/10", "fc00::/7")]

    def private(v):
        try:
            a = ipaddress.ip_address(v)
        except ValueError:
            return False
        return any(a in n for n in internal if n.version == a.version)

    def literal(v):
        try:
            ipaddress.ip_address(v)
            return True
        except ValueError:
            return False

    df = spark.createDataFrame([(v,) for v in values], "a string")
    for r in df.select("a", ip.is_private(F.col("a")).alias("p"), ip.is_ip_literal(F.col("a")).alias("l")).collect():
        assert (r.p, r.l) == (private(r.a), literal(r.a)), r.a


def test_cidr_bounds_equal_the_library(spark):
    rng = random.Random(1)
    nets = [f"{rng.randint(1, 223)}.{rng.randint(0, 255)}.{rng.randint(0, 255)}.0/{rng.randint(8, 32)}" for _ in range(60)]
    nets += ["2001:db8::/33", "fe80::/10", "::/0", "2001:db8:1:2::/61"]
    low, high = ip.cidr_bounds(F.col("n"))
    df = spark.createDataFrame([(n,) for n in nets], "n string").select("n", low.alias("lo"), high.alias("hi"))
    for r in df.collect():
        net = ipaddress.ip_network(r.n, strict=False)
        width = 8 if net.version == 4 else 32
        assert r.lo == f"{net.version}{int(net.network_address):0{width}x}", r.n
        assert r.hi == f"{net.version}{int(net.broadcast_address):0{width}x}", r.n


def test_entropy_and_names(spark):
    names = ["a.b.example.com", "example.com", "com", "aaaa", "x1y2z3"]
    c = F.col("n")
    df = spark.createDataFrame([(n,) for n in names], "n string").select(
        "n", text.entropy(c).alias("e"), text.registered_domain(c).alias("r"), text.subdomain(c).alias("s"))
    for r in df.collect():
        want = -sum(k / len(r.n) * math.log2(k / len(r.n)) for k in Counter(r.n).values())
        assert abs(r.e - want) < 1e-12
        labels = r.n.split(".")
        assert r.r == ".".join(labels[-2:]) and r.s == ".".join(labels[:-2])


@pytest.mark.parametrize("raw, want", [
    ("188.190.10.10:55123", None), ("Evil.Example.com:8080", "evil.example.com"), ("[2001:db8::1]:8080", None),
    ("2001:db8::1", None), ("localhost", None), ("a.example.", "a.example"), ("  ", None), (None, None)])
def test_host_header(spark, raw, want):
    assert one(spark, text.host_header_domain(F.lit(raw).cast("string"))) == (want,)


def test_iso_times(spark):
    assert one(spark, numbers.parse_iso(F.lit("2024-10-23T19:15:30Z")), numbers.parse_iso(F.lit("2024-10-23T21:15:30+02:00")),
               numbers.parse_iso(F.lit("2024-10-23T19:15:30")), numbers.parse_iso(F.lit("soon"))) == (1729710930.0, 1729710930.0, None, None)
    assert one(spark, numbers.iso_utc(F.lit(1729710930.5)))[0] == "2024-10-23T19:15:30.500000+00:00"


def test_uuid5_matches_the_library(spark):
    names = [f"ip:1.2.3.{i}" for i in range(40)]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", rules.uuid5(F.col("n")).alias("u"))
    assert all(r.u == str(uuid.uuid5(uuid.NAMESPACE_URL, r.n)) for r in df.collect())


@pytest.mark.parametrize("mode, want", [
    ("simulated_inetsim", "simulated"), ("Isolated-Simulated", "simulated"), ("live egress", "real"), ("odd", "unknown"), (None, "unknown")])
def test_network_mode(spark, mode, want):
    assert one(spark, rules.network_mode(F.lit(mode).cast("string"))) == (want,)


def test_clock_rule(spark):
    n, b = F.lit(None).cast("double"), F.lit(None).cast("boolean")
    got = one(spark, rules.clock_acceptable(F.lit(False), F.lit(1.0)), rules.clock_acceptable(b, F.lit(5e9)),
              rules.clock_acceptable(b, F.lit(5.1e9)), rules.clock_acceptable(b, n))
    assert got == (False, True, False, False)


def test_degraded_providers(spark):
    p = F.array(F.lit("Microsoft-Windows-Kernel-File"), F.lit("Win32k"))
    got = one(spark, F.array_sort(rules.degraded_types(p)), rules.degraded_everywhere(p),
              rules.degraded_everywhere(F.array(F.lit("Other"))), rules.degraded_everywhere(F.array().cast("array<string>")))
    assert got == (["clipboard", "file_access", "keystrokes", "screenshot"], False, True, True)


def test_match_keys(spark):
    def keys(kind, value):
        return sorted(one(spark, ti.match_keys(F.lit(kind), F.lit(value)))[0])

    assert keys("url", "http://Evil.example:8080/gate.php") == ["evil.example"]
    assert keys("url", "198.51.100.7/x") == ["198.51.100.7"]
    assert keys("email", "Drop@Evil.example") == ["drop@evil.example", "evil.example"]
    assert keys("ip", " 1.2.3.4 ") == ["1.2.3.4"] and keys("domain", "A.b") == ["a.b"]


def test_grease_values():
    assert GREASE == [int(f"{d}a{d}a", 16) for d in "0123456789abcdef"]


def test_object_label_elision(spark):
    long = "C:/" + "x" * 300 + "/Login Data"
    got = one(spark, rules.object_label(F.lit(long)), rules.object_label(F.lit(" a \n b ")), rules.object_label(F.lit(" ")))
    assert len(got[0]) <= 160 and got[0].startswith("C:/") and got[0].endswith("Login Data") and "..." in got[0]
    assert got[1:] == ("a b", None)


def test_iso_texts_in_basic_form(spark):
    from netforensics.functions.numbers import parse_iso

    texts = ["20241023T191530Z", "2024-10-23T19:15:30,5Z", "20241023T191530.5+0000", "20241023T1915Z", "2024-10-23T19:15:30+00:00",
             "2024-10-23T19:15:30", "20241323T191530Z", "yesterday", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string").orderBy("i")
    got = [r.v for r in rows.select(parse_iso(rows.s).alias("v")).collect()]
    second = 1729710930.0
    assert got == [second, second + 0.5, second + 0.5, second - 30, second, None, None, None, None]
