"""The detector view of sessions, record counts and case scope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netforensics.functions.ip import is_noise, is_special
from netforensics.functions.numbers import parse_iso
from netforensics.operators.keyed import first_per, unmatched_key
from netforensics.vocab import FTP_STORE_COMMANDS, GUEST_SENTINELS

TIMED_TABLES = ("sessions", "dns", "http", "tls", "ftp", "smtp")


def is_upload() -> Column:
    return F.upper("command").isin(FTP_STORE_COMMANDS)


def to_connections(sessions: DataFrame, http: DataFrame, ftp: DataFrame) -> DataFrame:
    """Sessions enriched with their HTTP request and FTP store command.

    A transaction is found by uid first, else by its endpoints; the first row in input order
    stands for each key.
    """
    requests = http.select(
        "case_id", "seq", "src_ip", "dst_ip", "dst_port", "uid",
        F.struct(F.col("method"), F.col("host"), F.col("uri")).alias("request"),
    )
    uploads = ftp.filter(is_upload()).select(
        "case_id", "seq", "src_ip", "dst_ip", "uid",
        F.trim(F.concat(F.col("command"), F.lit(" "), F.coalesce("arg", F.lit("None")))).alias("stored"),
    )
    has_uid = F.col("uid").isNotNull() & (F.col("uid") != "")

    def first_uid(rows: DataFrame, value: str, name: str) -> DataFrame:
        return first_per(rows.filter(has_uid).select("case_id", "uid", "seq", value), ["case_id", "uid"]).select(
            "case_id", F.col("uid").alias("_uid"), F.col(value).alias(name)
        )

    by_uid = first_uid(requests, "request", "_request_uid").join(
        first_uid(uploads, "stored", "_stored_uid"), ["case_id", "_uid"], "full_outer"
    )
    service = ["case_id", "src_ip", "dst_ip", "dst_port"]
    pair = ["case_id", "src_ip", "dst_ip"]
    by_service = first_per(requests.select(*service, "seq", "request"), service).select(
        *service, F.col("request").alias("_request_key")
    )
    by_pair = first_per(uploads.select(*pair, "seq", "stored"), pair).select(*pair, F.col("stored").alias("_stored_key"))
    request = F.coalesce("_request_uid", "_request_key")
    return (
        sessions.withColumn("_uid", unmatched_key(F.col("uid"), F.col("seq")))
        .join(by_uid, ["case_id", "_uid"], "left")
        .join(by_service, service, "left")
        .join(by_pair, pair, "left")
        .select(
            "case_id", "seq", "ts", "src_ip", "dst_ip", "dst_port", "proto", "orig_bytes", "resp_bytes", "history",
            request.getField("method").alias("http_method"),
            request.getField("host").alias("http_host"),
            request.getField("uri").alias("http_uri"),
            F.coalesce("_stored_uid", "_stored_key").alias("ftp_upload_cmd"),
        )
    )


def record_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per (case, table)."""
    out = None
    for name, table in tables.items():
        part = table.groupBy("case_id").agg(F.count(F.lit(1)).alias("records")).select(
            "case_id", F.lit(name).alias("table_name"), "records"
        )
        out = part if out is None else out.unionByName(part)
    return out


def normal_guest(guest: Column) -> Column:
    """Guest address, NULL for placeholders that mean "not known"."""
    return F.when(~F.lower(F.trim(guest)).isin(GUEST_SENTINELS), guest)


def infer_guest(sessions: DataFrame) -> DataFrame:
    """The private address that originates most sessions of a case; first seen wins a tie."""
    counts = (
        sessions.filter(is_special(F.col("src_ip")))
        .groupBy("case_id", "src_ip")
        .agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"))
    )
    best = F.max(F.struct("n", (-F.col("first_seq")).alias("_early"), "src_ip"))
    return counts.groupBy("case_id").agg(best.alias("b")).select(
        "case_id", F.col("b.src_ip").alias("guest_ip"), F.col("b.n").alias("sessions")
    )


def guests(manifests: DataFrame, sessions: DataFrame) -> DataFrame:
    """Guest per case of the manifest: the stated one, else the inferred one."""
    inferred = infer_guest(sessions).select("case_id", F.col("guest_ip").alias("_inferred"))
    return manifests.select("case_id", normal_guest(F.col("guest_ip")).alias("_stated")).join(
        inferred, "case_id", "left"
    ).select("case_id", F.coalesce("_stated", "_inferred").alias("guest_ip"))


def scope_rules(manifests: DataFrame, sessions: DataFrame) -> DataFrame:
    """(case_id, guest_ip, start_s, end_s): one small row per case with a manifest."""
    window = manifests.select(
        "case_id",
        parse_iso(F.col("detonation_start_utc"), require_zone=False).alias("start_s"),
        parse_iso(F.col("detonation_end_utc"), require_zone=False).alias("end_s"),
    )
    return window.join(guests(manifests, sessions), "case_id", "left")


def in_scope(timed: bool) -> Column:
    guest = F.col("guest_ip").isNull() | (F.col("src_ip") == F.col("guest_ip")) | (F.col("dst_ip") == F.col("guest_ip"))
    if not timed:
        return guest
    after = F.col("start_s").isNull() | F.col("ts").isNull() | (F.col("ts") >= F.col("start_s"))
    before = F.col("end_s").isNull() | F.col("ts").isNull() | (F.col("ts") <= F.col("end_s"))
    return guest & after & before


def scope_table(table: DataFrame, rules: DataFrame, timed: bool = True) -> DataFrame:
    """Rows in which the guest takes part inside the detonation window."""
    kept = table.join(rules, "case_id", "left").filter(F.coalesce(in_scope(timed), F.lit(False)))
    return kept.select(*table.columns)


def scope_case(tables: dict[str, DataFrame], rules: DataFrame) -> dict[str, DataFrame]:
    """Scope every record table; ICMP has no time and artifacts are left alone."""
    out = dict(tables)
    for name in (*TIMED_TABLES, "icmp"):
        if name in out:
            out[name] = scope_table(out[name], rules, timed=name != "icmp")
    return out


def scope_summary(tables: dict[str, DataFrame], rules: DataFrame) -> DataFrame:
    """Kept and removed rows per (case, table)."""
    out = None
    for name, table in tables.items():
        kept = F.coalesce(in_scope(timed=name != "icmp"), F.lit(False)).cast("bigint")
        part = (
            table.join(rules, "case_id", "left")
            .groupBy("case_id")
            .agg(F.sum(kept).alias("kept"), F.sum(1 - kept).alias("removed"))
            .select("case_id", F.lit(name).alias("table_name"), "kept", "removed")
        )
        out = part if out is None else out.unionByName(part)
    return out


def simulated_scope(sessions: DataFrame, guest: DataFrame, infrastructure: DataFrame | None = None) -> DataFrame:
    """Private, non-noise destinations of the guest: the responders of a simulated network."""
    rows = sessions.select("case_id", "src_ip", "dst_ip").distinct().join(guest, "case_id", "left")
    from_guest = F.col("guest_ip").isNull() | (F.col("src_ip") == F.col("guest_ip"))
    not_guest = F.col("guest_ip").isNull() | (F.col("dst_ip") != F.col("guest_ip"))
    scope = (
        rows.filter(from_guest & not_guest & is_special(F.col("dst_ip")) & ~is_noise(F.col("dst_ip")))
        .select("case_id", "dst_ip")
        .distinct()
    )
    if infrastructure is not None:
        scope = scope.join(infrastructure.select("case_id", "dst_ip").distinct(), ["case_id", "dst_ip"], "left_anti")
    return scope


def infrastructure(dns: DataFrame, guest: DataFrame | None = None) -> DataFrame:
    """Addresses that are transport, not endpoints: DNS resolvers and the guest."""
    out = dns.filter(F.col("dst_ip").isNotNull() & (F.col("dst_ip") != "")).select("case_id", "dst_ip")
    if guest is not None:
        out = out.unionByName(
            guest.filter(F.col("guest_ip").isNotNull()).select("case_id", F.col("guest_ip").alias("dst_ip"))
        )
    return out.distinct()
