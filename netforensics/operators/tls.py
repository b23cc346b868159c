"""TLS operators: fingerprints from parsed hello components, certificates, fingerprint records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netforensics.functions.ip import is_private
from netforensics.functions.lookup import literals, mapped, seed_frame
from netforensics.operators.keyed import first_per, last_per
from netforensics.vocab import GREASE, KNOWN_BAD_JA3, TLS_VERSION_LABEL


def without_grease(values: Column) -> Column:
    return F.filter(values, lambda v: ~v.isin(GREASE))


def _dashed(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda v: v.cast("string")), "-")


def ja3_text(version: Column, ciphers: Column, extensions: Column, curves: Column, formats: Column) -> Column:
    """The client fingerprint string; GREASE values are removed."""
    return F.concat_ws(
        ",",
        version.cast("string"),
        _dashed(without_grease(ciphers)),
        _dashed(without_grease(extensions)),
        _dashed(without_grease(curves)),
        _dashed(formats),
    )


def ja3s_text(version: Column, cipher: Column, extensions: Column) -> Column:
    """The server fingerprint string."""
    return F.concat_ws(",", version.cast("string"), cipher.cast("string"), _dashed(without_grease(extensions)))


def _hex4(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value.cast("bigint")), 4, "0"))


def ja4_text(
    version: Column, supported: Column, ciphers: Column, extensions: Column,
    signatures: Column, alpns: Column, sni: Column, transport: str = "t",
) -> Column:
    """The sorted client fingerprint a_b_c."""
    ciphers, extensions = without_grease(ciphers), without_grease(extensions)
    offered = F.array_max(without_grease(supported))
    label = F.coalesce(mapped(F.coalesce(offered, version), TLS_VERSION_LABEL), F.lit("00"))
    name_flag = F.when(sni.isNotNull() & (sni != ""), "d").otherwise("i")

    def two(values: Column) -> Column:
        return F.lpad(F.least(F.size(values), F.lit(99)).cast("string"), 2, "0")

    first = F.get(alpns, F.lit(0))
    alpn = F.when(
        F.coalesce(first, F.lit("")) != "", F.concat(F.substr(first, F.lit(1), F.lit(1)), F.right(first, F.lit(1)))
    ).otherwise("00")
    sorted_ciphers = F.array_join(F.array_sort(F.transform(ciphers, _hex4)), ",")
    plain = F.filter(extensions, lambda e: ~e.isin(0x0000, 0x0010))
    sorted_ext = F.array_join(F.array_sort(F.transform(plain, _hex4)), ",")
    sigs = F.array_join(F.transform(signatures, _hex4), ",")

    def short(text: Column) -> Column:
        return F.substr(F.sha2(text, 256), F.lit(1), F.lit(12))

    part_a = F.concat(F.lit(transport), label, name_flag, two(ciphers), two(extensions), alpn)
    return F.concat_ws("_", part_a, short(sorted_ciphers), short(F.concat(sorted_ext, F.lit("_"), sigs)))


def fingerprint_hellos(hellos: DataFrame) -> DataFrame:
    """Add ja3, ja4 (client) or ja3s (server) to a table of parsed hello components."""
    client = F.col("message") == "client"
    ja3 = F.md5(ja3_text(F.col("version"), F.col("ciphers"), F.col("extensions"), F.col("curves"), F.col("formats")))
    ja4 = ja4_text(
        F.col("version"), F.col("supported_versions"), F.col("ciphers"), F.col("extensions"),
        F.col("sig_algs"), F.col("alpns"), F.col("sni"),
    )
    ja3s = F.md5(ja3s_text(F.col("version"), F.get(F.col("ciphers"), F.lit(0)), F.col("extensions")))
    return (
        hellos.withColumn("ja3", F.when(client, ja3))
        .withColumn("ja4", F.when(client, ja4))
        .withColumn("ja3s", F.when(F.col("message") == "server", ja3s))
    )


def first_client_hello(hellos: DataFrame) -> DataFrame:
    """The first ClientHello per (case, src, dst, port)."""
    keys = ["case_id", "src_ip", "dst_ip", "dst_port"]
    rows = hellos.filter((F.col("message") == "client") & F.col("ja3").isNotNull()).select(
        *keys, "seq", "ts", F.col("sni").alias("server_name"), "ja3", "ja4"
    )
    return first_per(rows, keys)


def pair_hellos(hellos: DataFrame) -> DataFrame:
    """Client and server fingerprints per client flow; the last message of each kind wins."""
    server = F.col("message") == "server"
    flows = hellos.select(
        "case_id",
        F.when(server, F.col("dst_ip")).otherwise(F.col("src_ip")).alias("src_ip"),
        F.when(server, F.col("src_ip")).otherwise(F.col("dst_ip")).alias("dst_ip"),
        F.when(server, F.col("src_port")).otherwise(F.col("dst_port")).alias("dst_port"),
        "message", "seq", "sni", "ja3", "ja3s",
    )
    client_row = F.max(F.when(F.col("message") == "client", F.struct("seq", "ja3", "sni")))
    server_row = F.max(F.when(F.col("message") == "server", F.struct("seq", "ja3s")))
    return (
        flows.groupBy("case_id", "src_ip", "dst_ip", "dst_port")
        .agg(client_row.alias("c"), server_row.alias("s"))
        .select(
            "case_id", "src_ip", "dst_ip", "dst_port",
            F.col("c.ja3").alias("ja3"), F.col("s.ja3s").alias("ja3s"), F.col("c.sni").alias("server_name"),
        )
    )


def fingerprint_records(tls: DataFrame, require_ja3: bool = False) -> DataFrame:
    """One record per (case, src, dst, port): the last row's values at the first row's place.

    `first_seq` keeps the position at which the key was first seen.
    """
    keys = ["case_id", "src_ip", "dst_ip", "dst_port"]
    rows = tls.filter(F.col("ja3").isNotNull() & (F.col("ja3") != "")) if require_ja3 else tls
    return (
        rows.groupBy(*keys)
        .agg(
            F.min("seq").alias("first_seq"),
            F.max(F.struct("seq", "ja3", "ja3s", "server_name", "subject")).alias("r"),
        )
        .select(*keys, "first_seq", "r.ja3", "r.ja3s", "r.server_name", "r.subject")
    )


def service_fingerprint(tls: DataFrame) -> DataFrame:
    """Fingerprint of a (case, dst, port): its first record whatever the source address."""
    records = fingerprint_records(tls, require_ja3=True).select(
        "case_id", "dst_ip", "dst_port", "first_seq", "ja3", "server_name"
    )
    return first_per(records, ["case_id", "dst_ip", "dst_port"], ["first_seq"]).drop("first_seq")


def known_bad_ja3(rows: DataFrame) -> DataFrame:
    """Rows whose JA3 is on the built-in list, with its description."""
    listed = seed_frame(rows.sparkSession, KNOWN_BAD_JA3, "ja3 string, description string")
    return rows.join(listed, "ja3")


def certificate_findings(tls: DataFrame) -> DataFrame:
    """Self-signed (strong) or failed-validation (weak) certificates, one row per TLS row."""
    subject = F.trim(F.coalesce("subject", F.lit("")))
    issuer = F.trim(F.coalesce("issuer", F.lit("")))
    status = F.lower(F.trim(F.coalesce("validation_status", F.lit(""))))
    self_signed = (subject != "") & (subject == issuer)
    failed = ~status.isin("ok", "", "-")
    return tls.filter(self_signed | failed).select(
        "case_id", "seq", "dst_ip", "dst_port", "server_name", "ja3", "ja4",
        F.when(self_signed, F.lit("self-signed certificate"))
        .otherwise(F.concat(F.lit("certificate validation failed: "), status))
        .alias("reason"),
        F.when(self_signed, "strong").otherwise("weak").alias("severity"),
    )


def tls_findings(tls: DataFrame, covered: DataFrame | None, intel: DataFrame) -> DataFrame:
    """Reputation hits (first per destination) and certificate findings seen before such a hit.

    Only public destinations that no earlier detector covered count; without `covered` the caller drops
    the others. A certificate row is kept when its destination had no reputation hit up to and
    including that row.
    """
    from netforensics.operators.joins import lookup_indicators

    public = tls.filter(~is_private(F.col("dst_ip")))
    if covered is not None:
        public = public.join(covered.select("case_id", "dst_ip").distinct(), ["case_id", "dst_ip"], "left_anti")
    hits = lookup_indicators(public, intel).filter(F.col("reputation_hit"))
    first_hits = first_per(
        hits.select(
            "case_id", "dst_ip", "seq", "dst_port", "server_name", "ja3", "ja4",
            "reputation_source", "reputation_note", "match_on",
        ),
        ["case_id", "dst_ip"],
    )
    reputation = first_hits.select(
        "case_id", "seq", F.lit("ja3").alias("kind"), "dst_ip", "dst_port", "server_name", "ja3", "ja4",
        F.lit(0.7).alias("confidence"), F.lit(True).alias("reputation_hit"),
        F.lit(None).cast("string").alias("severity"), F.lit(None).cast("string").alias("reason"), "match_on",
    )
    stop = first_hits.select("case_id", "dst_ip", F.col("seq").alias("_hit_seq"))
    certs = (
        certificate_findings(public)
        .join(stop, ["case_id", "dst_ip"], "left")
        .filter(F.col("_hit_seq").isNull() | (F.col("seq") < F.col("_hit_seq")))
        .select(
            "case_id", "seq", F.lit("tls_cert").alias("kind"), "dst_ip", "dst_port", "server_name", "ja3", "ja4",
            F.lit(0.6).alias("confidence"), F.lit(False).alias("reputation_hit"),
            "severity", "reason", F.lit(None).cast("string").alias("match_on"),
        )
    )
    return reputation.unionByName(certs)
