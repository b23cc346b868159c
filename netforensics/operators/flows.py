"""Jobs over a decoded packet table: flows, envelopes, outbound content, case tables.

Packets: case_id, seq, ts, src_ip, src_port, dst_ip, dst_port, proto, payload (BINARY).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from netforensics.functions.ip import is_private
from netforensics.functions.lookup import mapped
from netforensics.operators.folds import Fold, fold
from netforensics.operators.tls import first_client_hello
from netforensics.vocab import DNS_QTYPES, DNS_RCODES, SMTP_PORTS

PREVIEW_BYTES = 300
_LINE = r"(?:(?!\r\n).)*"


def latin1(payload: Column) -> Column:
    return F.decode(payload, "ISO-8859-1")


def _http_parts(head: Column) -> tuple[Column, Column, Column]:
    method = F.regexp_extract(head, r"^(POST|GET|PUT) ", 1)
    uri = F.substring_index(F.substring_index(head, " ", 2), " ", -1)
    # The greedy prefix finds the last Host line of the request head, which ends at the first blank line.
    pattern = rf"(?is)^(?:.*\r\n)?host:({_LINE})"
    lines = F.substring_index(head, "\r\n\r\n", 1)
    host = F.when(lines.rlike(pattern), F.trim(F.regexp_extract(lines, pattern, 1)))
    return F.when(method != "", method), uri, host


def _store_command(head: Column) -> Column:
    pattern = rf"(?is)(?:^|\r\n)\s*((?:STOR |STOU |APPE ){_LINE}|STOU(?=\s*(?:\r\n|$)))"
    found = F.trim(F.regexp_extract(head, pattern, 1))
    return F.when(found != "", found)


def assemble_flows(packets: DataFrame, head_bytes: int | None = None) -> DataFrame:
    """One row per bidirectional TCP flow with bytes per direction and what the client asked.

    Requests and commands are looked for in the whole payload of a packet, or in its first
    `head_bytes` bytes only.

    Both directions are summed under the sorted endpoints in one aggregate; which side is the
    client is decided afterwards (the internal side, else the first packet's source).
    """
    source = F.struct(F.col("src_ip").alias("ip"), F.col("src_port").alias("port"))
    target = F.struct(F.col("dst_ip").alias("ip"), F.col("dst_port").alias("port"))
    forward = source <= target
    head = latin1(F.col("payload") if head_bytes is None else F.substring("payload", 1, head_bytes))
    method, uri, host = _http_parts(F.col("_head"))
    base = packets.filter(F.lower("proto") == "tcp").withColumn("_head", head).select(
        "case_id", "seq", "ts",
        forward.alias("fwd"),
        F.least(source, target).alias("a"), F.greatest(source, target).alias("b"),
        F.coalesce(F.octet_length("payload"), F.lit(0)).cast("bigint").alias("size"),
        method.alias("method"), uri.alias("uri"), host.alias("host"), _store_command(F.col("_head")).alias("store"),
    )

    def per_direction(flag: Column, tag: str) -> list[Column]:
        request = flag & F.col("method").isNotNull()
        return [
            F.sum(F.when(flag, F.col("size")).otherwise(0)).alias(f"{tag}_bytes"),
            F.max(F.when(request, F.struct("seq", "method", "uri"))).alias(f"{tag}_request"),
            F.max(F.when(request & F.col("host").isNotNull(), F.struct("seq", "host"))).alias(f"{tag}_host"),
            F.min(F.when(flag & F.col("store").isNotNull(), F.struct("seq", "store"))).alias(f"{tag}_store"),
        ]

    flows = base.groupBy("case_id", "a", "b").agg(
        F.min(F.struct("seq", "ts", "fwd")).alias("first"),
        *per_direction(F.col("fwd"), "ab"), *per_direction(~F.col("fwd"), "ba"),
    )
    inside_a, inside_b = is_private(F.col("a.ip")), is_private(F.col("b.ip"))
    a_is_client = (
        F.when(inside_a & ~inside_b, True).when(inside_b & ~inside_a, False).otherwise(F.col("first.fwd"))
    )
    flows = flows.withColumn("_ac", a_is_client)

    def side(when_a: str, when_b: str) -> Column:
        return F.when(F.col("_ac"), F.col(when_a)).otherwise(F.col(when_b))

    return flows.select(
        "case_id", F.col("first.seq").alias("seq"), F.col("first.ts").alias("ts"),
        side("a.ip", "b.ip").alias("src_ip"), side("a.port", "b.port").alias("src_port"),
        side("b.ip", "a.ip").alias("dst_ip"), side("b.port", "a.port").alias("dst_port"),
        F.lit("tcp").alias("proto"),
        side("ab_bytes", "ba_bytes").alias("orig_bytes"), side("ba_bytes", "ab_bytes").alias("resp_bytes"),
        F.lit("").alias("history"),
        side("ab_request.method", "ba_request.method").alias("http_method"),
        side("ab_host.host", "ba_host.host").alias("http_host"),
        side("ab_request.uri", "ba_request.uri").alias("http_uri"),
        side("ab_store.store", "ba_store.store").alias("ftp_upload_cmd"),
    )


MAIL_FLOW = ["case_id", "src_ip", "dst_ip", "dst_port"]


def _mail_lines(packets: DataFrame) -> DataFrame:
    mail = packets.filter(
        (F.lower("proto") == "tcp") & F.col("dst_port").isin(SMTP_PORTS) & (F.octet_length("payload") > 0)
    )
    lines = mail.select(
        *MAIL_FLOW, "seq", "ts", F.posexplode(F.split(latin1(F.col("payload")), "\r\n")).alias("line_no", "line")
    )
    low = F.lower("line")
    attachment = low.startswith("content-disposition:") & low.contains("attachment")
    kind = (
        F.when(low.startswith("mail from:"), "sender").when(low.startswith("rcpt to:"), "recipient")
        .when(low.startswith("subject:"), "subject").when(attachment, "attachment")
    )
    after = F.trim(F.regexp_replace("line", r"^[^:]*:", ""))
    value = (
        F.when(kind.isin("sender", "recipient"), F.btrim(after, F.lit("<>"))).when(kind == "attachment", "attachment").otherwise(after)
    )
    return lines.select(*MAIL_FLOW, "seq", "ts", F.struct("seq", "line_no").alias("place"), kind.alias("kind"), value.alias("value"))


def smtp_envelopes(packets: DataFrame) -> DataFrame:
    """One row per client-to-server mail flow: the last sender and subject, and how many attachments.

    Recipients and attachments are rows of `smtp_items`, so that a flow may have any number of them.
    """
    kind, valued = F.col("kind"), F.struct("place", "value")
    main = _mail_lines(packets).groupBy(*MAIL_FLOW).agg(
        F.min(F.struct("seq", "ts")).alias("first"),
        F.max(F.when(kind == "sender", valued)).alias("sender"),
        F.max(F.when(kind == "subject", valued)).alias("subject"),
        F.count(F.when(kind == "attachment", 1)).alias("attached"),
    )
    return main.select(
        "case_id", F.col("first.seq").alias("seq"), F.col("first.ts").alias("ts"), "src_ip", "dst_ip", "dst_port",
        F.col("sender.value").alias("mail_from"), F.col("subject.value").alias("subject"), "attached",
    )


def smtp_items(packets: DataFrame) -> DataFrame:
    """(flow, kind, position, value): recipients (each address once) and attachments in order of appearance."""
    items = _mail_lines(packets).filter(
        ((F.col("kind") == "recipient") & (F.col("value") != "")) | (F.col("kind") == "attachment")
    )
    # A recipient is one item wherever it is named again, an attachment one for each time.
    again = F.when(F.col("kind") == "attachment", F.col("place"))
    once = items.groupBy(*MAIL_FLOW, "kind", "value", again.alias("_again")).agg(F.min("place").alias("place"))
    order = Window.partitionBy(*MAIL_FLOW, "kind").orderBy("place")
    return once.select(*MAIL_FLOW, "kind", F.row_number().over(order).alias("position"), "value")


def smtp_with_lists(envelopes: DataFrame, items: DataFrame) -> DataFrame:
    """Envelopes in the shape of a mail log, with both lists; for sinks and tables that are known to be read as lists."""
    def listed(kind: str) -> Column:
        own = F.collect_list(F.when(F.col("kind") == kind, F.struct("position", "value")))
        return F.transform(F.array_sort(own), lambda i: i["value"])

    lists = items.groupBy(*MAIL_FLOW).agg(listed("recipient").alias("rcpt_to"), listed("attachment").alias("attachments"))
    none = F.array().cast("array<string>")
    return envelopes.join(lists, MAIL_FLOW, "left").select(
        "case_id", "seq", "ts", "src_ip", "dst_ip", "dst_port", "mail_from", F.coalesce("rcpt_to", none).alias("rcpt_to"),
        "subject", F.coalesce("attachments", none).alias("attachments"),
    )


def icmp_echoes(packets: DataFrame) -> DataFrame:
    """Echo requests and replies with their data size (packets need icmp_type)."""
    return packets.filter(F.col("icmp_type").isin(8, 0)).select(
        "case_id", "seq", "src_ip", "dst_ip", F.octet_length("payload").alias("data_len")
    )


class _Content(Fold):
    """Digest of all bytes of a flow, digest of its head, the first bytes and the size."""

    def __init__(self, head_bytes: int):
        self.whole, self.head, self.room = hashlib.sha256(), hashlib.sha256(), head_bytes
        self.first, self.size, self.start = None, 0, b""

    def add(self, seq, ts, payload) -> None:
        if self.first is None:
            self.first = (seq, ts)
        self.whole.update(payload)
        self.size += len(payload)
        if self.room:
            own = payload[: self.room]
            self.head.update(own)
            self.room -= len(own)
        if len(self.start) < PREVIEW_BYTES:
            self.start += payload[: PREVIEW_BYTES - len(self.start)]

    def result(self) -> tuple:
        return (*self.first, self.size, self.whole.hexdigest(), self.head.hexdigest(), self.start)


def outbound_content(packets: DataFrame, min_bytes: int = 64, head_bytes: int = 1 << 20) -> DataFrame:
    """Content sent to public hosts per (src, dst, port): true size, hash of every byte and preview.

    The packets of a flow stream in order through a task that carries the state of two digests, so a
    flow may have any size and packets are read once. `head_sha256` covers the first `head_bytes`
    bytes, for comparison with tools that stop there.
    """
    flow = ["case_id", "src_ip", "dst_ip", "dst_port"]
    sent = packets.filter(
        (F.lower("proto") == "tcp") & (F.octet_length("payload") > 0) & ~is_private(F.col("dst_ip"))
    ).select(*flow, "seq", "ts", "payload")
    schema = StructType([sent.schema[c] for c in (*flow, "seq", "ts")])
    for name, kind in (("total_bytes", "long"), ("sha256", "string"), ("head_sha256", "string"), ("start", "binary")):
        schema = schema.add(name, kind)
    content = fold(sent, flow, ["seq", "ts", "payload"], lambda: _Content(head_bytes), schema)
    preview = F.regexp_replace(latin1(F.col("start")), "[^ -~]", ".")
    none = F.lit(None).cast("string")
    return content.filter(F.col("total_bytes") >= min_bytes).select(
        "case_id", "seq", "ts", none.alias("filename"), none.alias("mime_type"), "total_bytes", none.alias("md5"), "sha256",
        F.col("src_ip").alias("source_ip"), F.col("dst_ip").alias("dest_ip"), F.lit(True).alias("is_outbound"),
        none.alias("uid"), preview.alias("preview"), "head_sha256",
    )


def outbound_artifacts(files: DataFrame, packets: DataFrame | None = None) -> DataFrame:
    """Outbound rows of files.log; cases without any fall back to reassembled content."""
    leaving = F.col("is_outbound") | (
        is_private(F.col("source_ip")) & F.col("dest_ip").isNotNull() & ~is_private(F.col("dest_ip"))
    )
    logged = files.filter(F.coalesce(leaving, F.lit(False))).withColumn("is_outbound", F.lit(True))
    if packets is None:
        return logged
    have = logged.select("case_id").distinct()
    return logged.unionByName(outbound_content(packets.join(have, "case_id", "left_anti")), allowMissingColumns=True)


def decoded_dns(rows: DataFrame) -> DataFrame:
    """DNS queries from decoded messages (qtype and rcode as numbers, is_response flag)."""
    none = F.lit(None).cast("string")
    return rows.filter(~F.col("is_response")).select(
        "case_id", "seq", "ts", "src_ip", "dst_ip", F.rtrim("query", F.lit(".")).alias("query"),
        F.coalesce(mapped(F.col("qtype"), DNS_QTYPES), F.col("qtype").cast("string")).alias("qtype"),
        mapped(F.col("rcode"), DNS_RCODES).alias("rcode"), F.array().cast("array<string>").alias("answers"),
        none.alias("uid"),
    )


def tables_from_packets(
    packets: DataFrame, dns_messages: DataFrame, hellos: DataFrame, logged_cases: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Case tables from packet-derived rows, for cases that have no logs."""
    if logged_cases is not None:
        cases = logged_cases.select("case_id").distinct()
        packets, dns_messages, hellos = (
            t.join(cases, "case_id", "left_anti") for t in (packets, dns_messages, hellos)
        )
    flows = assemble_flows(packets)
    none = F.lit(None).cast("string")
    sessions = flows.select(
        "case_id", "seq", "ts", "src_ip", F.lit(0).alias("src_port"), "dst_ip", "dst_port", "proto",
        none.alias("service"), "orig_bytes", "resp_bytes", "history", F.lit(0.0).alias("duration"),
        none.alias("conn_state"), none.alias("uid"),
    )
    http = flows.filter(F.col("http_method").isNotNull()).select(
        "case_id", "seq", "ts", "src_ip", "dst_ip", "dst_port", F.col("http_method").alias("method"),
        F.col("http_host").alias("host"), F.col("http_uri").alias("uri"), none.alias("user_agent"),
        F.lit(None).cast("int").alias("status_code"), F.lit(0).cast("bigint").alias("req_body_len"),
        F.lit(0).cast("bigint").alias("resp_body_len"), none.alias("uid"),
    )
    words = F.split("ftp_upload_cmd", " ", 2)
    ftp = flows.filter(F.col("ftp_upload_cmd").isNotNull()).select(
        "case_id", "seq", "ts", "src_ip", "dst_ip", words[0].alias("command"), F.get(words, F.lit(1)).alias("arg"),
        F.lit(None).cast("int").alias("reply_code"), none.alias("uid"),
    )
    tls = first_client_hello(hellos).select(
        "case_id", "seq", "ts", "src_ip", "dst_ip", "dst_port", "server_name", "ja3", none.alias("ja3s"), "ja4",
        none.alias("subject"), none.alias("issuer"), none.alias("validation_status"), none.alias("version"),
        none.alias("uid"),
    )
    out = {"sessions": sessions, "dns": decoded_dns(dns_messages), "http": http, "tls": tls, "ftp": ftp,
           "smtp": smtp_with_lists(smtp_envelopes(packets), smtp_items(packets)).drop("dst_port").withColumn("uid", none)}
    if "icmp_type" in packets.columns:
        out["icmp"] = icmp_echoes(packets)
    return out
