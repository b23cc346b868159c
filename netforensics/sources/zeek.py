"""Zeek logs (classic TSV and JSON lines) to typed record tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netforensics.functions.text import blank_to_null
from netforensics.operators.keyed import last_per
from netforensics.session import stored
from netforensics.sources.lines import read_lines

ADDRESS = ["ts", "id.orig_h", "id.orig_p", "id.resp_h", "id.resp_p", "uid"]
LOG_FIELDS = {
    "conn": [*ADDRESS, "proto", "service", "orig_bytes", "resp_bytes", "history", "duration", "conn_state"],
    "dns": [*ADDRESS, "query", "qtype_name", "rcode_name", "answers"],
    "http": [*ADDRESS, "method", "host", "uri", "user_agent", "status_code", "request_body_len", "response_body_len"],
    "ssl": [*ADDRESS, "server_name", "ja3", "ja3s", "ja4", "subject", "issuer", "validation_status", "version"],
    "ftp": [*ADDRESS, "command", "arg", "reply_code"],
    "smtp": [*ADDRESS, "mailfrom", "rcptto", "subject", "fuids"],
    "files": ["ts", "filename", "mime_type", "total_bytes", "md5", "sha256", "tx_hosts", "rx_hosts", "conn_uids"],
}
TABLE_OF_LOG = {"conn": "sessions", "dns": "dns", "http": "http", "ssl": "tls", "ftp": "ftp", "smtp": "smtp",
                "files": "artifacts"}


LIST_FIELDS = frozenset({"answers", "rcptto", "fuids", "tx_hosts", "rx_hosts"})


def file_headers(lines: DataFrame, fields: list[str]) -> DataFrame:
    """(case_id, file, _from, _to, _places): the #fields lines, each ruling until the next one.

    `_places` holds the 0-based column of every wanted field, found once per header (null: absent).
    """
    names = F.split("value", "\t")
    # The first word is "#fields" itself, so the 1-based position in it is the column number plus two.
    places = F.struct(*[
        (F.nullif(F.array_position("_words", F.lit(n)).cast("int"), F.lit(0)) - 2).alias(f"p{i}")
        for i, n in enumerate(fields)
    ])
    headers = lines.filter(F.col("value").startswith("#fields")).select(
        "case_id", "file", F.col("seq").alias("_from"), names.alias("_words")
    )
    following = F.lead("_from").over(Window.partitionBy("case_id", "file").orderBy("_from"))
    return headers.select("case_id", "file", "_from", following.alias("_to"), places.alias("_places"))


def parse_log(lines: DataFrame, fields: list[str]) -> DataFrame:
    """All rows of a log whatever its encoding (classic TSV or JSON lines), every field as text.

    TSV values are found by the place of their name in the file's header; a JSON line that is not
    valid is skipped. Lists (LIST_FIELDS) come out as JSON arrays whichever encoding they had. TSV
    lines meet their header in an equi join on (case, file). The headers, one short row each, are
    stored first, so that Spark knows their size: it broadcasts them and the lines stay in the splits
    they were read in, however large a file is. JSON lines go around the join.
    """
    body = lines.filter((F.col("value") != "") & ~F.col("value").startswith("#"))
    is_json = F.col("value").startswith("{")
    schema = ", ".join(f"`{n}` string" for n in fields) + ", `_bad` string"
    parsed = F.from_json("value", schema, {"columnNameOfCorruptRecord": "_bad"})
    # A generator evaluates the text once per line; field access would parse once per field.
    encoded = body.filter(is_json).select("case_id", "seq", F.inline(F.array(parsed))).filter(F.col("_bad").isNull())
    from_json = encoded.select("case_id", "seq", *[blank_to_null(F.col(f"`{n}`")).alias(n) for n in fields])
    ruled = body.filter(~is_json).join(
        stored(file_headers(lines, fields), "headers").withColumnsRenamed({"case_id": "_case", "file": "_file"}),
        (F.col("case_id") == F.col("_case")) & (F.col("file") == F.col("_file"))
        & (F.col("seq") > F.col("_from")) & (F.col("_to").isNull() | (F.col("seq") < F.col("_to"))),
    )
    split = ruled.select("case_id", "seq", "_places", F.inline(F.array(F.struct(F.split("value", "\t").alias("_vals")))))

    def value(i: int, name: str) -> Column:
        plain = blank_to_null(F.get("_vals", F.col(f"_places.p{i}")))
        if name in LIST_FIELDS:
            plain = F.to_json(F.filter(F.split(plain, ","), lambda x: x != ""))
        return plain.alias(name)

    return split.select("case_id", "seq", *[value(i, n) for i, n in enumerate(fields)]).unionByName(from_json)


def number(name: str, kind: str, default=None) -> Column:
    """Lenient numeric cast; integers accept integer text and whole numbers written with a point (443.0)."""
    text = F.trim(F.col(f"`{name}`"))
    if kind in ("int", "bigint"):
        text = F.when(text.rlike(r"^[+-]?[0-9]+(\.0*)?$"), F.regexp_replace(text, r"\..*$", ""))
    value = text.try_cast(kind)
    return value if default is None else F.coalesce(value, F.lit(default).cast(kind))


def text_list(name: str) -> Column:
    """A list field of `parse_log` as ARRAY<STRING>; a JSON text is split at commas, NULL becomes an empty array."""
    col = F.col(f"`{name}`")
    return F.coalesce(
        F.when(col.startswith("["), F.from_json(col, "array<string>")),
        F.filter(F.split(col, ","), lambda x: x != ""),
        F.array().cast("array<string>"),
    )


def _text(name: str, default: str | None = None) -> Column:
    col = F.col(f"`{name}`")
    return col if default is None else F.coalesce(col, F.lit(default))


def _ends(port_default: int | None = 0, with_source_port: bool = False) -> list[Column]:
    out = ["case_id", "seq", number("ts", "double", 0.0).alias("ts"), _text("id.orig_h", "").alias("src_ip")]
    if with_source_port:
        out.append(number("id.orig_p", "int", 0).alias("src_port"))
    out.append(_text("id.resp_h", "").alias("dst_ip"))
    if port_default is not None:
        out.append(number("id.resp_p", "int", port_default).alias("dst_port"))
    return out


def typed_table(log: str, rows: DataFrame) -> DataFrame:
    """Typed record table of a parsed log."""
    if log == "conn":
        return rows.select(
            *_ends(0, with_source_port=True), _text("proto", "tcp").alias("proto"), "service",
            number("orig_bytes", "bigint", 0).alias("orig_bytes"), number("resp_bytes", "bigint", 0).alias("resp_bytes"),
            _text("history", "").alias("history"), number("duration", "double", 0.0).alias("duration"),
            "conn_state", "uid",
        )
    if log == "dns":
        return rows.select(
            *_ends(None), _text("query", "").alias("query"), F.col("qtype_name").alias("qtype"),
            F.col("rcode_name").alias("rcode"), text_list("answers").alias("answers"), "uid",
        )
    if log == "http":
        return rows.select(
            *_ends(80), "method", "host", "uri", "user_agent", number("status_code", "int").alias("status_code"),
            number("request_body_len", "bigint", 0).alias("req_body_len"),
            number("response_body_len", "bigint", 0).alias("resp_body_len"), "uid",
        )
    if log == "ssl":
        return rows.select(
            *_ends(443), "server_name", "ja3", "ja3s", "ja4", "subject", "issuer", "validation_status", "version", "uid"
        )
    if log == "ftp":
        return rows.select(
            *_ends(None), _text("command", "").alias("command"), "arg", number("reply_code", "int").alias("reply_code"),
            "uid",
        )
    if log == "smtp":
        return rows.select(
            *_ends(None), F.col("mailfrom").alias("mail_from"), text_list("rcptto").alias("rcpt_to"), "subject",
            text_list("fuids").alias("attachments"), "uid",
        )
    if log == "files":
        return rows.select(
            "case_id", "seq", number("ts", "double", 0.0).alias("ts"), "filename", "mime_type",
            number("total_bytes", "bigint", 0).alias("total_bytes"), "md5", "sha256",
            F.get(text_list("tx_hosts"), F.lit(0)).alias("source_ip"),
            F.get(text_list("rx_hosts"), F.lit(0)).alias("dest_ip"),
            F.lit(False).alias("is_outbound"),
            F.when(F.from_json("conn_uids", "array<string>").isNotNull(), F.get(text_list("conn_uids"), F.lit(0)))
            .otherwise(F.col("conn_uids")).alias("uid"),
            F.lit(None).cast("string").alias("preview"),
        )
    raise ValueError(f"unknown log {log!r}")


def read_log(spark: SparkSession, path: str | list[str], log: str) -> DataFrame:
    """One typed table from the log files at `path` (one folder per case)."""
    return typed_table(log, parse_log(read_lines(spark, path), LOG_FIELDS[log]))


def found_files(spark: SparkSession, *patterns: str) -> list[str]:
    """The patterns that match anything."""
    def matches(pattern: str) -> bool:
        path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
        return found is not None and len(found) > 0

    return [p for p in patterns if matches(p)]


def read_cases(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Record tables of every case folder below `root`; a missing log gives an empty table.

    Only cases that have a conn.log count as log cases; `sources.cases` reads the others from packets.
    """
    return read_logged_cases(spark, root)[0]


def read_logged_cases(spark: SparkSession, root: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The tables of `read_cases`, and the log cases (case_id); the connections are parsed once and stored."""
    tables = {}
    for log, name in TABLE_OF_LOG.items():
        paths = found_files(spark, f"{root}/*/{log}.log", f"{root}/*/log={log}")
        if paths:
            tables[name] = read_log(spark, paths, log)
        else:
            fields = ", ".join(f"`{n}` string" for n in LOG_FIELDS[log])
            tables[name] = typed_table(log, spark.createDataFrame([], f"case_id string, seq bigint, {fields}"))
    tables["sessions"] = stored(tables["sessions"], "sessions")
    logged = stored(tables["sessions"].select("case_id").distinct(), "logged")
    return {
        name: table if name == "sessions" else table.join(logged, "case_id", "left_semi")
        for name, table in tables.items()
    }, logged


def connections_from_conn_log(rows: DataFrame) -> DataFrame:
    """The detector view straight from a parsed conn log, without HTTP or FTP details."""
    none = F.lit(None).cast("string")
    return typed_table("conn", rows).select(
        "case_id", "seq", "ts", "src_ip", "dst_ip", "dst_port", "proto", "orig_bytes", "resp_bytes", "history",
        none.alias("http_method"), none.alias("http_host"), none.alias("http_uri"), none.alias("ftp_upload_cmd"),
    )


def fingerprints_from_ssl_log(rows: DataFrame) -> DataFrame:
    """Fingerprint records keyed by (case, src, dst, port); the last row of a key wins."""
    keys = ["case_id", "src_ip", "dst_ip", "dst_port"]
    typed = rows.select(
        *_ends(0), "ja3", "ja3s", "server_name", "subject"
    ).select(*keys, "seq", "ja3", "ja3s", "server_name", "subject")
    return last_per(typed, keys).drop("seq")
