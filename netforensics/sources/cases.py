"""Folders of cases that hold logs, decoded packets or both, as one set of record tables.

Layout: <root>/<case>/<name>.log or .jsonl, or what Spark writes with partitionBy("case_id", "log"):
<root>/case_id=<case>/log=<name>/part-*. Decoded captures are JSON lines:

packets       seq, ts, src_ip, src_port, dst_ip, dst_port, proto, payload (base64), icmp_type
dns_messages  seq, ts, src_ip, dst_ip, query, qtype, rcode, is_response
hellos        seq, ts, message, src_ip, src_port, dst_ip, dst_port, version, ciphers, extensions, ...
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netforensics.operators.flows import tables_from_packets
from netforensics.operators.tls import fingerprint_hellos
from netforensics.session import stored
from netforensics.sources.lines import read_lines
from netforensics.sources.zeek import found_files, read_logged_cases

DECODED = {
    "packets": "seq bigint, ts double, src_ip string, src_port int, dst_ip string, dst_port int, proto string, payload string, icmp_type int",
    "dns_messages": "seq bigint, ts double, src_ip string, dst_ip string, query string, qtype int, rcode int, is_response boolean",
    "hellos": "seq bigint, ts double, message string, src_ip string, src_port int, dst_ip string, dst_port int, version int, "
    "ciphers array<int>, extensions array<int>, curves array<int>, formats array<int>, sig_algs array<int>, alpns array<string>, "
    "sni string, supported_versions array<int>",
}


def read_decoded(spark: SparkSession, root: str, name: str, logged: DataFrame | None = None) -> DataFrame:
    """A decoded table of all cases; lines that are not JSON objects are skipped, a payload becomes bytes.

    Cases of `logged` (case_id) are left out before their lines are parsed: they are read from their logs.
    """
    paths = found_files(spark, f"{root}/*/{name}.jsonl", f"{root}/*/log={name}")
    schema = f"{DECODED[name]}, _bad string"
    if not paths:
        rows = spark.createDataFrame([], f"case_id string, {DECODED[name]}")
    else:
        parsed = F.from_json("value", schema, {"columnNameOfCorruptRecord": "_bad"})
        lines = read_lines(spark, paths).filter(F.col("value").startswith("{"))
        if logged is not None:
            lines = lines.join(logged, "case_id", "left_anti")
        rows = lines.select("case_id", F.inline(F.array(parsed))).filter(F.col("_bad").isNull()).drop("_bad")
    return rows.withColumn("payload", F.unbase64("payload")) if name == "packets" else rows


def read_case_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Record tables of every case below `root`, and `case_sources` (case_id, source).

    A case with a conn.log is read from its logs, any other from its decoded capture; the choice is a
    join on the case inside one read of all folders, so a root may mix both kinds.
    """
    logs, logged = read_logged_cases(spark, root)
    # Both the tables and the list of cases read them, so each is parsed once and stored; only what is used is.
    packets, messages, hellos = (stored(read_decoded(spark, root, name, logged), name) for name in DECODED)
    captured = tables_from_packets(packets, messages, fingerprint_hellos(hellos), logged)
    tables = {
        name: captured[name] if name not in logs else logs[name] if name not in captured
        else logs[name].unionByName(captured[name], allowMissingColumns=True)
        for name in {**logs, **captured}
    }
    cases = packets.select("case_id").unionByName(messages.select("case_id")).unionByName(hellos.select("case_id")).distinct()
    tables["case_sources"] = logged.withColumn("source", F.lit("logs")).unionByName(
        cases.join(logged, "case_id", "left_anti").withColumn("source", F.lit("capture"))
    )
    return tables
