"""Small JSON documents: host access events, static priors, manifests, sample metadata, lists.

Readers take rows (case_id, raw JSON text) so that many cases parse in one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netforensics.functions.ip import cidr_bounds
from netforensics.functions.lookup import mapped, seed_frame
from netforensics.functions.numbers import ISO_PATTERN, ZONE_PATTERN, parse_iso
from netforensics.functions.rules import clock_acceptable
from netforensics.sources.lines import case_from_path
from netforensics.vocab import ALLOWLIST_DOMAINS, DATA_TYPES, STATIC_TYPES

ACCESS_FIELDS = [
    "timestamp", "data_type", "api_call", "process", "object_path", "object_name", "access_operation",
    "process_id", "process_path",
]


def _filled(value: Column) -> Column:
    text = F.trim(value)
    return F.when(text != "", text)


def _parsed(documents: DataFrame, name: str, schema: str) -> DataFrame:
    """(case_id, raw, parsed document). A generator parses once, not once per field read."""
    return documents.select("case_id", "raw", F.explode(F.array(F.from_json("raw", schema))).alias(name))


# --- host access events -----------------------------------------------------------

def read_access_events(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw access events of JSON array files, every field as text."""
    schema = ", ".join(f"{f} string" for f in ACCESS_FIELDS)
    rows = spark.read.option("multiLine", True).schema(schema).json(path)
    order = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return rows.select(
        case_from_path(F.col("_metadata.file_path")).alias("case_id"), order.alias("seq"), *ACCESS_FIELDS
    )


def validate_access_events(raw: DataFrame) -> DataFrame:
    """Add `error` (NULL for a valid event) and the enrichment columns."""
    def missing(name: str) -> Column:
        return F.when(F.coalesce(F.col(name), F.lit("")) == "", F.lit(f"missing required field '{name}'"))

    stamp = F.col("timestamp")
    seconds = parse_iso(stamp)
    bad_time = F.when(
        ~stamp.rlike(ISO_PATTERN) | parse_iso(stamp, require_zone=False).isNull(),
        F.concat(F.lit("unparseable ISO-8601 timestamp '"), stamp, F.lit("'")),
    ).when(
        ~stamp.rlike(ZONE_PATTERN), F.concat(F.lit("timestamp '"), stamp, F.lit("' has no timezone"))
    )
    bad_type = F.when(
        ~F.col("data_type").isin(list(DATA_TYPES)), F.concat(F.lit("invalid data_type '"), F.col("data_type"), F.lit("'"))
    )
    reason = F.coalesce(missing("timestamp"), missing("data_type"), missing("api_call"), bad_time, bad_type)
    number = F.col("process_id")
    return raw.withColumn("error", reason).select(
        "case_id", "seq",
        F.when(F.col("error").isNull(), seconds).alias("ts"),
        stamp.alias("raw_timestamp"), "data_type", "api_call",
        F.when(F.col("process") != "", F.col("process")).alias("process"),
        mapped(F.col("data_type"), {k: v[0] for k, v in DATA_TYPES.items()}).alias("mitre_technique"),
        mapped(F.col("data_type"), {k: v[1] for k, v in DATA_TYPES.items()}).alias("capability"),
        _filled(F.col("object_path")).alias("object_path"), _filled(F.col("object_name")).alias("object_name"),
        _filled(F.col("access_operation")).alias("access_operation"),
        F.when(number.rlike("^-?[0-9]+$"), number.try_cast("int")).alias("process_id"),
        _filled(F.col("process_path")).alias("process_path"),
        "error",
    )


def ingest_access_events(raw: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(valid events, rejected events with their error). Strict mode raises on any rejection."""
    checked = validate_access_events(raw)
    rejected = checked.filter(F.col("error").isNotNull()).select("case_id", "seq", "error")
    if strict:
        first = rejected.orderBy("case_id", "seq").first()
        if first is not None:
            raise ValueError(f"event[{first['seq']}] {first['error']}")
    return checked.filter(F.col("error").isNull()).drop("error"), rejected


def access_report(checked: DataFrame) -> DataFrame:
    """Valid and rejected events per case."""
    bad = F.col("error").isNotNull().cast("bigint")
    return checked.groupBy("case_id").agg(F.sum(1 - bad).alias("valid"), F.sum(bad).alias("rejected"))


# --- static prior ---------------------------------------------------------------------

_IOC = "array<struct<type:string,value:string,source:string,evidence_origin:string>>"
PRIOR_SCHEMA = (
    "sample_sha256 string, family string, family_attribution struct<family:string>, capabilities array<string>, "
    f"capa_capabilities array<string>, c2_indicators {_IOC}, iocs {_IOC}"
)


def parse_static_priors(documents: DataFrame) -> DataFrame:
    """One row per static indicator with `error` set on invalid ones."""
    prior = _parsed(documents, "p", PRIOR_SCHEMA)
    family = F.coalesce("p.family", "p.family_attribution.family")
    listed = prior.select(
        "case_id", F.col("p.sample_sha256").alias("sample_sha256"), family.alias("family"),
        F.posexplode(F.coalesce("p.c2_indicators", "p.iocs")).alias("pos", "ioc"),
    )
    kind, value = F.col("ioc.type"), F.col("ioc.value")
    label = F.concat(F.lit("c2_indicators["), F.col("pos").cast("string"), F.lit("]"))
    error = (
        F.when(F.col("ioc").isNull() | kind.isNull() | value.isNull(), F.concat(label, F.lit(" must have 'type' and 'value'")))
        .when(~kind.isin(STATIC_TYPES), F.concat(label, F.lit(" invalid type '"), kind, F.lit("'")))
        .when(F.trim(value) == "", F.concat(label, F.lit(" empty value")))
    )
    return listed.select(
        "case_id", F.col("pos").cast("bigint").alias("seq"), "sample_sha256", "family", kind.alias("type"),
        F.trim(value).alias("value"), _filled(F.col("ioc.source")).alias("source"),
        _filled(F.col("ioc.evidence_origin")).alias("evidence_origin"), error.alias("error"),
    )


def static_families(documents: DataFrame) -> DataFrame:
    """(case_id, family, capabilities) stated by the static analysis."""
    prior = _parsed(documents, "p", PRIOR_SCHEMA)
    own = F.when(F.size("p.capabilities") > 0, F.col("p.capabilities"))
    return prior.select(
        "case_id", F.coalesce("p.family", "p.family_attribution.family").alias("family"),
        F.coalesce(own, "p.capa_capabilities", F.array().cast("array<string>")).alias("capabilities"),
    )


# --- handoff manifest ---------------------------------------------------------------------

MANIFEST_SCHEMA = (
    "schema_version string, session_id string, cape_task_id int, network_mode string, "
    "detonation_start_utc string, detonation_end_utc string, "
    "correlation struct<clock_quality_acceptable:boolean,maximum_uncertainty_ns:double,access_events_path:string,"
    "access_events_status_path:string,event_count:int,host_network_correlation_enabled:boolean,reason_code:string,"
    "reason:string,source:string,clock_algorithm:string,etw_corroboration_state:string>, "
    "telemetry struct<telemetry_degraded:boolean,providers_unavailable:array<struct<provider:string>>>, "
    "guest_vm_identity struct<guest_ip:string>, integrity struct<hash_manifest_sha256:string>, "
    "artifact_paths struct<access_events:string,clock_sync:string,access_events_status:string,pcap:string>, "
    "capabilities struct<dynamic:struct<tls_interception:struct<status:string>>>"
)
CLOCK_SCHEMA = (
    "algorithm string, measurements map<string,struct<uncertainty_ns:double>>, "
    "quality struct<acceptable:boolean,maximum_observed_uncertainty_ns:double>"
)
STATUS_SCHEMA = (
    "source string, correlation_eligible boolean, rejected_event_count int, etw_corroboration_state string, "
    "reason_code string"
)


def parse_clock_quality(documents: DataFrame) -> DataFrame:
    """(case_id, clock_uncertainty_ms, algorithm, acceptable). The clock offset is never read."""
    doc = _parsed(documents, "c", CLOCK_SCHEMA)
    worst = F.array_max(F.transform(F.map_values("c.measurements"), lambda m: m["uncertainty_ns"]))
    uncertainty = F.coalesce("c.quality.maximum_observed_uncertainty_ns", worst, F.lit(0.0))
    return doc.select(
        "case_id", (F.abs(uncertainty) / 1e6).alias("clock_uncertainty_ms"), F.col("c.algorithm").alias("algorithm"),
        F.col("c.quality.acceptable").alias("acceptable"),
    )


def parse_manifests(
    documents: DataFrame, clock: DataFrame | None = None, status: DataFrame | None = None
) -> DataFrame:
    """One normalised manifest row per case, sidecars joined, unsafe gaps read the safe way."""
    spark = documents.sparkSession
    empty = spark.sql("SELECT CAST(NULL AS STRING) AS case_id, CAST(NULL AS STRING) AS raw WHERE false")
    m = _parsed(documents, "m", MANIFEST_SCHEMA)
    quality = parse_clock_quality(clock if clock is not None else empty)
    side = _parsed(status if status is not None else empty, "s", STATUS_SCHEMA)
    providers = F.transform(
        F.filter(
            F.coalesce("m.telemetry.providers_unavailable", F.array().cast("array<struct<provider:string>>")),
            lambda p: F.coalesce(p["provider"], F.lit("")) != "",
        ),
        lambda p: p["provider"],
    )
    joined = m.join(quality, "case_id", "left").join(side, "case_id", "left")
    return joined.select(
        "case_id", "m.schema_version", "m.session_id", "m.cape_task_id", "m.network_mode",
        clock_acceptable(
            F.col("m.correlation.clock_quality_acceptable"), F.col("m.correlation.maximum_uncertainty_ns")
        ).alias("clock_quality_acceptable"),
        F.coalesce("m.telemetry.telemetry_degraded", F.lit(False)).alias("telemetry_degraded"),
        providers.alias("providers_unavailable"),
        F.col("m.guest_vm_identity.guest_ip").alias("guest_ip"),
        "m.detonation_start_utc", "m.detonation_end_utc",
        F.col("m.integrity.hash_manifest_sha256").alias("hash_manifest_sha256"),
        F.coalesce(
            "m.correlation.access_events_path", "m.artifact_paths.access_events", F.lit("behavior/access_events.json")
        ).alias("access_events_path"),
        F.col("m.correlation.event_count").alias("access_event_count"),
        F.coalesce("m.correlation.host_network_correlation_enabled", F.lit(True)).alias("host_network_correlation_enabled"),
        F.coalesce("m.correlation.reason_code", "m.correlation.reason", "s.reason_code").alias("correlation_reason"),
        F.coalesce("clock_uncertainty_ms", F.lit(0.0)).alias("clock_uncertainty_ms"),
        F.coalesce("m.correlation.clock_algorithm", "algorithm").alias("clock_algorithm"),
        F.col("acceptable").alias("clock_quality_reported"),
        F.coalesce("s.source", "m.correlation.source").alias("access_events_source"),
        F.coalesce("s.correlation_eligible", F.lit(True)).alias("access_events_correlation_eligible"),
        F.coalesce("s.rejected_event_count", F.lit(0)).alias("access_events_rejected_count"),
        F.coalesce("s.etw_corroboration_state", "m.correlation.etw_corroboration_state").alias("etw_corroboration_state"),
        F.col("m.capabilities.dynamic.tls_interception.status").alias("tls_interception_status"),
    )


# --- sample metadata --------------------------------------------------------------------------

def parse_sample_meta(documents: DataFrame) -> DataFrame:
    """Sample identity and static verdicts; wrongly typed fields are listed in `errors`."""
    names = [
        "schema_version", "sample_sha256", "sample_md5", "sample_sha1", "file_type", "static_risk_score",
        "static_hypotheses", "yara", "clamav", "vt_lookup",
    ]
    doc = _parsed(documents, "d", ", ".join(f"{n} string" for n in names))
    field = {n: F.col(f"d.{n}") for n in names}
    none = F.array().cast("array<string>")
    object_ok = F.ltrim("raw").startswith("{")

    def wrong(name: str, mark: str, text: str) -> Column:
        return F.when(field[name].isNotNull() & ~field[name].startswith(mark), F.lit(text))

    errors = F.array_compact(
        F.array(
            F.when(~object_ok, F.lit("sample.meta.json must be a JSON object")),
            F.when(field["schema_version"] != "1.0",
                   F.concat(F.lit("sample_meta schema_version '"), field["schema_version"], F.lit("' != supported '1.0'"))),
            F.when(field["static_risk_score"].isNotNull() & field["static_risk_score"].try_cast("double").isNull(),
                   F.lit("static_risk_score is not numeric")),
            wrong("static_hypotheses", "[", "static_hypotheses must be an array"),
            wrong("yara", "{", "yara must be an object with fast_hits/deep_hits"),
            wrong("clamav", "{", "clamav must be an object with status/signature"),
        )
    )
    yara = F.from_json(field["yara"], "fast_hits array<string>, deep_hits array<string>")
    clam = F.from_json(field["clamav"], "status string, signature string")
    return doc.select(
        "case_id", field["sample_sha256"].alias("sample_sha256"), field["sample_md5"].alias("sample_md5"),
        field["sample_sha1"].alias("sample_sha1"), field["file_type"].alias("file_type"),
        field["static_risk_score"].try_cast("double").alias("static_risk_score"),
        F.coalesce(F.from_json(field["static_hypotheses"], "array<string>"), none).alias("static_hypotheses"),
        F.coalesce(yara["fast_hits"], none).alias("yara_fast_hits"),
        F.coalesce(yara["deep_hits"], none).alias("yara_deep_hits"),
        clam["status"].alias("clamav_status"), clam["signature"].alias("clamav_signature"),
        field["vt_lookup"].alias("vt_lookup"), errors.alias("errors"),
    )


# --- allowlist and ground truth ------------------------------------------------------------------

def parse_allowlist(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(domains, cidrs): the built-in names plus site entries; malformed networks are skipped."""
    spark = documents.sparkSession
    site = documents.select(F.from_json("raw", "domains array<string>, cidrs array<string>").alias("a"))
    built_in = seed_frame(spark, [(d,) for d in ALLOWLIST_DOMAINS], "domain string")
    names = site.select(F.explode("a.domains").alias("domain")).select(F.lower(F.trim("domain")).alias("domain"))
    cidrs = site.select(F.explode("a.cidrs").alias("cidr")).filter(cidr_bounds(F.col("cidr"))[0].isNotNull())
    return built_in.unionByName(names).distinct(), cidrs.distinct()


def parse_ground_truth(documents: DataFrame) -> DataFrame:
    """(case_id, indicator, is_malware): one row per malicious indicator, and one row with a
    NULL indicator for a capture without any."""
    schema = "map<string,struct<malicious_ips:array<string>,malicious_domains:array<string>,benign:boolean>>"
    none = F.array().cast("array<string>")
    captures = documents.select(F.explode(F.from_json("raw", schema)).alias("case_id", "t"))
    listed = F.array_distinct(
        F.concat(F.coalesce("t.malicious_ips", none), F.coalesce("t.malicious_domains", none))
    )
    rows = captures.select(
        "case_id", listed.alias("indicators"), F.coalesce("t.benign", F.lit(False)).alias("benign")
    ).withColumn("is_malware", (F.size("indicators") > 0) & ~F.col("benign"))
    truth = F.when(F.col("is_malware"), F.col("indicators")).otherwise(none)
    return rows.select("case_id", "is_malware", F.explode_outer(truth).alias("indicator"))


