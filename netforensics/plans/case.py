"""The whole analysis of many cases, from record tables to findings, events and exports."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netforensics.functions.ip import is_private
from netforensics.functions.rules import network_mode
from netforensics.functions.text import host_header_domain
from netforensics.operators.connections import (
    infrastructure, scope_case, scope_rules, simulated_scope, to_connections,
)
from netforensics.operators.correlate import apply_veto, assess_clock_sync, correlate_best, verify_clock_alignment
from netforensics.operators.custody import seal_segments
from netforensics.operators.dga import detect_dga_ml
from netforensics.operators.dns import detect_dga, detect_dns_tunneling, detect_doh, detect_resolved_destinations, name_index
from netforensics.operators.emit import emit_events, event_rows, event_table, ioc_rows
from netforensics.operators.keyed import first_per
from netforensics.operators.services import (
    detect_cloud_exfil, detect_http_exfil, detect_icmp_tunnel, detect_port_mismatch, detect_smtp_exfil,
)
from netforensics.operators.story import attribute_family, build_provenance, build_timeline, family_evidence, family_verdicts
from netforensics.operators.tiers import (
    apply_allowlist, apply_corroboration, apply_domain_reputation, apply_geo, apply_reputation, apply_static_prior,
    TLS_RANK, case_notes, gate_correlated, gate_findings, promote_static, settle_candidates,
)
from netforensics.operators.tls import service_fingerprint, tls_findings
from netforensics.operators.traffic import (
    detect_beaconing, detect_exfil, detect_ftp_exfil, detect_unclassified_egress, merge_exfil,
)
from netforensics.session import stored
from netforensics.vocab import ALLOWLIST_DOMAINS

RAW_UPLOAD_BYTES = 200 * 1024


@dataclass
class Context:
    """Side inputs of an analysis; everything but `intel` is optional."""

    intel: DataFrame
    geo: DataFrame | None = None
    manifests: DataFrame | None = None
    static_iocs: DataFrame | None = None
    static_families: DataFrame | None = None
    sample_meta: DataFrame | None = None
    access: DataFrame | None = None
    artifacts: DataFrame | None = None
    samples: DataFrame | None = None
    allow_domains: DataFrame | None = None
    allow_cidrs: DataFrame | None = None
    dga_weights: DataFrame | None = None
    dga_bias: float = 0.0
    provider_map: dict[str, list[str]] | None = None
    # Cuts lineage between stages; pass session.reliable_checkpoint for long cluster runs.
    stage: Callable[[DataFrame], DataFrame] = field(default=lambda df: df)


def _by_case(ctx: Context) -> Context:
    """`ctx` with its tables of one row per case stored.

    Their size is known then, so joins with them are broadcast from the start; a join planned without
    it would deal whole record tables by case, to as many tasks as there are cases.
    """
    small = {name: getattr(ctx, name) for name in ("manifests", "samples", "sample_meta")}
    return replace(ctx, **{name: stored(rows, name) for name, rows in small.items() if rows is not None})


def _text(value: str | None = None) -> Column:
    return F.lit(value).cast("string")


def _finding(
    rows: DataFrame, kind: Column | str, rank: int, seq: Column | None = None, name: Column | None = None, **columns: Column
) -> DataFrame:
    """Shape detector rows into findings; columns that are not given become NULL in the union."""
    kind_col = F.lit(kind) if isinstance(kind, str) else kind
    number = F.struct(
        F.lit(rank).alias("kind_rank"),
        (seq if seq is not None else F.lit(None).cast("bigint")).alias("seq"),
        (name if name is not None else _text("")).alias("name"),
    )
    return rows.select(
        "case_id", kind_col.alias("kind"), F.lit(rank).alias("kind_rank"), number.alias("finding_no"),
        *[c.alias(n) for n, c in columns.items()],
    )


_DEFAULTS = {
    "dst_ip": "string", "dst_port": "int", "event_time": "double", "confidence": "double",
    "destination_domain": "string", "ja3_hash": "string", "ja4": "string", "plaintext_available": "boolean",
    "preset_tier": "string", "http_uri": "string", "http_reason": "string", "dns_evidence": "string",
    "cert_reason": "string", "cloud_service": "string", "cloud_direction": "string", "smtp_subject": "string",
    "smtp_rcpt": "array<string>", "covert_detail": "string", "egress_detail": "string", "beacon_note": "string",
    "mean_interval_s": "double", "jitter_ratio": "double", "handshake_ratio": "double",
}


def _union(parts: list[DataFrame]) -> DataFrame:
    head = ["case_id", "kind", "kind_rank", "finding_no"]
    shaped = [
        p.select(
            *head,
            *[
                (F.col(c).cast(t) if c in p.columns else F.lit(None).cast(t)).alias(c)
                for c, t in _DEFAULTS.items()
            ],
        )
        for p in parts
    ]
    out = shaped[0]
    for p in shaped[1:]:
        out = out.unionByName(p)
    return out


def case_times(conns: DataFrame, asked: DataFrame) -> DataFrame:
    """(case_id, case_time): the earliest DNS time, else the time of the first connection. `asked`: the name index."""
    first = conns.groupBy("case_id").agg(F.min(F.struct("seq", "ts")).alias("c"))
    asked = asked.groupBy("case_id").agg(F.min("first_ts").alias("d"))
    return first.join(asked, "case_id", "full_outer").select(
        "case_id", F.coalesce("d", "c.ts").alias("case_time"), F.col("c.ts").alias("first_conn_time")
    )


def candidates(
    case: dict[str, DataFrame], conns: DataFrame, asked: DataFrame, ctx: Context, times: DataFrame, allow: DataFrame | None = None
) -> DataFrame:
    """All detector outputs as findings without tiers (preset_tier where a detector sets one).

    Every detector runs on its whole input, none waits for another: `settle_candidates` drops afterwards
    what an earlier rule explains. `asked` is the name index of the case's DNS, `times` its stored `case_times`.
    """
    service = ["case_id", "dst_ip", "dst_port"]
    first_seen = conns.groupBy(*service).agg(F.min(F.struct("seq", "ts")).alias("_f")).select(
        *service, F.col("_f.ts").alias("_first_ts")
    )
    hosts = first_per(
        conns.select("case_id", "dst_ip", "seq", host_header_domain(F.col("http_host")).alias("_http_domain")).filter(
            F.col("_http_domain").isNotNull()
        ),
        ["case_id", "dst_ip"],
    ).drop("seq")
    prints = service_fingerprint(case["tls"]).withColumnRenamed("server_name", "_sni")

    def placed(rows: DataFrame) -> DataFrame:
        return rows.join(first_seen, service, "left").join(times, "case_id", "left")

    def described(rows: DataFrame) -> DataFrame:
        return placed(rows.join(prints, service, "left").join(hosts, ["case_id", "dst_ip"], "left"))

    own_time = F.coalesce("_first_ts", "first_conn_time", F.lit(0.0))
    case_time = F.coalesce("case_time", F.lit(0.0))
    where = F.coalesce("_http_domain", "_sni")
    endpoint = F.concat_ws(":", "dst_ip", "dst_port")

    exfil = merge_exfil(
        detect_exfil(conns, min_raw_upload_bytes=RAW_UPLOAD_BYTES, allow=allow), detect_ftp_exfil(conns, allow)
    )
    f_exfil = _finding(
        described(exfil), "exfil", 0, F.col("seq"), dst_ip=F.col("dst_ip"), dst_port=F.col("dst_port"),
        event_time=own_time, confidence=F.col("confidence"), http_uri=F.col("http_uri"), destination_domain=where,
        ja3_hash=F.col("ja3"), plaintext_available=F.col("http_method").isNotNull(),
    )
    beacons = detect_beaconing(conns, allow=allow).filter("is_beacon")
    unanswered = F.col("unanswered")
    f_beacon = _finding(
        described(beacons), "beacon", 1, name=endpoint, dst_ip=F.col("dst_ip"), dst_port=F.col("dst_port"),
        event_time=own_time, confidence=F.col("confidence"), mean_interval_s=F.col("mean_interval_s"),
        jitter_ratio=F.col("jitter_ratio"), handshake_ratio=F.col("handshake_ratio"), destination_domain=where,
        ja3_hash=F.col("ja3"), plaintext_available=F.lit(False),
        preset_tier=F.when(unanswered, "weak"),
        beacon_note=F.when(
            unanswered,
            F.concat(
                F.lit("no completed handshake ("), F.rint(F.col("handshake_ratio") * 100).cast("int").cast("string"),
                F.lit("% of callbacks answered): regular retries to an unresponsive host mimic beaconing"),
            ),
        ),
    )
    tls = placed(tls_findings(case["tls"], None, ctx.intel))
    f_tls = _finding(
        tls, F.col("kind"), TLS_RANK, F.col("seq"), dst_ip=F.col("dst_ip"), dst_port=F.col("dst_port"), event_time=own_time,
        confidence=F.col("confidence"), destination_domain=F.col("server_name"), ja3_hash=F.col("ja3"),
        ja4=F.col("ja4"), plaintext_available=F.lit(False), preset_tier=F.col("severity"), cert_reason=F.col("reason"),
    )

    tunnels, bursts = detect_dns_tunneling(asked), detect_dga(asked)
    dns_found = [(tunnels, "dns_tunnel", 3, "strong"), (bursts, "dga", 4, "strong")]
    claimed = tunnels.select("case_id", "domain").unionByName(bursts.select("case_id", "domain"))
    if ctx.dga_weights is not None:
        learned = detect_dga_ml(asked, ctx.dga_weights, ctx.dga_bias, already=bursts)
        dns_found.append((learned, "dga", 5, "weak"))
        claimed = claimed.unionByName(learned.select("case_id", "domain"))
    f_dns = [
        _finding(
            rows.join(times, "case_id", "left"), kind, rank, name=F.col("domain"),
            dst_ip=F.coalesce(F.get("resolver_ips", F.lit(0)), F.lit("")), dst_port=F.lit(53), event_time=case_time,
            confidence=F.col("confidence"), destination_domain=F.col("domain"), plaintext_available=F.lit(True),
            preset_tier=F.lit(tier), dns_evidence=F.col("evidence"),
        )
        for rows, kind, rank, tier in dns_found
    ]
    names = detect_resolved_destinations(
        asked, claimed, ctx.allow_domains if ctx.allow_domains is not None else ALLOWLIST_DOMAINS
    )
    f_names = _finding(
        names.join(times, "case_id", "left"), "resolved_domain", 6, name=F.col("domain"), event_time=case_time,
        confidence=F.col("confidence"), destination_domain=F.col("domain"), plaintext_available=F.lit(False),
        preset_tier=F.when(F.col("confidence") == 0.0, "allowlisted").otherwise("weak"), dns_evidence=F.col("evidence"),
    )
    cloud = detect_cloud_exfil(case["tls"], case["http"], case["sessions"]).join(times, "case_id", "left")
    f_cloud = _finding(
        cloud, F.col("category"), 7, F.col("seq"), F.concat_ws("|", F.col("source").cast("string"), "dst_ip", "domain"),
        dst_ip=F.col("dst_ip"), dst_port=F.col("dst_port"), event_time=case_time, confidence=F.col("confidence"),
        destination_domain=F.col("domain"), plaintext_available=F.lit(False),
        preset_tier=F.when(F.col("risk") == "high", "strong").otherwise("weak"), cloud_service=F.col("service"),
        cloud_direction=F.col("direction"),
    )
    mail = detect_smtp_exfil(case["smtp"]).join(times, "case_id", "left")
    f_mail = _finding(
        mail, "smtp_exfil", 8, F.col("seq"), dst_ip=F.col("dst_ip"), dst_port=F.lit(25), event_time=case_time,
        confidence=F.col("confidence"), destination_domain=F.get("rcpt_to", F.lit(0)), plaintext_available=F.lit(True),
        preset_tier=F.when(F.col("has_attachment") | F.col("self_send"), "strong").otherwise("weak"),
        smtp_rcpt=F.col("rcpt_to"), smtp_subject=F.col("subject"),
    )
    public = ~is_private(F.col("dst_ip"))
    web = detect_http_exfil(case["http"]).filter(public).join(times, "case_id", "left")
    f_web = _finding(
        web, "http_c2", 9, F.col("seq"), dst_ip=F.col("dst_ip"), dst_port=F.col("dst_port"), event_time=case_time,
        confidence=F.col("confidence"), destination_domain=F.col("host"), plaintext_available=F.lit(True),
        preset_tier=F.col("severity"), http_reason=F.col("reason"), http_uri=F.col("uri"),
    )
    covert = [(detect_port_mismatch(case["http"], case["tls"]), "port_mismatch", 11)]
    if "icmp" in case:
        covert.insert(0, (detect_icmp_tunnel(case["icmp"]), "icmp_tunnel", 10))
    f_covert = [
        _finding(
            rows.filter(public).join(times, "case_id", "left"), kind, rank, F.col("seq"), endpoint,
            dst_ip=F.col("dst_ip"), dst_port=F.col("dst_port"), event_time=case_time, confidence=F.col("confidence"),
            plaintext_available=F.lit(False), preset_tier=F.col("severity"), covert_detail=F.col("detail"),
        )
        for rows, kind, rank in covert
    ]
    sni = (
        case["tls"].filter(F.coalesce("server_name", F.lit("")) != "")
        .groupBy("case_id", "dst_ip").agg(F.max(F.struct("seq", "server_name")).alias("_s"))
        .select("case_id", "dst_ip", F.col("_s.server_name").alias("_sni"))
    )
    egress = (
        detect_unclassified_egress(conns, None, allow=allow)
        .join(sni, ["case_id", "dst_ip"], "left").join(times, "case_id", "left")
    )
    f_egress = _finding(
        egress, "unclassified_egress", 12, F.col("seq"), dst_ip=F.col("dst_ip"), dst_port=F.col("dst_port"),
        event_time=case_time, confidence=F.lit(0.4), destination_domain=F.col("_sni"),
        plaintext_available=F.lit(False), preset_tier=F.lit("weak"),
        egress_detail=F.concat(
            F.col("orig_bytes").cast("string"), F.lit("B out, upload-ratio "), F.col("upload_ratio").cast("string"),
            F.lit(" (unexplained by specific detectors)"),
        ),
    )
    return _union([f_exfil, f_beacon, f_tls, *f_dns, f_names, f_cloud, f_mail, f_web, *f_covert, f_egress])


def network_findings(case: dict[str, DataFrame], ctx: Context) -> DataFrame:
    """Scope, detect, enrich, tier and gate: the findings of every case.

    Three tables are staged: the connections, the name index and the candidates of all detectors; those
    of one row per case are stored. Everything else is part of the plan of one of them or of the result.
    """
    return _findings(case, _by_case(ctx))


def _findings(case: dict[str, DataFrame], ctx: Context) -> DataFrame:
    allow, guest, everyone = None, None, case["dns"]
    if ctx.manifests is not None:
        scope = stored(scope_rules(ctx.manifests, case["sessions"]), "scope")
        guest = scope.select("case_id", "guest_ip")
        case = scope_case(case, scope)
    conns = ctx.stage(to_connections(case["sessions"], case["http"], case["ftp"]))
    asked = ctx.stage(name_index(case["dns"]))
    times = stored(case_times(conns, asked), "case-times")
    infra = infrastructure(everyone, guest)
    if ctx.manifests is not None:
        simulated = ctx.manifests.filter(network_mode(F.col("network_mode")) == "simulated").select("case_id")
        allow = simulated_scope(conns.join(simulated, "case_id", "left_semi"), guest, infra)
    found = settle_candidates(ctx.stage(candidates(case, conns, asked, ctx, times, allow)))
    found = apply_reputation(found, ctx.intel)
    found = apply_domain_reputation(found, ctx.intel)
    found = apply_corroboration(found)
    if ctx.static_iocs is not None:
        found = apply_static_prior(
            found, ctx.static_iocs, conns.select("case_id", "dst_ip"),
            asked.select("case_id", F.lower("query").alias("domain")), infra,
            times.select("case_id", F.col("case_time").alias("event_time")),
        )
    found = apply_geo(found, ctx.geo)
    found = apply_allowlist(found, ctx.allow_domains, ctx.allow_cidrs)
    if ctx.manifests is not None:
        found = gate_findings(found, ctx.manifests)
    return found


def analyse(case: dict[str, DataFrame], ctx: Context) -> dict[str, DataFrame]:
    """Everything a case report needs, as lazy DataFrames by name."""
    ctx = _by_case(ctx)
    findings = ctx.stage(_findings(case, ctx))
    out = {"findings": findings, "doh": detect_doh(case["tls"], case["http"])}
    families = ctx.stage(attribute_family(findings, ctx.intel, ctx.static_families))
    out |= {"families": families, "family_verdicts": family_verdicts(families), "family_evidence": family_evidence(families)}
    if ctx.access is None:
        if ctx.manifests is not None:
            out["notes"] = case_notes(ctx.manifests, findings)
        return out
    out["clock_sync"] = assess_clock_sync(ctx.access, findings)
    out["clock_alignment"] = verify_clock_alignment(ctx.access, findings, manifests=ctx.manifests)
    correlated = correlate_best(ctx.access, findings)
    if ctx.manifests is not None:
        correlated = gate_correlated(apply_veto(correlated, ctx.manifests), ctx.manifests, ctx.provider_map)
    if ctx.sample_meta is not None:
        correlated = promote_static(correlated, ctx.sample_meta)
    correlated = ctx.stage(correlated)
    out["correlated"] = correlated
    if ctx.manifests is not None:
        out["notes"] = case_notes(ctx.manifests, findings, correlated, out["clock_alignment"], ctx.provider_map)
    out["provenance"] = build_provenance(correlated, findings, ctx.artifacts, ctx.allow_domains, ctx.allow_cidrs)
    out["timeline"] = build_timeline(ctx.access, findings)
    if ctx.samples is not None:
        rows = event_rows(findings, correlated, ctx.samples, ctx.manifests, ctx.allow_domains, ctx.allow_cidrs)
        chained = ctx.stage(emit_events(ctx.stage(rows)))
        out["chained_events"] = chained
        out["seals"] = seal_segments(chained)
        out["events"] = event_table(chained)
        out["iocs"] = ioc_rows(chained)
    return out
