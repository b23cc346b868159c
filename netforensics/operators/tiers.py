"""Tiering, enrichment and gating rules over findings and correlated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netforensics.functions.rules import (
    capped_tier, corroborating_signals, degraded_everywhere, degraded_types, network_mode, pinning_suspected,
    tls_intercepted,
)
from netforensics.functions.text import url_host
from netforensics.operators.joins import allowlist_lookup, geo_enrich, lookup_domains, lookup_indicators
from netforensics.vocab import CONFIG_SOURCES, TIMING_KINDS


# The rank of fingerprint and certificate findings among the detectors of a case.
TLS_RANK = 2


def _set(df: DataFrame, **columns: Column) -> DataFrame:
    return df.withColumns(columns)


def apply_reputation(findings: DataFrame, intel: DataFrame) -> DataFrame:
    """Address and fingerprint reputation; a hit lifts a preset tier to confirmed."""
    bare = findings.drop("reputation_hit", "reputation_source", "reputation_note", "match_on")
    joined = lookup_indicators(bare.withColumnRenamed("ja3_hash", "ja3"), intel).withColumnRenamed("ja3", "ja3_hash")
    hit = F.col("reputation_hit")
    return _set(
        joined,
        preset_tier=F.when(hit & F.col("preset_tier").isNotNull(), F.lit("confirmed")).otherwise(F.col("preset_tier")),
        beacon_note=F.when(~hit, F.col("beacon_note")),
    )


def apply_domain_reputation(findings: DataFrame, intel: DataFrame) -> DataFrame:
    """A finding without a hit whose domain is on a feed becomes confirmed."""
    joined = lookup_domains(findings, intel)
    upgrade = F.col("domain_hit") & ~F.col("reputation_hit") & (F.coalesce("destination_domain", F.lit("")) != "")
    note = F.when(F.coalesce("domain_note", F.lit("")) != "", F.col("domain_note")).otherwise(F.col("domain_source"))
    return _set(
        joined.withColumn("_up", upgrade),
        reputation_hit=F.col("reputation_hit") | F.col("_up"),
        preset_tier=F.when(F.col("_up"), F.lit("confirmed")).otherwise(F.col("preset_tier")),
        reputation_note=F.when(F.col("_up"), F.concat(F.lit("domain intel: "), note)).otherwise(F.col("reputation_note")),
        reputation_source=F.when(F.col("_up"), F.col("domain_source")).otherwise(F.col("reputation_source")),
    ).drop("_up", "domain_hit", "domain_source", "domain_note")


def network_tier(reputation: Column, signals: Column) -> Column:
    return F.when(reputation, "confirmed").when(signals >= 2, "strong").otherwise("weak")


def settle_candidates(candidates: DataFrame) -> DataFrame:
    """Findings of all detectors run side by side: drop what an earlier rule explains, count the signals.

    A fingerprint or certificate finding falls to a flow finding on the same destination, unexplained
    egress to any other finding there. One small row per (case, destination) decides; it also holds
    the number of distinct kinds left, `signal_kinds`, for `apply_corroboration`.
    """
    flow, egress = F.col("kind").isin("exfil", "beacon"), F.col("kind") == "unclassified_egress"
    tls = F.col("kind_rank") == TLS_RANK
    place = ["case_id", "dst_ip"]

    def count(test: Column) -> Column:
        return F.count(F.when(test, 1))

    kinds = candidates.filter(F.col("dst_ip").isNotNull()).select(*place, "kind", "kind_rank").distinct().groupBy(*place).agg(
        (count(flow) > 0).alias("_flow"), count(tls).alias("_tls"), count(egress).alias("_egress"), count(~tls & ~egress).alias("_other")
    )
    explained = F.col("_other") + F.when(F.col("_flow"), 0).otherwise(F.col("_tls"))
    joined = candidates.join(kinds, place, "left")
    dropped = (tls & F.col("_flow")) | (egress & (F.col("_tls") + F.col("_other") > 0))
    signals = F.when(explained > 0, explained).otherwise(F.col("_egress"))
    return joined.withColumn("signal_kinds", F.coalesce(signals, F.lit(0))).filter(~F.coalesce(dropped, F.lit(False))).drop(
        "_flow", "_tls", "_egress", "_other"
    )


def apply_corroboration(findings: DataFrame) -> DataFrame:
    """Final tier: the preset one, else by reputation and the number of distinct signal kinds.

    The kinds per destination are counted here unless `signal_kinds` brings them.
    """
    if "signal_kinds" in findings.columns:
        return findings.withColumn(
            "confidence_tier", F.coalesce("preset_tier", network_tier(F.col("reputation_hit"), F.col("signal_kinds")))
        )
    kinds = (
        findings.filter(F.col("dst_ip").isNotNull()).select("case_id", "dst_ip", "kind").distinct()
        .groupBy("case_id", "dst_ip").agg(F.count(F.lit(1)).alias("signal_kinds"))
    )
    return findings.join(kinds, ["case_id", "dst_ip"], "left").withColumn(
        "confidence_tier",
        F.coalesce("preset_tier", network_tier(F.col("reputation_hit"), F.coalesce("signal_kinds", F.lit(0)))),
    )


# --- static prior ---------------------------------------------------------------------


def match_keys(kind: Column, value: Column) -> Column:
    """The address and name texts a static indicator could match."""
    v = F.trim(value)
    domain = F.lower(F.substring_index(v, "@", -1))
    with_scheme = F.when(v.contains("://"), v).otherwise(F.concat(F.lit("http://"), v))
    host = url_host(with_scheme)
    return (
        F.when(kind == "domain", F.array(F.lower(v)))
        .when(kind == "email", F.array_distinct(F.array(F.lower(v), domain)))
        .when(kind == "url", F.array_compact(F.array(host)))
        .otherwise(F.array(v))
    )


def from_config(source: Column) -> Column:
    text = F.lower(F.coalesce(source, F.lit("")))
    out = F.lit(False)
    for mark in CONFIG_SOURCES:
        out = out | text.contains(mark)
    return out


def without_infrastructure(iocs: DataFrame, infrastructure: DataFrame) -> DataFrame:
    """Drop address indicators that are the guest or a resolver."""
    infra = infrastructure.select("case_id", F.col("dst_ip").alias("value"), F.lit("ip").alias("type")).distinct()
    return iocs.join(infra, ["case_id", "type", "value"], "left_anti")


def correlate_static_prior(
    iocs: DataFrame, observed_ips: DataFrame, observed_domains: DataFrame
) -> DataFrame:
    """Add `matched` (sorted match keys seen on the network) and `observed` to each indicator."""
    keys = iocs.select("case_id", "seq", F.explode(match_keys(F.col("type"), F.col("value"))).alias("key"))
    seen = (
        observed_ips.select("case_id", F.col("dst_ip").alias("key"))
        .unionByName(observed_domains.select("case_id", F.lower("domain").alias("key")))
        .filter(F.col("key") != "")
        .distinct()
    )
    # An indicator has at most two keys, so the collected list is tiny.
    matched = (
        keys.distinct().join(seen, ["case_id", "key"])
        .groupBy("case_id", "seq").agg(F.array_sort(F.collect_list("key")).alias("matched"))
    )
    out = iocs.join(matched, ["case_id", "seq"], "left")
    return _set(
        out,
        matched=F.coalesce("matched", F.array().cast("array<string>")),
        observed=F.col("matched").isNotNull(),
        config=from_config(F.col("source")),
    )


def apply_static_prior(
    findings: DataFrame, iocs: DataFrame, raw_ips: DataFrame, raw_domains: DataFrame,
    infrastructure: DataFrame | None = None, default_time: DataFrame | None = None,
) -> DataFrame:
    """Confirm findings that match a static indicator and add observed-only and dormant rows."""
    if infrastructure is not None:
        iocs = without_infrastructure(iocs, infrastructure)
        raw_ips = raw_ips.join(infrastructure, ["case_id", "dst_ip"], "left_anti")
    ips = findings.select("case_id", "dst_ip").unionByName(raw_ips.select("case_id", "dst_ip"))
    names = findings.select("case_id", F.col("destination_domain").alias("domain")).unionByName(
        raw_domains.select("case_id", "domain")
    )
    corr = correlate_static_prior(iocs, ips, names)
    family = F.when(
        F.coalesce("family", F.lit("")) != "", F.concat(F.lit(" ("), F.col("family"), F.lit(")"))
    ).otherwise("")
    hits = corr.select("case_id", "family", F.explode("matched").alias("key")).groupBy("case_id", "key").agg(
        F.max(family).alias("_family")
    )
    by_ip = hits.select("case_id", F.col("key").alias("dst_ip"), F.col("_family").alias("_ip_family"))
    by_name = hits.select("case_id", F.col("key").alias("_name"), F.col("_family").alias("_name_family"))
    matched = F.coalesce("_ip_family", "_name_family")
    promoted = _set(
        findings.withColumn("_name", F.lower("destination_domain"))
        .join(by_ip, ["case_id", "dst_ip"], "left")
        .join(by_name, ["case_id", "_name"], "left"),
        confidence_tier=F.when(matched.isNotNull(), "confirmed").otherwise(F.col("confidence_tier")),
        reputation_hit=F.col("reputation_hit") | matched.isNotNull(),
        static_match=F.when(matched.isNotNull(), F.concat(F.lit("matches static-extracted C2"), matched)),
        static_note=F.lit(None).cast("string"),
    ).drop("_name", "_ip_family", "_name_family")
    # Indicators that already are a finding add no row of their own.
    known = (
        findings.select("case_id", F.col("dst_ip").alias("value"))
        .unionByName(findings.select("case_id", F.lower("destination_domain").alias("value")))
        .filter(F.col("value").isNotNull()).distinct().withColumn("_known", F.lit(True))
    )
    rows = corr.withColumn("_value", F.col("value")).join(
        known.select("case_id", F.col("value").alias("_value"), F.col("_known").alias("_as_is")),
        ["case_id", "_value"], "left",
    ).withColumn("_lower", F.lower("value")).join(
        known.select("case_id", F.col("value").alias("_lower"), F.col("_known").alias("_as_name")),
        ["case_id", "_lower"], "left",
    )
    rows = rows.filter(~F.col("observed") | (F.col("_as_is").isNull() & F.col("_as_name").isNull()))
    if default_time is not None:
        rows = rows.join(default_time, "case_id", "left")
    is_ip = F.col("type") == "ip"
    how = F.when(F.col("config"), "decrypted from the sample's configuration").otherwise(
        "found as a string inside the sample"
    )
    obs, cfg = F.col("observed"), F.col("config")
    extra = rows.select(
        "case_id", F.lit("static_ioc").alias("kind"), F.lit(99).alias("kind_rank"), "seq",
        F.struct(F.lit(99).alias("kind_rank"), F.col("seq"), F.col("value").alias("name")).alias("finding_no"),
        F.when(is_ip, F.col("value")).otherwise("").alias("dst_ip"),
        F.lit(0).alias("dst_port"),
        (F.col("event_time") if default_time is not None else F.lit(None).cast("double")).alias("event_time"),
        F.when(obs & cfg, 0.9).when(obs, 0.7).when(cfg, 0.8).otherwise(0.4).alias("confidence"),
        obs.alias("reputation_hit"),
        F.when(~is_ip, F.col("value")).alias("destination_domain"),
        F.lit(False).alias("plaintext_available"),
        F.when(obs & cfg, "confirmed").when(obs | cfg, "strong").otherwise("weak").alias("confidence_tier"),
        F.when(obs, F.concat(F.lit("C2"), family, F.lit(" "), how, F.lit(" and contacted on network"))).alias("static_match"),
        F.when(
            ~obs, F.concat(F.lit("Address"), family, F.lit(" "), how, F.lit("; not observed on the network (dormant)"))
        ).alias("static_note"),
    )
    return promoted.unionByName(extra, allowMissingColumns=True)


# --- allowlist, geography -----------------------------------------------------------------


def apply_allowlist(findings: DataFrame, domains: DataFrame | None = None, cidrs: DataFrame | None = None) -> DataFrame:
    """Weak findings to sanctioned services become allowlisted; nothing else changes."""
    looked = allowlist_lookup(findings, domains, cidrs)
    down = (F.col("confidence_tier") == "weak") & F.col("allowlist_match").isNotNull()
    return _set(
        looked.withColumn("_down", F.coalesce(down, F.lit(False))),
        confidence_tier=F.when(F.col("_down"), "allowlisted").otherwise(F.col("confidence_tier")),
        allowlist_match=F.when(F.col("_down"), F.col("allowlist_match")),
    ).drop("_down")


def apply_geo(findings: DataFrame, geo: DataFrame | None) -> DataFrame:
    return findings if geo is None else geo_enrich(findings, geo)


# --- gates ------------------------------------------------------------------------------------


def gate_findings(findings: DataFrame, manifests: DataFrame) -> DataFrame:
    """Simulated mark, bad-clock cap of timing findings, plaintext default under pinning."""
    m = manifests.select(
        "case_id", F.lit(True).alias("_has"), network_mode(F.col("network_mode")).alias("_mode"),
        F.col("clock_quality_acceptable").alias("_clock_ok"),
        pinning_suspected(F.col("tls_interception_status")).alias("_pinned"),
    )
    static = F.coalesce("static_match", F.lit("")) != "" if "static_match" in findings.columns else F.lit(False)
    bad_clock = F.col("_has").isNotNull() & ~F.coalesce("_clock_ok", F.lit(False)) & F.col("kind").isin(TIMING_KINDS)
    joined = findings.join(m, "case_id", "left").withColumn(
        "_gated",
        F.when(bad_clock, capped_tier(F.col("confidence_tier"), "weak", F.col("reputation_hit") | static)).otherwise(
            F.col("confidence_tier")
        ),
    )
    return _set(
        joined,
        network_mode=F.when(F.col("_mode") == "simulated", F.lit("simulated_inetsim")),
        capped_by_caveat=F.when(F.col("_gated") != F.col("confidence_tier"), F.lit("clock_quality")),
        plaintext_available=F.when(
            F.coalesce("_pinned", F.lit(False)), F.coalesce("plaintext_available", F.lit(False))
        ).otherwise(F.col("plaintext_available")),
        confidence_tier=F.col("_gated"),
    ).drop("_has", "_mode", "_clock_ok", "_pinned", "_gated")


def _capped(rows: DataFrame | None, caveat: str, name: str, like: DataFrame) -> DataFrame:
    if rows is None:
        return like.select("case_id", F.lit(0).cast("bigint").alias(name)).limit(0)
    return rows.filter(F.col("capped_by_caveat") == caveat).groupBy("case_id").agg(F.count(F.lit(1)).alias(name))


def case_notes(
    manifests: DataFrame, findings: DataFrame, correlated: DataFrame | None = None, alignment: DataFrame | None = None,
    provider_map: dict[str, list[str]] | None = None,
) -> DataFrame:
    """The ledger of caveats: (case_id, gate, code, affected, note), one row for each that holds for a case.

    The network and correlation gates, the handoff and the clock check append to it. `affected` counts
    the rows that a gate has capped, null where it caps none by nature. `correlated` has gone through
    `gate_correlated`, `alignment` is the result of `verify_clock_alignment`.
    """
    m = manifests
    for rows, caveat, name in (
        (findings, "clock_quality", "_capped"), (correlated, "clock_quality", "_unclocked"), (correlated, "telemetry_degraded", "_blind"),
    ):
        m = m.join(_capped(rows, caveat, name, manifests), "case_id", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    mode = network_mode(F.col("network_mode"))
    status = F.col("tls_interception_status")
    stated = F.col("network_mode").isNotNull()
    clock_bad = ~F.coalesce("clock_quality_acceptable", F.lit(False))
    providers = F.coalesce("providers_unavailable", F.array().cast("array<string>"))
    types = F.nullif(F.array_join(F.array_sort(degraded_types(providers, provider_map)), ", "), F.lit(""))
    scope = F.when(degraded_everywhere(providers, provider_map), "all data types").otherwise(F.coalesce(types, F.lit("none")))
    named = F.coalesce(F.nullif(F.array_join(providers, ", "), F.lit("")), F.lit("unspecified"))
    no_count = F.lit(None).cast("bigint")

    def item(gate: str, code: str, test: Column, *text: Column, affected: Column = no_count) -> Column:
        return F.when(
            test,
            F.struct(F.lit(gate).alias("gate"), F.lit(code).alias("code"), affected.alias("affected"), F.concat(*text).alias("note")),
        )

    items = [
        item(
            "network", "network_simulated", mode == "simulated",
            F.lit("NETWORK SIMULATED: what was contacted was only attempted, nothing was delivered. Finding no upload does "
                  "not clear the sample."),
        ),
        item(
            "network", "network_live", mode == "real", F.lit("NETWORK LIVE (mode '"), F.col("network_mode"),
            F.lit("'): contacted destinations were reached; a blocked one cannot be told from one never tried."),
        ),
        item(
            "network", "network_unrecognised", stated & (mode == "unknown"), F.lit("NETWORK MODE UNKNOWN ('"),
            F.col("network_mode"), F.lit("'): missing uploads allow no conclusion."),
        ),
        item(
            "network", "clock_quality", clock_bad,
            F.lit("CLOCKS NOT RELIABLE: "), F.col("_capped").cast("string"), F.lit(" timing finding(s) lowered to weak."), affected=F.col("_capped"),
        ),
        item(
            "network", "tls_not_intercepted", pinning_suspected(status), F.lit("TLS NOT READABLE ("), status,
            F.lit("): only metadata of encrypted traffic was judged."),
        ),
        item("network", "tls_intercepted", tls_intercepted(status), F.lit("TLS READABLE: decrypted payloads were at hand.")),
        item(
            "correlation", "correlation_clock", clock_bad & (F.col("_unclocked") > 0),
            F.lit("CLOCKS NOT RELIABLE: "), F.col("_unclocked").cast("string"),
            F.lit(" link(s) between host and network lowered to weak."), affected=F.col("_unclocked"),
        ),
        item(
            "correlation", "telemetry_degraded", F.coalesce("telemetry_degraded", F.lit(False)),
            F.lit("TELEMETRY INCOMPLETE (providers missing: "), named, F.lit("): missing host data proves nothing for ["), scope,
            F.lit("]; "), F.col("_blind").cast("string"), F.lit(" link(s) lowered to weak."), affected=F.col("_blind"),
        ),
        item(
            "handoff", "correlation_disabled",
            ~(F.col("host_network_correlation_enabled") & F.col("access_events_correlation_eligible")),
            F.lit("SANDBOX SWITCHED OFF HOST-NETWORK LINKS: "),
            F.coalesce("correlation_reason", F.lit("not stated")),
        ),
        item(
            "handoff", "access_events_rejected", F.coalesce("access_events_rejected_count", F.lit(0)) > 0,
            F.lit("ACCESS EVENTS INCOMPLETE: "), F.col("access_events_rejected_count").cast("string"),
            F.lit(" event(s) were dropped before they arrived."),
        ),
    ]
    out = m.select("case_id", F.explode(F.array_compact(F.array(*items))).alias("n")).select("case_id", "n.*")
    if alignment is not None:
        out = out.unionByName(
            alignment.select(
                "case_id", F.lit("clock").alias("gate"), F.lit("clock_alignment").alias("code"), no_count.alias("affected"), "note"
            )
        )
    return out


def gate_correlated(
    correlated: DataFrame, manifests: DataFrame, provider_map: dict[str, list[str]] | None = None
) -> DataFrame:
    """Cap correlated rows under a bad clock or degraded telemetry for their data type."""
    providers = F.coalesce("providers_unavailable", F.array().cast("array<string>"))
    m = manifests.select(
        "case_id", F.lit(True).alias("_has"), F.col("clock_quality_acceptable").alias("_clock_ok"),
        F.col("telemetry_degraded").alias("_degraded"),
        degraded_types(providers, provider_map).alias("_types"),
        degraded_everywhere(providers, provider_map).alias("_global"),
    )
    joined = correlated.join(m, "case_id", "left")
    bad_clock = F.col("_has").isNotNull() & ~F.coalesce("_clock_ok", F.lit(False))
    blind = F.coalesce("_degraded", F.lit(False)) & (
        F.col("_global") | F.array_contains("_types", F.col("data_type_accessed"))
    )
    capped = capped_tier(F.col("confidence_tier"), "weak", F.col("reputation_hit"))
    changed = (capped != F.col("confidence_tier")) & (bad_clock | F.coalesce(blind, F.lit(False)))
    return _set(
        joined.withColumn("_changed", F.coalesce(changed, F.lit(False))),
        capped_by_caveat=F.when(
            F.col("_changed"), F.when(bad_clock, "clock_quality").otherwise("telemetry_degraded")
        ),
        confidence_tier=F.when(F.col("_changed"), "weak").otherwise(F.col("confidence_tier")),
    ).drop("_has", "_clock_ok", "_degraded", "_types", "_global", "_changed")


def promote_static(correlated: DataFrame, sample_meta: DataFrame) -> DataFrame:
    """Strong rows of independently flagged samples become confirmed unless a caveat capped them."""
    signals = sample_meta.filter(F.size("errors") == 0).select("case_id", corroborating_signals().alias("_signals"))
    joined = correlated.join(signals, "case_id", "left")
    caveat = F.col("capped_by_caveat") if "capped_by_caveat" in correlated.columns else F.lit(None).cast("string")
    lift = (F.col("confidence_tier") == "strong") & (F.coalesce(F.size("_signals"), F.lit(0)) > 0) & caveat.isNull()
    return _set(
        joined.withColumn("_lift", F.coalesce(lift, F.lit(False))),
        confidence_tier=F.when(F.col("_lift"), "confirmed").otherwise(F.col("confidence_tier")),
        static_corroboration=F.when(F.col("_lift"), F.col("_signals")),
    ).drop("_lift", "_signals")


