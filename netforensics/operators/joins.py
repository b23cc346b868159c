"""Lookups against intelligence, allowlists and address ranges.

Intelligence and range tables carry no broadcast hint: they grow, so Spark decides from the measured
size (autoBroadcastJoinThreshold, re-checked by AQE) and falls back to a shuffle join whose hot keys
AQE splits. Only the prefix lengths in use are broadcast, 42 short rows at most.
"""

from __future__ import annotations

import ipaddress
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from netforensics.functions.ip import cidr_bounds, ip_key
from netforensics.functions.text import clean_name, name_suffixes, registered_domain
from netforensics.vocab import ALLOWLIST_DOMAINS


def _renamed(intel: DataFrame, key: str, tag: str) -> DataFrame:
    return intel.select(
        F.col("value").alias(key), F.col("source").alias(f"_{tag}_source"), F.col("note").alias(f"_{tag}_note"),
        F.lit(True).alias(f"_{tag}_hit"),
    )


def lookup_indicators(rows: DataFrame, intel: DataFrame) -> DataFrame:
    """Add reputation_hit/source/note and match_on: the address wins, then JA3, then JA4."""
    joined = rows.join(_renamed(intel, "dst_ip", "ip"), "dst_ip", "left")
    hit, source, note = F.col("_ip_hit"), F.col("_ip_source"), F.col("_ip_note")
    match = F.when(F.col("_ip_hit"), F.lit("ip"))
    helpers = ["_ip_hit", "_ip_source", "_ip_note"]
    for label in ("ja3", "ja4"):
        if label not in rows.columns:
            continue
        joined = joined.join(_renamed(intel, label, label), label, "left")
        own_hit, own_note = F.col(f"_{label}_hit"), F.col(f"_{label}_note")
        usable = own_hit & (F.col(label) != "")
        text = F.when(
            F.coalesce(own_note, F.lit("")) != "", F.concat(F.lit(f"{label.upper()} match: "), own_note)
        ).otherwise(F.lit(f"known-bad {label.upper()} fingerprint"))
        source = F.when(hit.isNotNull(), source).when(
            usable, F.coalesce(F.col(f"_{label}_source"), F.lit(f"known_bad_{label}"))
        )
        note = F.when(hit.isNotNull(), note).when(usable, text)
        match = F.when(hit.isNotNull(), match).when(usable, F.lit(label))
        hit = F.coalesce(hit, F.when(usable, F.lit(True)))
        helpers += [f"_{label}_hit", f"_{label}_source", f"_{label}_note"]
    return (
        joined.withColumn("reputation_source", source)
        .withColumn("reputation_note", note)
        .withColumn("match_on", match)
        .withColumn("reputation_hit", F.coalesce(hit, F.lit(False)))
        .select(*rows.columns, "reputation_hit", "reputation_source", "reputation_note", "match_on")
    )


def lookup_domains(rows: DataFrame, intel: DataFrame, column: str = "destination_domain") -> DataFrame:
    """Add domain_hit/domain_source/domain_note: the exact host, else its registered domain."""
    clean = clean_name(F.col(column))
    keyed = rows.withColumn("_host", clean).withColumn("_registered", registered_domain(clean))
    joined = keyed.join(_renamed(intel, "_host", "host"), "_host", "left").join(
        _renamed(intel, "_registered", "reg"), "_registered", "left"
    )
    exact = F.col("_host_hit").isNotNull()
    return joined.select(
        *rows.columns,
        F.coalesce("_host_hit", "_reg_hit", F.lit(False)).alias("domain_hit"),
        F.when(exact, F.col("_host_source")).otherwise(F.col("_reg_source")).alias("domain_source"),
        F.when(exact, F.col("_host_note")).otherwise(F.col("_reg_note")).alias("domain_note"),
    )


def default_allowlist_match(domain: Column) -> Column:
    """The longest built-in sanctioned name the domain equals or sits under, else NULL."""
    found = F.filter(name_suffixes(clean_name(domain)), lambda s: s.isin(ALLOWLIST_DOMAINS))
    return F.get(found, F.lit(0))


def suffix_lookup(names: DataFrame, listed: DataFrame, column: str) -> DataFrame:
    """(column, matched): the longest listed name each distinct name equals or sits under."""
    parents = (
        names.select(column).filter(F.col(column).isNotNull()).distinct()
        .withColumn("matched", F.explode(name_suffixes(clean_name(F.col(column)))))
    )
    hits = parents.join(listed.select(F.lower("domain").alias("matched")).distinct(), "matched")
    return hits.groupBy(column).agg(F.max_by("matched", F.length("matched")).alias("matched"))


def _address_prefixes(rows: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """(column, _key, _prefix): the prefixes of each distinct address that a `table` of prefixes could hold.

    Which lengths are in use is itself a join, on the family (the first digit of a key): a v4 key has 9
    digits and a v6 key 33, so at most 42 rows are broadcast whatever the size of the table.
    """
    first = F.substr("_prefix", F.lit(1), F.lit(1))
    lengths = table.select(first.alias("_family"), F.length("_prefix").alias("_len")).distinct()
    # A key that is not null keeps the optimizer from pushing its test below the distinct.
    key = F.coalesce(ip_key(F.col(column)), F.lit(""))
    addresses = rows.select(column).distinct().withColumn("_key", key).withColumn("_family", F.substr("_key", F.lit(1), F.lit(1)))
    return addresses.join(F.broadcast(lengths), "_family").select(
        column, "_key", F.substr("_key", F.lit(1), F.col("_len")).alias("_prefix")
    )


def network_lookup(rows: DataFrame, networks: DataFrame, column: str = "dst_ip") -> DataFrame:
    """Join each distinct address with the narrowest network that contains it.

    `networks` has a `network` text (CIDR) plus payload columns. The join is an equi join on the
    whole hex digits of the network; the remaining bits are a residual predicate.
    """
    low, high = cidr_bounds(F.col("network"))
    table = networks.withColumn("_low", low).withColumn("_high", high).filter(F.col("_low").isNotNull())
    same = F.transform(
        F.sequence(F.lit(1), F.length("_low")),
        lambda i: F.when(F.substr("_low", F.lit(1), i) == F.substr("_high", F.lit(1), i), i),
    )
    table = table.withColumn("_len", F.array_max(same)).withColumn(
        "_prefix", F.substr("_low", F.lit(1), F.col("_len"))
    )
    addresses = _address_prefixes(rows, table, column)
    payload = [c for c in networks.columns]
    hits = addresses.join(table.select("_prefix", "_low", "_high", *payload), "_prefix").filter(
        F.col("_key").between(F.col("_low"), F.col("_high"))
    )
    # A narrower network starts later or ends earlier.
    best = F.max(F.struct("_low", F.translate("_high", "0123456789abcdef", "fedcba9876543210").alias("_inv"), *payload))
    return hits.groupBy(column).agg(best.alias("_b")).select(column, *[F.col(f"_b.{c}").alias(c) for c in payload])


def allowlist_lookup(
    rows: DataFrame, domains: DataFrame | None = None, cidrs: DataFrame | None = None,
    domain_column: str = "destination_domain", ip_column: str = "dst_ip",
) -> DataFrame:
    """Add allowlist_match: a sanctioned name or network, NULL when none.

    The built-in names are a Column; site entries join on the parents of the distinct names.
    """
    match = default_allowlist_match(F.col(domain_column))
    out = rows
    helpers = [match]
    if domains is not None:
        site = suffix_lookup(rows, domains, domain_column).withColumnRenamed("matched", "_site")
        out = out.join(site, domain_column, "left")
        longer = F.length("_site") > F.coalesce(F.length(match), F.lit(0))
        helpers = [F.when(F.coalesce(longer, F.lit(False)), F.col("_site")), match]
    if cidrs is not None:
        nets = network_lookup(rows, cidrs.select(F.col("cidr").alias("network")), ip_column).withColumnRenamed(
            "network", "_net"
        )
        out = out.join(nets, ip_column, "left")
        helpers.append(F.col("_net"))
    return out.withColumn("_match", F.coalesce(*helpers)).select(
        *rows.columns, F.col("_match").alias("allowlist_match")
    )


def _number(value: int | str | None) -> tuple[str, int] | None:
    """Family digit and number of an address; a plain number is a v4 address."""
    if value is None:
        return None
    if isinstance(value, str):
        try:
            address = ipaddress.ip_address(value.strip())
        except ValueError:
            return None
        return str(address.version), int(address)
    return ("4", int(value)) if 0 <= value < 1 << 32 else None


def aligned_prefixes(low: int, high: int, digits: int) -> Iterator[str]:
    """The fewest hex prefixes of keys of so many digits that cover low..high exactly, in order."""
    while low <= high:
        free = 0
        while free < digits and not low & ((16 << 4 * free) - 1) and low + (16 << 4 * free) - 1 <= high:
            free += 1
        yield f"{low >> 4 * free:0{digits - free}x}" if free < digits else ""
        low += 1 << 4 * free


def range_prefixes(ranges: DataFrame) -> DataFrame:
    """Ranges (lo, hi, payload) as rows (_prefix, _width, _low, payload), one for each aligned prefix.

    lo and hi are numbers (v4) or address texts of either family. A range of v4 gives at most 210
    prefixes, one of v6 at most 930; one that starts and ends at a network border gives a few. Ranges
    that are unreadable, mixed or empty hold no address.
    """
    payload = [c for c in ranges.columns if c not in ("lo", "hi")]
    text = [StructField(c, StringType()) for c in ("_prefix", "_width", "_low")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, rows = [], []
            for row, (lo, hi) in enumerate(zip(batch.column("lo").to_pylist(), batch.column("hi").to_pylist(), strict=True)):
                low, high = _number(lo), _number(hi)
                if low is None or high is None or low[0] != high[0]:
                    continue
                digits = 8 if low[0] == "4" else 32
                for prefix in aligned_prefixes(low[1], high[1], digits):
                    found.append((low[0] + prefix, f"{high[1] - low[1]:032x}", f"{low[1]:032x}"))
                    rows.append(row)
            if rows:
                keys = [pa.array(c, pa.string()) for c in zip(*found, strict=True)]
                own = batch.select(payload).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([*keys, *own.columns], ["_prefix", "_width", "_low", *payload])

    return ranges.select("lo", "hi", *payload).mapInArrow(run, StructType([*text, *(ranges.schema[c] for c in payload)]))


def range_lookup(rows: DataFrame, ranges: DataFrame, column: str = "dst_ip") -> DataFrame:
    """Join each distinct address, v4 or v6, with the narrowest (lo, hi) range that holds it."""
    table = range_prefixes(ranges)
    payload = [c for c in ranges.columns if c not in ("lo", "hi")]
    hits = _address_prefixes(rows, table, column).join(table, "_prefix")
    best = F.min(F.struct("_width", "_low", *payload))
    return hits.groupBy(column).agg(best.alias("_b")).select(column, *[F.col(f"_b.{c}").alias(c) for c in payload])


def geo_enrich(rows: DataFrame, geo: DataFrame, column: str = "dst_ip") -> DataFrame:
    """Fill empty geo_country, asn and asn_org; present values are never replaced.

    `geo` holds either ranges (lo, hi), as v4 numbers or address texts, or CIDR text in `network`.
    """
    lookup = network_lookup if "network" in geo.columns else range_lookup
    found = lookup(rows, geo, column).select(
        column, F.col("geo_country").alias("_country"), F.col("asn").alias("_asn"), F.col("asn_org").alias("_org")
    )
    out = rows.join(found, column, "left")
    for name, extra in (("geo_country", "_country"), ("asn", "_asn"), ("asn_org", "_org")):
        own = F.col(name) if name in rows.columns else F.lit(None).cast("string")
        out = out.withColumn(name, F.coalesce(F.when(own != "", own), F.col(extra)))
    return out.drop("_country", "_asn", "_org")
