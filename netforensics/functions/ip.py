"""IP address Columns: parsing, classes and CIDR bounds for v4 and v6 without a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
V4_PATTERN = rf"^{_OCTET}(\.{_OCTET}){{3}}$"
_H = "[0-9a-fA-F]{1,4}"
V6_PATTERN = (
    rf"^(({_H}:){{7}}{_H}|({_H}:){{1,7}}:|:(:{_H}){{1,7}}|::"
    + "".join(rf"|({_H}:){{1,{7 - n}}}(:{_H}){{1,{n}}}" for n in range(1, 7))
    + r")$"
)


def is_v4(ip: Column) -> Column:
    return F.coalesce(ip.rlike(V4_PATTERN), F.lit(False))


def is_v6(ip: Column) -> Column:
    return F.coalesce(ip.contains(":") & ip.rlike(V6_PATTERN), F.lit(False))


def is_ip_literal(ip: Column) -> Column:
    """True for a bare v4 or v6 address."""
    return is_v4(ip) | is_v6(ip)


def v4_number(ip: Column) -> Column:
    """A v4 address as BIGINT; NULL for anything else."""
    part = F.split(ip, r"\.")
    value = (
        part[0].cast("bigint") * 16777216
        + part[1].cast("bigint") * 65536
        + part[2].cast("bigint") * 256
        + part[3].cast("bigint")
    )
    return F.when(is_v4(ip), value)


def _expand_side(side: Column) -> Column:
    groups = F.filter(F.split(side, ":"), lambda g: g != "")
    return F.transform(groups, lambda g: F.lpad(g, 4, "0"))


def ip_hex(ip: Column) -> Column:
    """Address as fixed-width hex (8 digits for v4, 32 for v6), so text order is address order."""
    halves = F.split(F.lower(ip), "::")
    left = _expand_side(halves[0])
    right = F.coalesce(_expand_side(F.get(halves, F.lit(1))), F.array().cast("array<string>"))
    gap = F.repeat(F.lit("0000"), F.lit(8) - F.size(left) - F.size(right))
    v6 = F.concat(F.array_join(left, ""), gap, F.array_join(right, ""))
    return F.when(is_v4(ip), F.lower(F.lpad(F.hex(v4_number(ip)), 8, "0"))).when(is_v6(ip), v6)


def ip_key(ip: Column) -> Column:
    """Sortable key: family digit plus fixed-width hex; NULL for a malformed address."""
    return F.concat(F.when(is_v4(ip), F.lit("4")).otherwise(F.lit("6")), ip_hex(ip))


def _let(value: Column, body) -> Column:
    """Evaluate `value` once and hand it to `body`; keeps repeated use of a large expression small."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def cidr_bounds(cidr: Column) -> tuple[Column, Column]:
    """(low key, high key) of a CIDR; both NULL when the text is not a valid network."""
    piece = F.split(F.trim(cidr), "/")
    parsed = F.struct(
        ip_hex(piece[0]).alias("hex"),
        F.get(piece, F.lit(1)).try_cast("int").alias("bits"),
        F.size(piece).alias("parts"),
    )

    def bounds(p: Column) -> Column:
        digits = p["hex"]
        width = F.length(digits)
        bits = F.when(p["parts"] == 1, width * 4).otherwise(p["bits"])
        full = F.floor(bits / 4).cast("int")
        spare = bits % 4
        nibble = F.conv(F.substr(digits, full + 1, F.lit(1)), 16, 10).cast("int")
        block = F.pow(F.lit(2), F.lit(4) - spare).cast("int")
        low_nibble = nibble - nibble % block
        tail = width - full - F.when(spare > 0, 1).otherwise(0)
        mid_low = F.when(spare > 0, F.lower(F.hex(low_nibble.cast("bigint")))).otherwise(F.lit(""))
        mid_high = F.when(spare > 0, F.lower(F.hex((low_nibble + block - 1).cast("bigint")))).otherwise(F.lit(""))
        head = F.concat(F.when(width == 8, F.lit("4")).otherwise(F.lit("6")), F.substr(digits, F.lit(1), full))
        ok = digits.isNotNull() & bits.between(0, width * 4)
        return F.when(
            ok,
            F.struct(
                F.concat(head, mid_low, F.repeat(F.lit("0"), tail)).alias("low"),
                F.concat(head, mid_high, F.repeat(F.lit("f"), tail)).alias("high"),
            ),
        )

    both = _let(parsed, bounds)
    return both.getField("low"), both.getField("high")


# The class tests below run on every row of the largest tables, so each is one or two regular
# expressions on the text instead of arithmetic on a parsed number.

def _networks(*prefixes: tuple[str, int]) -> str:
    """Pattern of v4 addresses: each prefix pattern followed by the given number of octets."""
    return "^(?:" + "|".join(rf"(?:{p})(?:\.{_OCTET}){{{n}}}" for p, n in prefixes) + ")$"


# Networks that never count as a remote destination
# (10/8, 127/8, 0/8, 172.16/12, 192.168/16, 169.254/16).
_INTERNAL = [("10|127|0", 3), (r"172\.(?:1[6-9]|2[0-9]|3[01])", 2), (r"192\.168|169\.254", 2)]
INTERNAL_V4 = _networks(*_INTERNAL)

# The IANA special-purpose registry as the broader private test reads it
# (adds 192.0.0/24, 192.0.2/24, 198.18/15, 198.51.100/24, 203.0.113/24, 240/4).
SPECIAL_V4 = _networks(
    *_INTERNAL,
    (r"192\.0\.(?:0|2)|198\.51\.100|203\.0\.113", 1),
    (r"198\.1[89]", 2),
    ("24[0-9]|25[0-5]", 3),
)
NOISE_V4 = _networks(("22[4-9]|23[0-9]|24[0-9]|25[0-5]", 3), (r"169\.254", 2))


def _v6(ip: Column, test: Column) -> Column:
    return ip.contains(":") & is_v6(ip) & test


def _v6_internal(ip: Column) -> Column:
    low = F.lower(ip)
    loopback = low.rlike("^[0:]*1$")
    return loopback | low.rlike("^(fe[89ab][0-9a-f]|f[cd][0-9a-f]{2}):")


def is_private(ip: Column) -> Column:
    """Internal destination test: documentation ranges stay public, malformed text is not private."""
    return F.coalesce(ip.rlike(INTERNAL_V4) | _v6(ip, _v6_internal(ip)), F.lit(False))


def is_special(ip: Column) -> Column:
    """Broader private test used for guest and responder scope (special-purpose ranges included)."""
    v4 = ip.rlike(SPECIAL_V4) & ~ip.isin("192.0.0.9", "192.0.0.10")
    v6 = _v6_internal(ip) | F.lower(ip).rlike("^([0:]*$|2001:0?db8:|2002:|::ffff:|0?100::)")
    return F.coalesce(v4 | _v6(ip, v6), F.lit(False))


def is_noise(ip: Column) -> Column:
    """Broadcast, multicast, reserved, unspecified, link-local or network addresses."""
    v4 = ip.rlike(NOISE_V4) | (is_v4(ip) & (ip.endswith(".255") | ip.endswith(".0")))
    first = F.coalesce(F.conv(F.substring_index(ip, ":", 1), 16, 10).cast("int"), F.lit(0))
    v6 = (first < 0x2000) | first.between(0x4000, 0xFBFF) | first.between(0xFE00, 0xFEBF) | (first >= 0xFF00)
    return F.coalesce(v4 | _v6(ip, v6), F.lit(False))
