"""Rounding and time Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(value: Column, digits: int) -> Column:
    """Half-even rounding on the scaled double."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0.0 when the whole is zero or negative."""
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def epoch_seconds(timestamp: Column) -> Column:
    """Epoch seconds as DOUBLE from a TIMESTAMP or TIMESTAMP_NTZ read in UTC."""
    return F.unix_micros(timestamp.cast("timestamp")) / F.lit(1e6)


def iso_utc(seconds: Column) -> Column:
    """ISO-8601 UTC text with offset; microseconds only when present."""
    micros = F.rint(seconds * 1e6).cast("bigint")
    moment = F.timestamp_micros(micros)
    fraction = F.pmod(micros, F.lit(1000000))
    return F.concat(
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(fraction != 0, F.concat(F.lit("."), F.lpad(fraction.cast("string"), 6, "0"))).otherwise(F.lit("")),
        F.lit("+00:00"),
    )


ZONE_PATTERN = r"([Zz]|[+-][0-9]{2}:?[0-9]{2}(:[0-9]{2})?)$"
ISO_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?)?"


def extended_iso(text: Column) -> Column:
    """The extended form of an ISO text: basic dates and times get their separators and seconds, a decimal comma its point."""
    out = F.regexp_replace(text, r"^([0-9]{4})([0-9]{2})([0-9]{2})(?=$|[T ])", "$1-$2-$3")
    out = F.regexp_replace(out, r"^([^T ]{10}[T ][0-9]{2})([0-9]{2})([0-9]{2})(?![0-9:])", "$1:$2:$3")
    out = F.regexp_replace(out, r"^([^T ]{10}[T ][0-9]{2}):?([0-9]{2})(?![0-9:])", "$1:$2:00")
    return F.regexp_replace(out, r"(:[0-9]{2}:[0-9]{2}),([0-9])", "$1.$2")


def parse_iso(text: Column, require_zone: bool = True) -> Column:
    """Epoch seconds of an ISO-8601 text in extended or basic form, NULL when malformed.

    A text without an offset is refused when `require_zone`, otherwise read as UTC. Week and
    ordinal dates are not read.
    """
    text = extended_iso(text)
    has_zone = text.rlike(ZONE_PATTERN)
    shape = text.rlike(ISO_PATTERN)
    seconds = F.unix_micros(F.try_to_timestamp(text)) / F.lit(1e6)
    keep = shape & has_zone if require_zone else shape
    return F.when(keep, seconds)
