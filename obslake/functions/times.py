"""Times. All results are zone-free timestamps that hold UTC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms times come in.
ISO_MINUTES = "yyyy-MM-dd'T'HH:mm[:ss]XXX"
COMPACT_SECONDS = "yyyyMMddHHmmss"


def utc_ntz(timestamp: Column) -> Column:
    """A moment as the zone-free timestamp that holds UTC, whatever the session's zone."""
    local = timestamp.cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)


def from_parts(parts: Sequence[Column], strict: bool = True) -> Column:
    """Time from year, month, day and optionally hour and minute.

    Impossible parts are an error, or null if not ``strict``.
    """
    whole = [p.cast("int") for p in parts]
    whole += [F.lit(0)] * (6 - len(whole))
    make = F.make_timestamp_ntz if strict else F.try_make_timestamp_ntz
    return make(*whole)


def from_iso(text: Column, strict: bool = True) -> Column:
    """Time from ISO text with a zone, seconds optional."""
    parse = F.to_timestamp if strict else F.try_to_timestamp
    pattern = ISO_MINUTES if strict else F.lit(ISO_MINUTES)
    return utc_ntz(parse(text, pattern))


def from_compact(text: Column) -> Column:
    """Time from ``yyyyMMddHHmmss``; empty or unreadable text gives null."""
    return F.try_to_timestamp(text, F.lit(COMPACT_SECONDS)).cast("timestamp_ntz")


def from_nanos(nanos: Column) -> Column:
    """Time from nanoseconds since 1970 as a number; whole microseconds, rounded down."""
    thousand = F.lit(1000).cast("bigint")
    micros = F.call_function("div", nanos - F.pmod(nanos, thousand), thousand)
    return utc_ntz(F.timestamp_micros(micros))
