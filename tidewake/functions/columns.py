"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewake.schema import MINUTE_US

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def micros(ts: str) -> Column:
    """Unix microseconds of a TIMESTAMP_NTZ column, whatever the session's time zone."""
    return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, {ts})")


def event_at(time_us: str = "time_us") -> Column:
    """TIMESTAMP_NTZ (UTC) of unix microseconds."""
    return F.expr(f"timestampadd(MICROSECOND, {time_us}, {_EPOCH})")


def minute_us(time_us: str = "time_us") -> Column:
    """Start of the tumbling minute, truncating towards zero."""
    return F.expr(f"{time_us} div {MINUTE_US} * {MINUTE_US}")


def salted_hash(salt: str, *parts: Column) -> Column:
    """First 32 hex digits of sha256(salt, then 0x00 and each part)."""
    if not salt:
        raise ValueError("a salt is required")
    sep = F.expr("X'00'")
    pieces = [F.encode(F.lit(salt), "UTF-8")]
    for p in parts:
        pieces += [sep, F.encode(p, "UTF-8")]
    return F.substring(F.sha2(F.concat(*pieces), 256), 1, 32)


def resume_cursor(checkpoint: Column, rewind: Column) -> Column:
    """0 without a checkpoint; else checkpoint - rewind, at least 1."""
    return F.when(checkpoint <= 0, F.lit(0)).otherwise(F.greatest(checkpoint - rewind, F.lit(1))).cast("long")
