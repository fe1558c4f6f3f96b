"""Fixed schemas of the event log and the frozen logic configuration."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MINUTE_US = 60_000_000

EVENT = T.StructType(
    [T.StructField("event_id", T.StringType()), T.StructField("account_id", T.StringType()), T.StructField("time_us", T.LongType())]
    + [T.StructField(n, T.StringType()) for n in ("kind", "collection", "operation", "subject_account_id")]
)
LOG = T.StructType([*EVENT.fields, T.StructField("kafka_partition", T.IntegerType()), T.StructField("kafka_offset", T.LongType())])
EVENT_COLUMNS = [f.name for f in EVENT.fields]

#: Raw feed message. ``subject`` is a string or an object, so records stay raw JSON until N2 reads it.
RAW = T.StructType(
    [
        T.StructField("did", T.StringType()),
        T.StructField("time_us", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField(
            "commit",
            T.StructType([T.StructField(n, T.StringType()) for n in ("rev", "operation", "collection", "rkey", "record")]),
        ),
    ]
)


@dataclass(frozen=True)
class LogicConfig:
    """One logic version: lateness allowance and session gap, in microseconds."""

    late_us: int = 300 * 1_000_000
    gap_us: int = 1800 * 1_000_000

    def __post_init__(self):
        if self.late_us < 0 or self.gap_us < 0:
            raise ValueError("late_us and gap_us must not be negative")

    @property
    def disjoint_sessions(self) -> bool:
        """late <= gap: session-late events cannot occur and an account's sessions never overlap."""
        return self.late_us <= self.gap_us
