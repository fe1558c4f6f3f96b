"""One copy of each event, the first in log order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_by_log_order(log: DataFrame, key: str = "event_id") -> DataFrame:
    """The earliest row of each key by (partition, offset).

    A min over structs combines on the map side, so a key replayed very often costs one row per task;
    a row_number window would bring all its copies to one task.
    """
    order = ["kafka_partition", "kafka_offset"]
    rest = [c for c in log.columns if c not in (key, *order)]
    return log.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("__r")).select(*[F.col(key) if c == key else F.col(f"__r.{c}").alias(c) for c in log.columns])


def prune_seen(seen: DataFrame, cutoff_us: int) -> DataFrame:
    """What stays in the dedupe window: ids not older than the cutoff (0: keep all)."""
    return seen if cutoff_us <= 0 else seen.where(F.col("time_us") >= cutoff_us)
