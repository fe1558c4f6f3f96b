"""Batching, checkpoint holds and the monotone cursor store."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOLD_BACK_US, REPAIR_WAIT_S, REPAIR_SPAN_US, REPAIR_ATTEMPTS = 5_000_000, 30, 5_000_000, 3


def cap(acked: Column, holds: Column) -> Column:
    """The acknowledged cursor, held back to the least pending hold (an array column)."""
    return F.least(acked, F.array_min(holds))


def latest(saves: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Cursor of each ingester: the greatest ever saved, 0 for ids without one."""
    out = saves.groupBy("ingester_id").agg(F.max("cursor_us").alias("cursor_us"))
    return out if ids is None else ids.join(out, "ingester_id", "left").withColumn("cursor_us", F.coalesce("cursor_us", F.lit(0).cast("long")))


@dataclass
class Holds:
    """Pending repair ranges; a checkpoint may not pass the start of one."""

    pending: dict[int, int] = field(default_factory=dict)

    def add(self, start_us: int) -> int:
        key = max(self.pending, default=0) + 1
        self.pending[key] = start_us
        return key

    def release(self, key: int) -> None:
        self.pending.pop(key, None)

    def cap(self, acked_us: int) -> int:
        return min([acked_us, *self.pending.values()])


@dataclass
class Batcher:
    """Collects items up to a size or an age."""

    size: int = 500
    max_age_s: float = 0.25
    items: list = field(default_factory=list)
    max_time_us: int = 0
    since: float = 0.0

    def add(self, item, time_us: int, now: float | None = None) -> bool:
        """True if the batch is due after this item."""
        now = time.monotonic() if now is None else now
        self.since = self.since if self.items else now
        self.items.append(item)
        self.max_time_us = max(self.max_time_us, time_us)
        return self.due(now)

    def due(self, now: float) -> bool:
        return bool(self.items) and (len(self.items) >= self.size or now - self.since >= self.max_age_s)

    def take(self) -> tuple[list, int]:
        out = self.items, self.max_time_us
        self.items, self.max_time_us = [], 0
        return out


def repair_range(connected_us: int) -> tuple[int, int]:
    """The span replayed around a reconnect."""
    return max(1, connected_us - REPAIR_SPAN_US), connected_us + REPAIR_SPAN_US


def backoff(attempt: int, healthy_s: float = 0.0) -> float:
    """Seconds before the next connection: 1 doubling to 30, from 1 again after a session of over a minute."""
    return 1.0 if healthy_s > 60 else min(30.0, 2.0 ** max(0, attempt))
