"""Raw feed messages to the log, in micro-batches, with a cursor that never passes a pending repair.

The feed is a folder of Parquet files (seq, value), read as a stream. What the driver keeps is a few numbers per log
partition, in one JSON file that is replaced atomically; log rows are written by Spark. A batch that is run again
starts from the numbers before it and overwrites its own folder.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.operators.normalize import normalize
from tidewake.operators.prefix import running
from tidewake.plans.checkpoint import REPAIR_ATTEMPTS, REPAIR_WAIT_S, Holds, repair_range
from tidewake.schema import EVENT_COLUMNS, LOG
from tidewake.sources.eventlog import PARTITIONS
from tidewake.sources.scratch import written

FEED = "seq long, value string"
RETENTION_HOURS, RETRY_S = 168, 5


def partition_of(account_id: Column, partitions: int) -> Column:
    """The log partition of an account: its leading 32 hash bits, so that all its events meet in one."""
    return (F.conv(F.substring(account_id, 1, 8), 16, 10).cast("long") % partitions).cast("int")


class Topic:
    """A log folder and the state of its ingester."""

    def __init__(self, root: str, control: str, partitions: int = PARTITIONS, retention_hours: int = RETENTION_HOURS):
        """Made at first use; an existing topic keeps its number of partitions."""
        self.root, self.path = root, os.path.join(control, "topic.json")
        os.makedirs(control, exist_ok=True)
        if not os.path.exists(self.path):
            self._save({"partitions": partitions, "retention_hours": retention_hours, "batch": -1, "next": {}, "before": {}, "cursor_us": 0, "messages": 0, "malformed": 0, "produced": 0})

    def state(self) -> dict:
        with open(self.path) as f:
            return json.load(f)

    def _save(self, state: dict) -> None:
        with open(f"{self.path}.tmp", "w") as f:
            json.dump(state, f)
        os.replace(f"{self.path}.tmp", self.path)

    def append(self, feed: DataFrame, batch_id: int, salt: str, holds: Holds | None = None) -> None:
        """X11: normalises one batch, numbers its good rows per partition in feed order and writes them; then moves the cursor.

        Malformed messages are counted and left out; messages without a readable time do not move the cursor.
        """
        s = self.state()
        if batch_id <= s["batch"]:  # the last batch again: back to what was before it
            s |= s["before"]
        before = {k: s[k] for k in ("next", "cursor_us", "messages", "malformed", "produced")}
        n = s["partitions"]
        rows = written(normalize(feed, salt).withColumn("kafka_partition", partition_of(F.col("account_id"), n)), "normalised")
        total = rows.agg(F.count("*").alias("messages"), F.count("reject_reason").alias("malformed"), F.coalesce(F.max("time_us"), F.lit(0)).alias("time_us")).first()
        base = feed.sparkSession.createDataFrame([(p, s["next"].get(str(p), 0)) for p in range(n)], "kafka_partition int, base long")
        good = rows.where(F.col("reject_reason").isNull()).select("seq", "kafka_partition", *EVENT_COLUMNS)
        numbered = running(good, ["kafka_partition"], "seq", F.lit(1), "sum", "n", inclusive=True).join(F.broadcast(base), "kafka_partition")
        numbered.withColumn("kafka_offset", F.col("base") + F.col("n") - 1).select(LOG.fieldNames()).write.mode("overwrite").parquet(f"{self.root}/batch={batch_id}")
        counts = {r.kafka_partition: r["count"] for r in good.groupBy("kafka_partition").count().collect()}
        acked = max(s["cursor_us"], total.time_us)
        self._save(
            s
            | {
                "batch": batch_id,
                "before": before,
                "next": {str(p): s["next"].get(str(p), 0) + counts.get(p, 0) for p in range(n)},
                "cursor_us": max(s["cursor_us"], holds.cap(acked) if holds else acked),
                "messages": s["messages"] + total.messages,
                "malformed": s["malformed"] + total.malformed,
                "produced": s["produced"] + sum(counts.values()),
            }
        )

    def log(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(LOG).parquet(f"{self.root}/batch=*")


def start(spark: SparkSession, feed_path: str, topic: Topic, checkpoint: str, salt: str, holds: Holds | None = None, files_per_trigger: int = 1):
    """Runs the ingester over a feed folder until all that is there is in the log; returns the query.

    An error of a write ends the query, and the next start takes its batch up again.
    """
    feed = spark.readStream.schema(FEED).option("maxFilesPerTrigger", files_per_trigger).parquet(feed_path)
    return feed.writeStream.foreachBatch(lambda df, i: topic.append(df, i, salt, holds)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def handoff(holds: Holds, connected_us: int, replay: Callable[[int, int], DataFrame], emit: Callable[[DataFrame], None], flush: Callable[[], None], sleep: Callable[[float], None] = time.sleep) -> bool:
    """Replays the span around a reconnect; copies of what is in the log already are left to the dedupe.

    The cursor is held at the start of the span until its rows are flushed. If all attempts fail the hold stays, so the
    next start reads the span again; returns whether the repair succeeded.
    """
    first, last = repair_range(connected_us)
    key = holds.add(first)
    sleep(REPAIR_WAIT_S)
    for attempt in range(1, REPAIR_ATTEMPTS + 1):
        try:
            emit(replay(first, last))
        except Exception:  # whatever the feed raises, the hold keeps the span
            if attempt < REPAIR_ATTEMPTS:
                sleep(RETRY_S * attempt)
            continue
        flush()
        holds.release(key)
        return True
    return False
