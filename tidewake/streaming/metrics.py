"""Apply statistics, stream metrics and health rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def apply_stats(log: DataFrame, classified: DataFrame, next_offsets: DataFrame | None = None) -> DataFrame:
    """Per partition: applied, skipped (already applied offsets), new, duplicates and late."""
    if next_offsets is None:
        per = log.withColumn("skip", F.lit(False))
    else:
        per = log.join(F.broadcast(next_offsets), "kafka_partition", "left").withColumn("skip", F.col("kafka_offset") < F.coalesce("next_offset", F.lit(0)))
    a = per.groupBy("kafka_partition").agg(F.count_if(~F.col("skip")).alias("applied"), F.count_if("skip").alias("skipped"))
    b = classified.groupBy("kafka_partition").agg(F.count("*").alias("new_events"), F.count_if("late").alias("late"))
    return a.join(b, "kafka_partition", "left").na.fill(0).withColumn("duplicates", F.col("applied") - F.col("new_events"))


def health(metrics: DataFrame) -> DataFrame:
    """K7: one row per probe sample (ingest_per_s, consume_per_s, lag_s, undecodable, disk_used) with its alerts."""
    rules = {
        "ingest below 100/s": F.col("ingest_per_s") < 100,
        "consume below half of ingest": F.col("consume_per_s") < 0.5 * F.col("ingest_per_s"),
        "lag above 60 s": F.col("lag_s") > 60,
        "undecodable records": F.col("undecodable") > 0,
        "disk above 80 %": F.col("disk_used") > 0.8,
    }
    return metrics.withColumn("alerts", F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]), lambda x: x.isNotNull()))


class ProgressMetrics(StreamingQueryListener):
    """K6: running counters of a query, read from its progress events."""

    def __init__(self):
        self.counters = {"batches": 0, "input_rows": 0, "state_rows": 0, "failures": 0}

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.counters["batches"] += 1
        self.counters["input_rows"] += p.numInputRows
        self.counters["state_rows"] = sum(s.numRowsTotal for s in p.stateOperators)

    def onQueryTerminated(self, event):
        self.counters["failures"] += event.exception is not None
