"""K1/K2/K5: the Parquet archive and JSON reports."""

from __future__ import annotations

import json
import os
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.functions.columns import event_at
from tidewake.schema import LOG

FLUSH_ROWS = 200_000


def range_path(topic: str, partition: int, first: int, last: int, first_time_us: int) -> str:
    """K2: path of a range file; its date is the UTC date of the first event."""
    day = datetime.fromtimestamp(first_time_us / 1e6, timezone.utc).date()
    return f"topic={topic}/date={day}/part-{partition}-{first:012d}-{last:012d}.parquet"


def range_paths(log: DataFrame, topic: str) -> DataFrame:
    """K2: one row per range of FLUSH_ROWS offsets of a partition, with the path of its file."""
    ranges = log.groupBy("kafka_partition", F.expr(f"kafka_offset div {FLUSH_ROWS}")).agg(F.min("kafka_offset").alias("first_offset"), F.max("kafka_offset").alias("last_offset"), F.min_by("time_us", "kafka_offset").alias("first_us"))
    day = F.date_format(event_at("first_us"), "yyyy-MM-dd")
    path = F.format_string("topic=%s/date=%s/part-%d-%012d-%012d.parquet", F.lit(topic), day, "kafka_partition", "first_offset", "last_offset")
    return ranges.select("kafka_partition", "first_offset", "last_offset", path.alias("path"))


def write_archive(log: DataFrame, root: str, topic: str) -> None:
    """K1: zstd Parquet under topic=/date=, sorted by offset.

    Files are cut by (partition, offset range), so no task holds a whole partition. Dynamic overwrite makes a
    rerun of the same days idempotent; the commit protocol stands for write, fsync and rename.
    """
    dated = log.select(LOG.fieldNames()).withColumn("topic", F.lit(topic)).withColumn("date", event_at().cast("date"))
    cut = dated.repartition("date", "kafka_partition", F.expr(f"kafka_offset div {FLUSH_ROWS}")).sortWithinPartitions("topic", "date", "kafka_partition", "kafka_offset")
    cut.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", FLUSH_ROWS).partitionBy("topic", "date").parquet(root)


def read_archive(spark: SparkSession, root: str, topic: str | None = None) -> DataFrame:
    """The archive with its partition columns; a topic or date filter prunes directories."""
    df = spark.read.parquet(root)
    return df if topic is None else df.where(F.col("topic") == topic)


def write_report(path: str, report: dict) -> None:
    """K5: writes a JSON report, whole or not at all."""
    with open(f"{path}.tmp", "w") as f:
        json.dump(report, f, indent=2, default=str)
        f.write("\n")
    os.replace(f"{path}.tmp", path)
