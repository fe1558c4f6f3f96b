"""The file-backed event log: building it from the ``events`` table, and its scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.functions.columns import micros
from tidewake.operators.prefix import running
from tidewake.schema import LOG

PARTITIONS = 6


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as they arrive: every 11th is late by 25 places, every 7th is replayed 40 places later."""
    base = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").alias("eid"),
        F.col("user_id").alias("uid"),
        micros("ts").alias("time_us"),
        F.col("event_type").alias("et"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
    )
    # one scan: a replayed event is exploded into its two copies instead of being read again for a union
    return base.withColumn("cp", F.explode(F.when(F.col("eid") % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).withColumn(
        "arrival", F.col("eid") + F.when(F.col("cp") == 1, 40).when(F.col("eid") % 11 == 0, 25).otherwise(0)
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: the log, keyed by account so that all events of an account are in one partition, in arrival order."""
    a = arrivals(spark, sf_dir).withColumn("kafka_partition", (F.col("uid") % PARTITIONS).cast("int"))
    ranked = running(a, ["kafka_partition"], "arrival", F.lit(1), "sum", "n", inclusive=True, order=["arrival", "cp", "eid"])
    et, k = F.col("et"), F.col("k")
    return ranked.select(
        F.col("eid").cast("string").alias("event_id"),
        F.col("uid").cast("string").alias("account_id"),
        "time_us",
        F.when(et == "error", "identity").otherwise("commit").alias("kind"),
        F.when(et == "view", "app.bsky.feed.like").when(et == "click", "app.bsky.feed.repost").when(et == "purchase", "app.bsky.feed.post").when(et == "signup", "app.bsky.actor.profile").otherwise("").alias("collection"),
        F.when(et == "error", "").when(k % 10 == 0, "delete").when(k % 10 == 1, "update").otherwise("create").alias("operation"),
        F.when(et.isin("view", "click"), k.cast("string")).otherwise("").alias("subject_account_id"),
        "kafka_partition",
        (F.col("n") - 1).alias("kafka_offset"),
    )


def scan_from(log: DataFrame, next_offsets: DataFrame) -> DataFrame:
    """Records at or after the stored next offset of their partition (0 where none is stored)."""
    return log.join(F.broadcast(next_offsets.select("kafka_partition", "next_offset")), "kafka_partition", "left").where(F.col("kafka_offset") >= F.coalesce("next_offset", F.lit(0))).drop("next_offset")


def scan_range(log: DataFrame, first: int, end: int) -> DataFrame:
    """Records with first <= offset < end; the filter reaches the scan."""
    return log.where((F.col("kafka_offset") >= first) & (F.col("kafka_offset") < end))


def end_offsets(log: DataFrame) -> DataFrame:
    """End offset (last + 1) and record count of each partition."""
    return log.groupBy("kafka_partition").agg((F.max("kafka_offset") + 1).alias("end_offset"), F.count("*").alias("records"))


def replay_range(feed: DataFrame, cursor_us: int, to_us: int, order: str = "seq") -> DataFrame:
    """S3: feed messages in order from the cursor up to, not with, the first one later than ``to_us``.

    A message without a readable time is passed on.
    """
    tail = feed.where(F.col("time_us").isNull() | (F.col("time_us") >= cursor_us))
    stop = tail.where(F.col("time_us") > to_us).agg(F.min(order).alias("__stop"))
    return tail.crossJoin(F.broadcast(stop)).where(F.col("__stop").isNull() | (F.col(order) < F.col("__stop"))).drop("__stop")


def with_markers(feed: DataFrame, connections: DataFrame) -> DataFrame:
    """A ``connected`` marker row (resume cursor > 0 only) before the first message of each connection.

    feed: (seq, connection, time_us); connections: (connection, cursor_us).
    """
    marks = feed.groupBy("connection").agg(F.min("seq").alias("seq")).join(connections, "connection").where(F.col("cursor_us") > 0)
    marks = marks.select("seq", F.lit(0).alias("slot"), F.lit("connected").alias("item"), F.col("cursor_us").alias("time_us"))
    return marks.unionByName(feed.select("seq", F.lit(1).alias("slot"), F.lit("data").alias("item"), "time_us"))


def write_log(log: DataFrame, path: str, **options) -> None:
    """K3: writes the log partitioned by log partition, sorted by offset inside."""
    log.select(LOG.fieldNames()).repartition("kafka_partition", F.expr("kafka_offset div 1000000")).sortWithinPartitions("kafka_partition", "kafka_offset").write.partitionBy("kafka_partition").options(compression="zstd", **options).mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG).parquet(path)


def kafka_source(spark: SparkSession, servers: str, topic: str, starting: str = "earliest") -> DataFrame:
    """Optional live source; needs the public Kafka connector on the class path."""
    return spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", starting).load()
