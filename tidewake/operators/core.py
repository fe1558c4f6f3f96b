"""The pure batch core: per-partition watermark, late events, minute counts and sessions.

All results follow arrival order (log offsets), so they equal what a sequential reader of each
partition would compute; Spark's own watermark and session_window follow event time and do not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.functions.columns import minute_us
from tidewake.operators.dedupe import first_by_log_order
from tidewake.operators.prefix import running
from tidewake.schema import LogicConfig
from tidewake.sources.scratch import written


def with_lateness(unique: DataFrame, cfg: LogicConfig) -> DataFrame:
    """Adds ``late``: strictly older than the running max of the partition less the allowance."""
    w = running(unique, ["kafka_partition"], "kafka_offset", F.col("time_us"), "max", "__wm", inclusive=False)
    return w.withColumn("late", F.coalesce((F.col("__wm") > 0) & (F.col("time_us") < F.col("__wm") - cfg.late_us), F.lit(False))).drop("__wm")


def classified(log: DataFrame, cfg: LogicConfig) -> DataFrame:
    """Unique events in log order with their lateness; the unique events are written once, as running aggregates read them twice."""
    return with_lateness(written(first_by_log_order(log), "unique"), cfg)


def late_minute(events: DataFrame) -> DataFrame:
    """Late events per minute."""
    return events.where("late").groupBy(minute_us().alias("minute_us")).agg(F.count("*").alias("events"))


def engagement_minute(events: DataFrame) -> DataFrame:
    """On-time events per minute, kind, collection and operation."""
    return events.where("not late").groupBy(minute_us().alias("minute_us"), "kind", "collection", "operation").agg(F.count("*").alias("events"))


def partition_state(log: DataFrame, events: DataFrame) -> DataFrame:
    """Next offset and watermark of each partition."""
    ends = log.groupBy("kafka_partition").agg((F.max("kafka_offset") + 1).alias("next_offset"))
    marks = events.where("not late").groupBy("kafka_partition").agg(F.max("time_us").alias("watermark_us"))
    return ends.join(marks, "kafka_partition", "left").withColumn("watermark_us", F.coalesce("watermark_us", F.lit(0).cast("long")))


def numbered_sessions(events: DataFrame, cfg: LogicConfig) -> DataFrame:
    """On-time events with the number of their account's session.

    The last event time of an open session is the running max of the account, since events that join
    before the start or are session-late lie below it.
    """
    on = events.where("not late")
    keys = ["account_id", "kafka_partition"]
    on = running(on, keys, "kafka_offset", F.col("time_us"), "max", "__am", inclusive=False)
    on = written(on, "marked")
    brk = F.coalesce((F.col("time_us") - F.col("__am") > cfg.gap_us).cast("long"), F.lit(0).cast("long"))
    return running(on.withColumn("__b", brk), keys, "kafka_offset", F.col("__b"), "sum", "session_no", inclusive=True).drop("__am", "__b")


def _folded(numbered: DataFrame, cfg: LogicConfig) -> DataFrame:
    """Sessions when late > gap: a fold in arrival order, since acceptance depends on the running start.

    One session's times are gathered in an array, so memory is bounded by the longest session.
    """
    per = numbered.groupBy("account_id", "kafka_partition", "session_no").agg(F.array_sort(F.collect_list(F.struct("kafka_offset", "time_us"))).alias("ev"))
    t = "x.time_us"
    fold = (
        f"aggregate(slice(ev, 2, size(ev)), named_struct('s', ev[0].time_us, 'e', ev[0].time_us, 'n', 1L, 'r', 0L), (a, x) -> "
        f"if({t} >= a.s - {cfg.gap_us}L, named_struct('s', least(a.s, {t}), 'e', greatest(a.e, {t}), 'n', a.n + 1L, 'r', a.r), named_struct('s', a.s, 'e', a.e, 'n', a.n, 'r', a.r + 1L)))"
    )
    return per.withColumn("f", F.expr(fold)).select("account_id", "kafka_partition", "session_no", F.col("f.s").alias("start_us"), F.col("f.e").alias("end_us"), F.col("f.n").alias("events"), F.col("f.r").alias("rejected"))


def all_sessions(events: DataFrame, cfg: LogicConfig) -> DataFrame:
    """Every session with ``open`` (the account's last one) and its session-late count."""
    numbered = numbered_sessions(events, cfg)
    if cfg.disjoint_sessions:
        out = numbered.groupBy("account_id", "kafka_partition", "session_no").agg(F.min("time_us").alias("start_us"), F.max("time_us").alias("end_us"), F.count("*").alias("events")).withColumn("rejected", F.lit(0).cast("long"))
    else:
        out = _folded(numbered, cfg)
    out = written(out, "sessions")
    last = out.groupBy("account_id").agg(F.max("session_no").alias("__last"))
    return out.join(last, "account_id").withColumn("open", F.col("session_no") == F.col("__last")).drop("__last")


def sessions_closed(sessions: DataFrame, cfg: LogicConfig | None = None) -> DataFrame:
    """Closed sessions. A clash of (account_id, start_us), possible when late > gap, raises at run time."""
    out = sessions.where("not open").select("account_id", "start_us", "end_us", "events")
    if cfg is None or cfg.disjoint_sessions:
        return out
    clash = out.groupBy("account_id", "start_us").agg(F.count("*").alias("__n"))
    return out.join(clash, ["account_id", "start_us"]).withColumn("events", F.when(F.col("__n") > 1, F.raise_error(F.lit("two sessions of an account share a start: late > gap")).cast("long")).otherwise(F.col("events"))).drop("__n")


def account_state(sessions: DataFrame) -> DataFrame:
    """The open session of each account."""
    return sessions.where("open").select("account_id", "start_us", F.col("end_us").alias("last_us"), "events")


def session_late(sessions: DataFrame) -> DataFrame:
    """Session-late events per partition; only partitions that have some."""
    return sessions.groupBy("kafka_partition").agg(F.sum("rejected").alias("events")).where("events > 0")
