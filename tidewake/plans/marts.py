"""M1-M6 and Q1-Q4: staging, marts and their data-quality checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.functions.columns import event_at
from tidewake.operators.dedupe import first_by_log_order

POST, LIKE, REPOST, FOLLOW, PROFILE = "app.bsky.feed.post", "app.bsky.feed.like", "app.bsky.feed.repost", "app.bsky.graph.follow", "app.bsky.actor.profile"


def stg_events(log: DataFrame) -> DataFrame:
    """One row per event, '' as null, with its UTC time and date."""
    blank = lambda c: F.nullif(F.col(c), F.lit("")).alias(c)
    out = first_by_log_order(log).select("event_id", "account_id", blank("subject_account_id"), "kind", blank("collection"), blank("operation"), "time_us", event_at().alias("event_at"))
    return out.withColumn("event_date", F.col("event_at").cast("date"))


def stg_account_days(stg: DataFrame) -> DataFrame:
    """M1: activity of an account on a day (commits only)."""
    made = lambda c: F.count_if((F.col("collection") == c) & (F.col("operation") == "create"))
    return (
        stg.where("kind = 'commit'")
        .groupBy("account_id", "event_date")
        .agg(F.count("*").alias("events"), made(POST).alias("posts"), made(LIKE).alias("likes"), made(REPOST).alias("reposts"), made(FOLLOW).alias("follows"))
    )


def daily_active(days: DataFrame) -> DataFrame:
    """M2: DAU, trailing 7-day WAU and stickiness.

    Each account-day is dealt to the seven days it counts for, so WAU is one distinct count, not a range join.
    """
    dau = days.groupBy("event_date").agg(F.count("*").alias("dau"))
    bounds = days.agg(F.min("event_date").alias("first_day"))
    wau = days.select("account_id", F.explode(F.expr("sequence(event_date, event_date + 6)")).alias("event_date")).groupBy("event_date").agg(F.count_distinct("account_id").alias("w"))
    full = F.col("event_date") >= F.date_add("first_day", 6)
    out = dau.join(wau, "event_date", "left").crossJoin(F.broadcast(bounds)).withColumn("wau", F.when(full, F.col("w")))
    return out.select("event_date", "dau", "wau", F.round(F.col("dau").cast("double") / F.nullif(F.col("wau"), F.lit(0)), 4).alias("stickiness")).orderBy("event_date")


def engagement_daily(stg: DataFrame) -> DataFrame:
    """M3: record creates and distinct creators per day and collection."""
    made = stg.where("kind = 'commit' and operation = 'create'")
    return made.groupBy("event_date", "collection").agg(F.count("*").alias("creates"), F.count_distinct("account_id").alias("accounts")).orderBy("event_date", F.desc("creates"))


def signup_cohorts(stg: DataFrame, days: DataFrame) -> DataFrame:
    """M4: funnel per signup day. Activity before signup counts, as there is no lower bound."""
    signups = stg.where(f"collection = '{PROFILE}' and operation = 'create'").groupBy("account_id").agg(F.min("event_date").alias("signup_date"))
    received = stg.where("subject_account_id is not null and operation = 'create'").groupBy(F.col("subject_account_id").alias("account_id")).agg(F.min("event_date").alias("first_received"))
    bounds = days.agg(F.min("event_date").alias("first_day"), F.max("event_date").alias("last_day"))
    d, s = F.col("event_date"), F.col("signup_date")
    flags = (
        signups.join(days.select("account_id", "event_date", "posts"), "account_id", "left")
        .groupBy("account_id", "signup_date")
        .agg(
            F.coalesce(F.bool_or((F.col("posts") > 0) & (d <= F.date_add(s, 6))), F.lit(False)).alias("posted"),
            F.coalesce(F.bool_or(d == F.date_add(s, 1)), F.lit(False)).alias("day1"),
            F.coalesce(F.bool_or(d == F.date_add(s, 7)), F.lit(False)).alias("day7"),
        )
    )
    return (
        flags.join(received, "account_id", "left")
        .crossJoin(F.broadcast(bounds))
        .where("signup_date > first_day")
        .groupBy("signup_date", "last_day")
        .agg(
            F.count("*").alias("signups"),
            F.count_if("posted").alias("posted_within_7d"),
            F.count_if(F.col("first_received") <= F.date_add(s, 6)).alias("received_engagement_within_7d"),
            F.count_if("day1").alias("returned_day_1"),
            F.count_if("day7").alias("d7"),
        )
        .withColumn("day_7_observable", F.date_add(s, 7) <= F.col("last_day"))
        .select("signup_date", "signups", "posted_within_7d", "received_engagement_within_7d", "returned_day_1", F.when(F.col("day_7_observable"), F.col("d7")).alias("returned_day_7"), "day_7_observable")
        .orderBy("signup_date")
    )


def capture_gaps(stg: DataFrame, share: float = 0.2) -> DataFrame:
    """M5: minutes with strictly less than ``share`` of the median minute; the first and last minute are left out."""
    minutes = stg.groupBy(F.date_trunc("minute", "event_at").cast("timestamp_ntz").alias("minute")).agg(F.count("*").alias("events"))
    ends = minutes.agg(F.min("minute").alias("lo"), F.max("minute").alias("hi"))
    trimmed = minutes.crossJoin(F.broadcast(ends)).where("minute > lo and minute < hi").select("minute", "events")
    stats = trimmed.agg(F.min("minute").alias("lo"), F.max("minute").alias("hi"), F.median("events").alias("median_minute"))
    every = stats.select(F.explode(F.expr("sequence(lo, hi, interval 1 minute)")).alias("minute"), "median_minute")
    out = every.join(trimmed, "minute", "left").withColumn("events", F.coalesce("events", F.lit(0).cast("long")))
    return out.where(F.col("events") < share * F.col("median_minute")).select("minute", "events", "median_minute").orderBy("minute")


def unique(df: DataFrame, *cols: str) -> DataFrame:
    """Q1/Q2: key values with more than one row."""
    return df.groupBy(*cols).agg(F.count("*").alias("n")).where("n > 1")


def quality_checks(stg: DataFrame, days: DataFrame, cohorts: DataFrame) -> DataFrame:
    """Q1-Q4: one row per check with the number of failing rows."""
    nulls = {c: stg.where(F.col(c).isNull()) for c in ("event_id", "account_id", "time_us")}
    funnel = cohorts.where("posted_within_7d > signups or received_engagement_within_7d > signups or returned_day_1 > signups or coalesce(returned_day_7, 0) > signups")
    checks = {"unique_event_id": unique(stg.where("event_id is not null"), "event_id")} | {f"not_null_{c}": d for c, d in nulls.items()}
    checks |= {"unique_account_days": unique(days, "account_id", "event_date"), "not_null_signups": cohorts.where("signups is null"), "funnel_steps": funnel}
    return reduce(DataFrame.unionByName, [d.agg(F.count("*").alias("failures")).select(F.lit(n).alias("check_name"), "failures") for n, d in checks.items()])
