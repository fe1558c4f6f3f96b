"""Comparing logs and tables."""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.schema import MINUTE_US


def id_stats(log: DataFrame) -> DataFrame:
    """Copies and time of each event id."""
    return log.groupBy("event_id").agg(F.count("*").alias("copies"), F.min("time_us").alias("time_us"))


def shared_window(ref: DataFrame, test: DataFrame, margin_us: int = 10_000_000) -> DataFrame:
    """V1: one row (lo, hi): the inclusive time span that both logs cover, less a margin at each end; empty if there is none."""
    ends = lambda d, p: d.agg(F.min("time_us").alias(f"{p}lo"), F.max("time_us").alias(f"{p}hi"))
    return ends(ref, "r").crossJoin(ends(test, "t")).select((F.greatest("rlo", "tlo") + margin_us).alias("lo"), (F.least("rhi", "thi") - margin_us).alias("hi")).where("hi > lo")


def _inside(df: DataFrame, window: DataFrame) -> DataFrame:
    return df.crossJoin(F.broadcast(window)).where(F.col("time_us").between(F.col("lo"), F.col("hi"))).drop("lo", "hi")


def missing(ref: DataFrame, test: DataFrame, window: DataFrame) -> DataFrame:
    """V2: reference ids inside the window with no copy anywhere in the other log."""
    return _inside(id_stats(ref), window).join(test.select("event_id"), "event_id", "left_anti").select("event_id", "time_us")


def extra(ref: DataFrame, test: DataFrame, window: DataFrame) -> DataFrame:
    """V3: ids inside the window that the reference lacks."""
    return missing(test, ref, window)


def duplicates(ref: DataFrame, test: DataFrame, window: DataFrame) -> DataFrame:
    """V4: records beyond the first of each id: the reference over its whole log, the other in the window."""
    over = lambda s, n: s.agg((F.coalesce(F.sum("copies"), F.lit(0)) - F.count("*")).alias(n))
    return over(id_stats(ref), "ref_duplicates").crossJoin(over(_inside(id_stats(test), window), "test_duplicates"))


def table_diff(baseline: dict[str, DataFrame], candidate: dict[str, DataFrame]) -> DataFrame:
    """Per table, the rows that only one side has (multiset difference both ways).

    One tagged aggregation per table gives both directions; two EXCEPT ALLs would shuffle each side twice.
    """
    rows = []
    for name, b in baseline.items():
        cols = b.columns
        c = candidate[name].select(*cols)
        net = b.withColumn("__n", F.lit(1)).unionByName(c.withColumn("__n", F.lit(-1))).groupBy(*cols).agg(F.sum("__n").alias("__n"))
        rows.append(net.agg(F.coalesce(F.sum(F.greatest("__n", F.lit(0))), F.lit(0)).cast("long").alias("only_in_baseline"), F.coalesce(F.sum(F.greatest(-F.col("__n"), F.lit(0))), F.lit(0)).cast("long").alias("only_in_candidate")).select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, rows)


def run_totals(state: DataFrame, seen: DataFrame) -> DataFrame:
    """V6: records, unique events and duplicates (malformed records count as duplicates)."""
    return state.agg(F.sum("next_offset").alias("records")).crossJoin(seen.agg(F.count("*").alias("unique_events"))).withColumn("duplicates", F.col("records") - F.col("unique_events"))


def whole_minutes(window: DataFrame) -> DataFrame:
    """V7: first and last whole minute of a window (lo rounded up, hi rounded down less a minute)."""
    return window.select(F.expr(f"(lo + {MINUTE_US - 1}) div {MINUTE_US} * {MINUTE_US}").alias("lo"), F.expr(f"hi div {MINUTE_US} * {MINUTE_US} - {MINUTE_US}").alias("hi"))


def late_reconciliation(ref: DataFrame, test: DataFrame, late: DataFrame, minutes: DataFrame | None = None) -> DataFrame:
    """V8: per reference minute, events of both runs and the late ones; reconciled if ref = test + late."""
    per = lambda d, n: d.groupBy("minute_us").agg(F.sum("events").alias(n))
    out = per(ref, "ref_n").join(per(test, "test_n"), "minute_us", "left").join(per(late, "late_n"), "minute_us", "left").na.fill(0, ["test_n", "late_n"])
    if minutes is not None:
        out = out.crossJoin(F.broadcast(minutes)).where(F.col("minute_us").between(F.col("lo"), F.col("hi"))).drop("lo", "hi")
    return out


def verdict(diff: DataFrame, reconciliation: DataFrame, late_total: int, reference_rows_differ: bool) -> bool:
    """V9: fails if a table differs between the runs, a minute does not reconcile, or the reference's rows differ with no late event to explain it."""
    differing = diff.agg(F.coalesce(F.sum(F.col("only_in_baseline") + F.col("only_in_candidate")), F.lit(0)).alias("n")).first().n
    unreconciled = reconciliation.where("ref_n <> test_n + late_n").limit(1).count()
    return differing == 0 and unreconciled == 0 and not (late_total == 0 and reference_rows_differ)


def wait_until_applied(applied, end: int, *, timeout_s: float = 60.0, poll_s: float = 0.5) -> int:
    """Polls ``applied()`` (sum of next offsets) until it reaches ``end``; raises TimeoutError."""
    until = time.monotonic() + timeout_s
    while (got := applied()) < end:
        if time.monotonic() > until:
            raise TimeoutError(f"{got} of {end} records applied")
        time.sleep(poll_s)
    return got
