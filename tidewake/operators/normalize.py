"""Raw feed JSON to pseudonymised events, with a reject reason instead of a crash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewake.functions.columns import salted_hash
from tidewake.schema import EVENT_COLUMNS, RAW


def subject_did(record: Column) -> Column:
    """The account a record points at: a bare DID, or the authority of an at:// URI; else ''."""
    bare = F.get_json_object(record, "$.subject")
    uri = F.get_json_object(record, "$.subject.uri")
    of_uri = F.regexp_extract(uri, "^at://([^/]*)", 1)
    found = F.when(uri.isNotNull(), of_uri).when(bare.startswith("{"), F.lit("")).otherwise(F.coalesce(bare, F.lit("")))
    return F.when(found.startswith("did:"), found).otherwise(F.lit(""))


def normalize(raw: DataFrame, salt: str, json: str = "value") -> DataFrame:
    """EVENT columns and ``reject_reason`` (null for good rows) in place of a table's JSON column, which does not go on: it names accounts."""
    r = raw.withColumn("__r", F.from_json(json, RAW))
    did, time_us, kind, commit = (F.col(f"__r.{n}") for n in ("did", "time_us", "kind", "commit"))
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    is_commit = kind == "commit"
    missing = commit.isNull()
    for n in ("collection", "rkey", "rev", "operation"):
        missing = missing | blank(F.col(f"__r.commit.{n}"))
    reason = (
        F.when(F.col("__r").isNull() | (F.col("__r.did").isNull() & time_us.isNull() & kind.isNull()), "unreadable")
        .when(blank(did), "missing did")
        .when(F.coalesce(time_us, F.lit(0)) <= 0, "missing time")
        .when(F.coalesce(is_commit, F.lit(False)) & missing, "incomplete commit")
        .when(~F.coalesce(kind.isin("commit", "identity", "account"), F.lit(False)), "unknown kind")
    )
    part = lambda n: F.col(f"__r.commit.{n}")
    good = reason.isNull()
    subject = subject_did(F.get_json_object(json, "$.commit.record"))
    values = {
        "event_id": F.when(is_commit, salted_hash(salt, F.lit("commit"), did, part("collection"), part("rkey"), part("rev"), part("operation"))).otherwise(salted_hash(salt, kind, did, time_us.cast("string"))),
        "account_id": salted_hash(salt, F.lit("account"), did),
        "time_us": time_us,
        "kind": kind,
        "collection": F.when(is_commit, part("collection")).otherwise(""),
        "operation": F.when(is_commit, part("operation")).otherwise(""),
        "subject_account_id": F.when(is_commit & (subject != ""), salted_hash(salt, F.lit("account"), subject)).otherwise(""),
    }
    return r.withColumns({k: F.when(good, v) for k, v in values.items()} | {"reject_reason": reason}).drop("__r", json)


def split_malformed(normalised: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good events, quarantined rows with their reason)."""
    good = normalised.where(F.col("reject_reason").isNull())
    return good.select(*EVENT_COLUMNS), normalised.where(F.col("reject_reason").isNotNull())
