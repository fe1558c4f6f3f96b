"""A training-corpus pipeline: toxic documents go, repeated passages and near copies go, leaked passages go, the rest is packed.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written as Parquet and read again as the next stage's
documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.llm.common import ROW, with_row_ids, written
from tidewake.llm.decontamination import decontaminate
from tidewake.llm.line_dedup import line_runs
from tidewake.llm.ngram_join import ngram_join
from tidewake.llm.packing import packing
from tidewake.llm.toxicity import toxicity

#: Near copies here share four fifths of their five-word shingles.
SHINGLE_WORDS, PERCENT = 5, 80


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the toxicity model accepts.

    Every row is judged by its own text, also one without a doc_id or with a doc_id that another row has, so repeated
    rows go or stay together. Null and empty texts are accepted; an empty table stays empty.
    """
    return toxicity(docs, _table(spark, sf_dir, "labels"), carry=True).where("predicted = 0").select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of lines that earlier rows have, by content-defined chunks and the pairs of lines inside distinct ones; a row that loses all its lines that way goes.

    Earlier is by doc_id; rows without one, or that share one but not the text, come after all others, by a hash of both. Rows
    with equal doc_id and text count as one place, so they lose the same lines and neither loses any to the other. Null
    and empty texts stay as they are; an empty table stays empty.
    """
    plain = [c for c in docs.columns if c not in ("text", "n_chars")]
    keyed = with_row_ids(docs)
    out = line_runs(keyed.select(F.col(ROW).alias("doc_id"), "text", F.struct(F.col("n_chars").alias("n_chars"), F.struct(*plain).alias("rest")).alias("own")), carry="own")
    out = out.where("n_removed = 0 or n_removed < n_lines")
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col("own.n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.select("own.rest.*", F.col("kept").alias("text"), n_chars.alias("n_chars")).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the least doc_id.

    Rows without a doc_id, or that share one but not the text, are documents of their own and come after all others (by a
    hash of both); of rows with equal doc_id and text one stays. Texts without words are in no group.
    """
    keyed = with_row_ids(docs)
    joined = ngram_join(keyed.select(F.col(ROW).alias("doc_id"), "text"), SHINGLE_WORDS, PERCENT)
    rows = joined.groupBy(F.col("doc_id").alias(ROW)).agg(F.min("component_id").alias("c"), F.count("*").alias("n"))
    kept = written(rows.where(f"{ROW} = c").select(ROW, "n"), "kept")
    stay = keyed.join(kept, ROW).select(*docs.columns, ROW, "n")
    return stay.where("n = 1").select(*docs.columns).unionByName(stay.where("n > 1").dropDuplicates([ROW]).select(*docs.columns))


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no passage of the benchmark.

    Every row is judged by its own text, also one without a doc_id or with a doc_id that another row has. Null and empty
    texts hold none; an empty table stays empty, and with an empty benchmark every row stays.
    """
    keyed = with_row_ids(docs)
    leaked = decontaminate(keyed.select(F.col(ROW).alias("doc_id"), "text"), _table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias(ROW)).distinct()
    return keyed.join(leaked, ROW, "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every row that is left, and its place in a sequence; null and empty texts are an end id alone."""
    return packing(docs)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("ngram_join", one_of_each_group), ("decontamination", drop_leaked), ("packing", pack)]

#: SQL cannot express the learnt and the genetic stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
