"""A corpus made ready for training: each stage works on all that its predecessor kept.

Quality, near-duplicates, benchmark leaks and secrets are dealt with in that order and the rest is
encoded. A stage's result is written to the shared folder and read back, so a lost executor costs
one stage's tasks and no stage is worked out twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.llm import bpe, decontaminate, near_dups, quality_model, secret_spans
from shiplens.llm.queries import vocabulary_file
from shiplens.llm.rows import table
from shiplens.sources.scratch import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier rejects go."""
    return quality_model.select(docs, table(spark, sf_dir, "labels")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays. Its rows are one where id and text are repeated; rows of
    one id with different texts stay, as do rows without id."""
    kept = materialise(near_dups.near_duplicates(docs).where("kept AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.count("*").alias("rows")), "kept")
    once = docs.join(kept.where("rows = 1"), "doc_id", "left_semi").select(docs.columns)
    more = docs.join(kept.where("rows > 1"), "doc_id", "left_semi").select(docs.columns)
    return once.union(more.dropDuplicates(["doc_id", "text"])).union(docs.where("doc_id IS NULL"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; the length follows the text."""
    scanned = secret_spans.scan(docs, spans_col="_spans", redacted_col="_masked")
    found = F.size("_spans") > 0
    return scanned.withColumns({
        "text": F.col("_masked"),
        "n_chars": F.when(found, F.length("_masked").cast("long")).otherwise(F.col("n_chars")),
    }).select(docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, vocabulary_file())


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("secrets", secrets), ("encoding", encoding),
]
#: The classifier's fit has no restatement in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
