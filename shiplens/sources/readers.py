"""Inputs: CSV, JSON, Parquet, mini-batches of files, staged output, document folders."""

from __future__ import annotations

from collections import defaultdict
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplens.functions.values import clean_missing
from shiplens.operators.contract import ContractViolation


def read_csv(
    spark: SparkSession, path: str | list[str], *, multiline: bool = False
) -> DataFrame:
    """Every column as text, missing tokens as null: casting is the contract's work.

    Files stay splittable unless `multiline` says quoted fields hold line breaks.
    """
    raw = (
        spark.read.option("header", True).option("escape", '"')
        .option("multiLine", multiline).option("enforceSchema", False).csv(path)
    )
    return clean_missing(raw)


def read_json_object(spark: SparkSession, path: str) -> DataFrame:
    """A document that must be one JSON object, as one row."""
    text = spark.read.text(path, wholetext=True)
    found = text.select("value", F.ltrim(F.regexp_replace("value", r"^\s+", "")).alias("t"))
    wrong = found.where(
        ~F.col("t").startswith("{") | F.try_parse_json("value").isNull()
    ).limit(1).count()
    if wrong:
        raise ContractViolation(f"{path} does not hold a JSON object")
    return spark.read.json(path, multiLine=True)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet or CSV, told apart by suffix."""
    return spark.read.parquet(path) if path.endswith(".parquet") else read_csv(spark, path)


def first_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, line) of every file that has a line, read on the executors: each task keeps one line of
    each file it has a part of, and a file's parts are told apart by where they begin."""
    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("path"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n")).alias("at"))
    return lines.groupBy("path").agg(F.min_by("value", "at").alias("line"))


def read_batch(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A mini-batch of files as one table, matched by column name.

    Headers are found in one pass over all text files, and files with the same one share a scan, so
    neither the driver's work nor the plan grows with the number of files. Parquet files are one scan,
    whose columns Spark merges. Files without any column are skipped.
    """
    tables = [p for p in paths if p.endswith(".parquet")]
    texts = [p for p in paths if not p.endswith(".parquet")]
    layouts: dict[str, list[str]] = defaultdict(list)
    if texts:  # a name and a line for each file, as the caller gave them
        for row in first_lines(spark, texts).where(F.trim("line") != "").collect():
            layouts[row["line"]].append(unquote(row["path"]))
    parts = [read_csv(spark, sorted(files)) for _, files in sorted(layouts.items())]
    if tables:
        parts.append(spark.read.option("mergeSchema", True).parquet(*tables))
    if not parts:
        raise ContractViolation("No file in the batch has any column")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def read_staged(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Headerless, space-delimited, quoted rows with an exact number of fields."""
    schema = T.StructType(
        [T.StructField(c, T.StringType()) for c in [*columns, "_corrupt_record"]]
    )
    staged = (
        spark.read.schema(schema).option("sep", " ").option("escape", '"')
        .option("mode", "PERMISSIVE").option("columnPruning", False).csv(path)
    )
    counts = staged.agg(
        F.count("*").alias("rows"), F.count("_corrupt_record").alias("bad"),
        F.max(columns[0]),
    ).first()
    if not counts["rows"]:
        raise ContractViolation(f"{path} is empty")
    if counts["bad"]:
        raise ContractViolation(
            f"{counts['bad']} rows of {path} do not have {len(columns)} fields"
        )
    return staged.select(*columns)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(filename, text) of every file in a folder. Markdown is read; the text of any other format
    is null, which `unreadable_documents` reports, and its content isn't loaded."""
    name = F.element_at(F.split("path", "/"), -1)
    markdown = F.lower(name).endswith(".md")
    read = spark.read.format("binaryFile").option("pathGlobFilter", "*.[mM][dD]").load(folder).select(
        name.alias("filename"), F.col("content").cast("string").alias("text"))
    others = spark.read.format("binaryFile").load(folder).where(~markdown)
    return read.union(others.select(name, F.lit(None).cast("string")))


def unreadable_documents(documents: DataFrame) -> DataFrame:
    """(rule, filename) of documents that no reader takes."""
    return documents.where(F.col("text").isNull()).select(
        F.lit("unreadable_format").alias("rule"), "filename")


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.option("ignoreNullFields", False).json(path)
