"""Exploration tables: outcome shares, periods, missingness, distributions, correlations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.operators.contract import DEPLOYMENTS, TableContract
from shiplens.operators.features import DERIVED, risk_label
from shiplens.operators.prefix import exact_quantiles


def contract_summary(df: DataFrame, contract: TableContract = DEPLOYMENTS) -> DataFrame:
    """Rows, distinct dates, date span and surplus rows per repeated key."""
    dates = df.groupBy(contract.date).agg(F.count("*").alias("n")).agg(
        F.sum("n").alias("rows"), F.count(contract.date).alias("unique_dates"),
        F.min(contract.date).alias("date_start"), F.max(contract.date).alias("date_end"),
    )
    repeats = df.groupBy(contract.key).agg((F.count("*") - 1).alias("n")).agg(
        F.sum("n").alias("duplicates")
    )
    return dates.withColumn("duplicates", repeats.scalar())


def shares(df: DataFrame, column: str) -> DataFrame:
    """(value, rows, share); the total is a scalar, not a window over the rows."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))
    total = df.agg(F.count("*").alias("n")).scalar()
    return counts.withColumn("share", F.col("rows") / total)


def risk_by_period(
    df: DataFrame, period: str, contract: TableContract = DEPLOYMENTS
) -> DataFrame:
    return df.groupBy(F.date_trunc(period, contract.date).alias("period")).agg(
        F.count("*").alias("rows"), F.avg(risk_label(F.col(contract.outcome))).alias("risk_rate")
    )


def category_profile(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """(column, unique_values, missing_rows, most_common); ties go to the lowest value."""
    entries = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for c in columns
    ])
    counts = df.select(F.inline(entries)).groupBy("column", "value").agg(
        F.count("*").alias("n")
    )
    return counts.groupBy("column").agg(
        F.count("*").alias("unique_values"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing_rows"),
        F.min(F.struct((-F.col("n")).alias("n"), "value"))["value"].alias("most_common"),
    )


def describe(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max) with exact quartiles."""
    wide = df.agg(*[
        F.struct(
            F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
            F.min(c).alias("min"), F.max(c).alias("max"),
        ).alias(c) for c in columns
    ])
    basic = wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), f"{c}.count", f"{c}.mean", f"{c}.std",
                 f"{c}.min", f"{c}.max") for c in columns
    ])))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).groupBy("column").agg(*[
        F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(name)
        for p, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
    ])
    return basic.join(F.broadcast(quartiles), "column", "left")  # one row per column


def correlations(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """(left, right, correlation) over rows where both are present, in one pass."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"),
                 F.col(f"p{i}").alias("correlation")) for i, (a, b) in enumerate(pairs)
    ])))


def derived_summary(df: DataFrame, columns: list[str] | tuple[str, ...] = DERIVED) -> DataFrame:
    wide = df.agg(*[
        F.struct(F.count_if(F.col(c).isNull()).alias("missing"), F.avg(c).alias("mean"),
                 F.min(c).alias("minimum"), F.max(c).alias("maximum")).alias(c)
        for c in columns
    ])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), f"{c}.missing", f"{c}.mean", f"{c}.minimum",
                 f"{c}.maximum") for c in columns
    ])))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))
