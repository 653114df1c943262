"""Feature derivation: signed version jumps, interactions, the label, leakage drop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplens.functions.flags import (
    corpus_flag_conditions, emergency_without_window, raised, touched,
)
from shiplens.functions.versions import jump_band, major, major_jump
from shiplens.operators.contract import DEPLOYMENTS, ContractViolation, TableContract, validate

LABEL = "deployment_risk"
DERIVED = (
    "major_version_jump", "major_version_changed", "emergency_no_maintenance",
    "core_system_touched",
)
MAX_PARSE_FAILURE_RATE = 0.01


def risk_label(outcome: Column) -> Column:
    """1 for every outcome other than SUCCESS, a missing one included."""
    return F.when(outcome.eqNullSafe(F.lit("SUCCESS")), 0).otherwise(1)


def _unparsed(contract: TableContract) -> Column:
    current, target = contract.versions
    return major(F.col(current)).isNull() | major(F.col(target)).isNull()


def parse_failures(df: DataFrame, contract: TableContract = DEPLOYMENTS) -> DataFrame:
    """One row: rows, rows whose major version does not parse, and their rate."""
    return df.agg(
        F.count("*").alias("rows"), F.count_if(_unparsed(contract)).alias("failures"),
    ).withColumn("rate", F.try_divide(F.col("failures"), F.col("rows")))


def unparsed_rows(df: DataFrame, contract: TableContract = DEPLOYMENTS) -> DataFrame:
    return df.where(_unparsed(contract)).select(contract.key, *contract.versions)


def deployment_flags(df: DataFrame, contract: TableContract = DEPLOYMENTS) -> DataFrame:
    """Validated rows with `active_flags` and `transition_class`, as retrieval takes them."""
    return validate(df, contract).withColumns({
        "active_flags": raised(corpus_flag_conditions()),
        "transition_class": jump_band(F.col("version_jump_magnitude")),
    })


def require_parseable(df: DataFrame, contract: TableContract = DEPLOYMENTS) -> None:
    row = parse_failures(df, contract).first()
    if row["rows"] and row["failures"] / row["rows"] > MAX_PARSE_FAILURE_RATE:
        raise ContractViolation(
            f"Major version does not parse for {row['failures']} of {row['rows']} "
            f"training rows", unparsed_rows(df, contract),
        )


def derive(df: DataFrame, contract: TableContract = DEPLOYMENTS) -> DataFrame:
    """Derived features added, ids (but the key), versions and leakage dropped."""
    current, target = (F.col(c) for c in contract.versions)
    jump = major_jump(current, target)
    added = {
        "major_version_jump": jump,
        "major_version_changed": (jump != 0).cast("double"),
        "emergency_no_maintenance": emergency_without_window().cast("double"),
        "core_system_touched": (
            touched("kernel_touched") | touched("bootloader_touched")
        ).cast("double"),
    }
    if contract.outcome in df.columns:
        added[LABEL] = risk_label(F.col(contract.outcome))
    unsafe = [c for c in (*contract.ids, *contract.leakage, *contract.versions)
              if c != contract.key]
    return df.withColumns(added).drop(*unsafe)


def model_inputs(df: DataFrame, contract: TableContract = DEPLOYMENTS) -> DataFrame:
    return df.drop(contract.date, contract.outcome, LABEL)


def feature_profile(df: DataFrame, contract: TableContract = DEPLOYMENTS) -> DataFrame:
    """(section, name, value, n): nulls, outcomes, vocabulary, label rate, rows.

    `df` is the derived training frame. Two jobs' worth of work whatever its width: one
    global aggregation for the counts and one grouped count for the vocabularies.
    """
    numeric = [*contract.numeric, *DERIVED]
    features = [*contract.categorical, *numeric]
    totals = df.agg(
        F.count("*").alias("rows"), F.avg(LABEL).alias("rate"),
        *[F.count_if(F.col(c).isNull()).cast("double").alias(c) for c in features],
    )
    counts = totals.select(F.explode(F.array(
        F.struct(F.lit("rows").alias("section"), F.lit("rows").alias("name"),
                 F.lit(None).cast("string").alias("value"),
                 F.col("rows").cast("double").alias("n")),
        F.struct(F.lit("label_rate").alias("section"), F.lit(LABEL).alias("name"),
                 F.lit(None).cast("string").alias("value"), F.col("rate").alias("n")),
        F.struct(F.lit("firmware_parse_failures").alias("section"),
                 F.lit("major_version_jump").alias("name"),
                 F.lit(None).cast("string").alias("value"),
                 F.col("major_version_jump").alias("n")),
        *[F.struct(F.lit("nulls").alias("section"), F.lit(c).alias("name"),
                   F.lit(None).cast("string").alias("value"), F.col(c).alias("n"))
          for c in features],
    )).alias("s")).select("s.*")
    tagged = df.select(F.explode(F.array(
        F.struct(F.lit("outcome").alias("section"), F.lit(contract.outcome).alias("name"),
                 F.col(contract.outcome).alias("value")),
        *[F.struct(F.lit("vocabulary").alias("section"), F.lit(c).alias("name"),
                   F.col(c).alias("value")) for c in contract.categorical],
    )).alias("s")).select("s.*").where(F.col("value").isNotNull())
    levels = tagged.groupBy("section", "name", "value").agg(
        F.count("*").cast("double").alias("n")
    )
    return counts.unionByName(levels)
