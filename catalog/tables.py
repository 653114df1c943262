"""Deployment-shaped views of the driver's tables, as lazy column expressions.

Each view joins only the sources whose columns are asked for, so a query about dates
never reads lineitem.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.operators.contract import DEPLOYMENTS
from shiplens.sources.scratch import materialise

CUSTOMER_COLUMNS = {"site_id", "vendor_name"}
PART_COLUMNS = {"device_type", "hardware_series", "firmware_release_age_days"}
LINE_COLUMNS = PART_COLUMNS | {
    "network_stress_score", "error_rate_predeploy", "uptime_days", "past_failure_count",
    "cve_count", "max_cvss_score", "cross_vendor_dependency_count",
    "dependent_device_count",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_columns() -> dict:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    current, target = 1 + c % 7, 1 + k % 9
    return {
        "deployment_id": F.format_string("DEP_%06d", k),
        "device_id": F.concat(F.lit("device-"), c.cast("string")),
        "firmware_fingerprint": F.concat(F.lit("fingerprint-"), k.cast("string")),
        "fleet_tier": F.concat(F.lit("TIER_"), (c % 3 + 1).cast("string")),
        "site_criticality": F.when(priority.isin("1-URGENT", "2-HIGH"), "HIGH")
        .when(priority == "3-MEDIUM", "MEDIUM").otherwise("LOW"),
        "deployment_type": F.when(priority == "1-URGENT", "EMERGENCY")
        .when(priority == "2-HIGH", "PLANNED").otherwise("STANDARD"),
        "current_firmware": F.concat(
            F.when(k % 211 == 0, "v").otherwise(""), current.cast("string"),
            F.lit("."), (k % 4).cast("string"), F.lit(".0")),
        "target_firmware": F.concat(target.cast("string"), F.lit("."),
                                    (c % 3).cast("string"), F.lit(".1")),
        "version_jump_magnitude": F.when(
            k % 41 != 0, F.abs(target - current).cast("double") + (k % 8) / F.lit(8.0)),
        "kernel_touched": F.when(k % 53 != 0, (c % 2).cast("double")),
        "bootloader_touched": F.floor(k / 2).cast("bigint").cast("double") % 2,
        "protocol_mismatch_flag": F.when(k % 5 == 0, 1.0).otherwise(0.0),
        "maintenance_window": F.when(k % 3 != 0, 1.0).otherwise(0.0),
        "deployment_date": F.col("o_orderdate"),
        "deployment_outcome": F.when(status == "O", "SUCCESS").when(status == "F", "FAILED")
        .when(k % 2 == 0, "DEGRADED").otherwise("ROLLBACK"),
        "time_to_failure_hours": F.when(status != "O", (k % 48).cast("double")),
        "rollback_required": F.when((status == "P") & (k % 2 == 1), 1.0).otherwise(0.0),
    }


def line_summary(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """One row per order, of `orders` if given: counts and sums only, combined before the shuffle."""
    line = table(spark, sf_dir, "lineitem")
    if orders is not None:
        line = line.join(orders, line.l_orderkey == orders.o_orderkey, "left_semi")
    return line.groupBy("l_orderkey").agg(
        F.min(F.struct("l_linenumber", "l_partkey")).alias("first_line"),
        (F.sum("l_quantity") / (F.count("*") * 50.0)).alias("network_stress_score"),
        F.max("l_tax").alias("error_rate_predeploy"),
        (F.max("l_quantity") * 7.0).alias("uptime_days"),
        F.count_if(F.col("l_returnflag") == "R").cast("double").alias("past_failure_count"),
        F.count("*").cast("double").alias("cve_count"),
        F.round(F.max("l_discount") * 100.0, 1).alias("max_cvss_score"),
        (F.max("l_linenumber") - 1).cast("double").alias("cross_vendor_dependency_count"),
        F.sum("l_quantity").alias("dependent_device_count"),
    )


def deployments(
    spark: SparkSession, sf_dir: str, columns: list[str] | tuple[str, ...] | None = None,
    only: DataFrame | None = None,
) -> DataFrame:
    """The deployment fact table: one row per order, typed, nulls where a fact is absent. Of the ids in
    `only` (deployment_id) if given: their orders are written, so that lines of others aren't summed up."""
    columns = list(columns or DEPLOYMENTS.columns)
    need = set(columns)
    df = table(spark, sf_dir, "orders")
    made = order_columns()
    if only is not None:
        df = materialise(df.join(only, made["deployment_id"] == only["deployment_id"], "left_semi"), "orders")
    if need & CUSTOMER_COLUMNS:
        customer = table(spark, sf_dir, "customer").select(
            "c_custkey", F.concat(F.lit("site-"), F.col("c_nationkey").cast("string"))
            .alias("site_id"), F.col("c_mktsegment").alias("vendor_name"))
        df = df.join(customer, df.o_custkey == customer.c_custkey, "left")
    if need & LINE_COLUMNS:
        lines = line_summary(spark, sf_dir, None if only is None else df.select("o_orderkey"))
        df = df.join(lines, df.o_orderkey == lines.l_orderkey, "left")
    if need & PART_COLUMNS:
        part = table(spark, sf_dir, "part").select(
            "p_partkey", F.col("p_type").alias("device_type"),
            F.col("p_brand").alias("hardware_series"),
            F.col("p_size").cast("double").alias("firmware_release_age_days"))
        df = df.join(part, F.col("first_line.l_partkey") == part.p_partkey, "left")
    return df.select(*[
        made[c].alias(c) if c in made else F.col(c) for c in columns
    ])


def raw_feed(
    spark: SparkSession, sf_dir: str, orders: DataFrame | None = None
) -> DataFrame:
    """The same rows as text with the defects a feed brings: every contract rule fires.

    `orders` may be a stream of the same rows.
    """
    k = F.col("o_orderkey")
    df = table(spark, sf_dir, "orders") if orders is None else orders
    made = order_columns()
    text = {name: column.cast("string") for name, column in made.items()}
    text["deployment_id"] = F.format_string(
        "DEP_%06d", F.when(k % 400 == 7, k - 1).otherwise(k))
    text["deployment_outcome"] = (
        F.when(k % 301 == 0, "ROLLBACK_REQUIRED").when(k % 307 == 0, F.lit(None))
        .otherwise(made["deployment_outcome"]))
    text["deployment_date"] = F.when(k % 311 == 0, "soon").otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    text["kernel_touched"] = (
        F.when(k % 313 == 0, "1d").when(k % 53 == 0, F.lit(None))
        .otherwise((F.col("o_custkey") % 2).cast("string")))
    text["uptime_days"] = (
        F.when(k % 317 == 0, "not-a-number").when(k % 331 == 0, F.lit(None))
        .otherwise((k % 900).cast("string")))
    plain = {name: (k % (3 + i)).cast("string") for i, name in enumerate(DEPLOYMENTS.numeric)}
    plain["vendor_name"] = F.concat(F.lit("vendor-"), (F.col("o_custkey") % 6).cast("string"))
    plain["device_type"] = F.concat(F.lit("type-"), (k % 6).cast("string"))
    plain["hardware_series"] = F.concat(F.lit("series-"), (k % 16).cast("string"))
    plain["site_id"] = F.concat(F.lit("site-"), (F.col("o_custkey") % 25).cast("string"))
    return df.select(*[text.get(c, plain.get(c)).alias(c) for c in DEPLOYMENTS.columns])


def risk_score_expression():
    """A bounded, exactly reproducible probability made of a deployment's own facts."""
    points = (
        F.coalesce(F.col("past_failure_count"), F.lit(0.0)) * 9
        + F.coalesce(F.col("max_cvss_score"), F.lit(0.0)) * 2
        + F.when(F.col("site_criticality") == "HIGH", 11.0).otherwise(0.0)
        + F.pmod(F.substring("deployment_id", 5, 20).cast("bigint"), F.lit(83)).cast("double")
    )
    return F.least(points / 180.0, F.lit(1.0))


SCORED_INPUTS = (
    "deployment_id", "vendor_name", "device_type", "deployment_type", "site_criticality",
    "past_failure_count", "max_cvss_score", "deployment_date", "deployment_outcome",
)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deployments with a label and a probability, for everything after a model."""
    return deployments(spark, sf_dir, SCORED_INPUTS).withColumns({
        "label": F.when(F.col("deployment_outcome") == "SUCCESS", 0).otherwise(1),
        "probability": risk_score_expression(),
    })
