"""Probabilities to decisions, run summaries and publication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplens.operators.contract import ContractViolation

SCORE_COLUMNS = [
    "deployment_id", "risk_probability", "risk_prediction", "risk_band",
    "unseen_categories", "model_run",
]
STAGED_COLUMNS = [*SCORE_COLUMNS, "model_version", "threshold"]
PUBLISHED_COLUMNS = [*STAGED_COLUMNS, "scored_at"]


def decision(probability: Column, threshold: Column) -> Column:
    return F.when(probability >= threshold, "NO_GO").otherwise("GO")


def band(probability: Column, threshold: Column) -> Column:
    return (F.when(probability >= threshold, "HIGH")
            .when(probability >= threshold / 2, "MEDIUM").otherwise("LOW"))


def decide(
    df: DataFrame, threshold: float, model_run: str, *, probability: str = "probability",
    unseen: str | None = "unseen_categories",
) -> DataFrame:
    """The six score columns. The decision uses the unrounded probability."""
    p, cut = F.col(probability), F.lit(float(threshold))
    return df.select(
        "deployment_id", F.round(p, 4).alias("risk_probability"),
        decision(p, cut).alias("risk_prediction"), band(p, cut).alias("risk_band"),
        (F.col(unseen) if unseen else F.lit("{}")).alias("unseen_categories"),
        F.lit(model_run).alias("model_run"),
    )


def run_summary(scores: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Decision and band counts and the average probability, one row per group."""
    return scores.groupBy(*(keys or [])).agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col("risk_prediction") == d).alias(d.lower()) for d in ("GO", "NO_GO")],
        *[F.count_if(F.col("risk_band") == b).alias(b.lower())
          for b in ("HIGH", "MEDIUM", "LOW")],
        F.avg("risk_probability").alias("average_probability"),
        F.count_if(~F.col("unseen_categories").isin("{}", "")).alias("unseen_rows"),
    )


def unseen_rows(scores: DataFrame) -> DataFrame:
    return scores.where(F.col("unseen_categories") != "{}").select(
        "deployment_id", "unseen_categories"
    )


def run_constants(df: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """Per column its single distinct value, or null where there are none or several."""
    return df.groupBy(*(keys or [])).agg(*[
        F.when(F.min(c) == F.max(c), F.min(c).cast("string")).alias(c) for c in columns
    ])


def attributed_threshold(
    scores: DataFrame, champion_threshold: float | None, keys: list[str] | None = None
) -> DataFrame:
    """The threshold a run was scored with, else the champion's, else an assumed 0.5."""
    own = run_constants(scores, ["threshold"], keys)
    value = F.col("threshold").try_cast("double")
    champion = F.lit(champion_threshold).cast("double")
    return own.select(
        *(keys or []),
        F.coalesce(value, champion, F.lit(0.5)).alias("threshold"),
        F.when(value.isNotNull(), "run").when(champion.isNotNull(), "champion")
        .otherwise("assumed").alias("source"),
    )


def publishable(staged: DataFrame, scored_at: str) -> DataFrame:
    """Staged rows in published order, refused unless one known version made them all."""
    seen = staged.agg(
        F.count("*").alias("rows"), F.min("model_version").alias("low"),
        F.max("model_version").alias("high"),
        F.count_if(F.col("model_version").isNull()).alias("unknown"),
    ).first()
    if not seen["rows"]:
        raise ContractViolation("Nothing staged; refusing to publish an empty run")
    if seen["low"] != seen["high"] or seen["unknown"]:
        raise ContractViolation(
            f"Mixed model versions in one run: {seen['low']!r} … {seen['high']!r}"
        )
    if seen["low"] == "unknown":
        raise ContractViolation("Model version is unknown; rows could not be attributed")
    return staged.withColumn("scored_at", F.lit(scored_at)).select(*PUBLISHED_COLUMNS)
