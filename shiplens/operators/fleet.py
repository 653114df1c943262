"""The fleet page's tables: newest run joined with its inputs, rollups, register."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BANDS = ("HIGH", "MEDIUM", "LOW")
REGISTER_COLUMNS = [
    "deployment_id", "vendor_name", "device_type", "hardware_series", "current_firmware",
    "target_firmware", "risk_probability", "risk_prediction", "risk_band",
]


def with_inputs(scores: DataFrame, inputs: DataFrame, key: str = "deployment_id") -> DataFrame:
    """Every score with its input row where there is one; clashing names get `_input`."""
    renamed = inputs.select(key, *[
        F.col(c).alias(f"{c}_input" if c in scores.columns else c)
        for c in inputs.columns if c != key
    ])
    return scores.join(renamed, key, "left")


def band_counts(scores: DataFrame) -> DataFrame:
    """One row per band, absent bands as zero, from a single fixed-width aggregation."""
    wide = scores.agg(*[F.count_if(F.col("risk_band") == b).alias(b) for b in BANDS])
    return wide.unpivot([], list(BANDS), "risk_band", "rows")


def nogo_by(df: DataFrame, column: str = "vendor_name") -> DataFrame:
    return (
        df.where((F.col("risk_prediction") == "NO_GO") & F.col(column).isNotNull())
        .groupBy(column).agg(F.count("*").alias("rows"))
    )


def counts_by(df: DataFrame, column: str = "deployment_type") -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))


def register(
    df: DataFrame, *, bands: list[str] | None = None, decisions: list[str] | None = None,
    vendors: list[str] | None = None, deployment_id: str | None = None,
) -> DataFrame:
    """The projected register, filtered the way the page filters it."""
    for column, allowed in (
        ("risk_band", bands), ("risk_prediction", decisions), ("vendor_name", vendors),
    ):
        if allowed is not None:
            df = df.where(F.col(column).isin(allowed))
    if deployment_id is not None:
        df = df.where(F.col("deployment_id") == deployment_id)
    return df.select(*[c for c in REGISTER_COLUMNS if c in df.columns])


def newest_run(scores: DataFrame, stamp: str = "scored_at") -> DataFrame:
    """Rows of the newest run: a global maximum pushed back as a filter."""
    return scores.where(F.col(stamp) == scores.agg(F.max(stamp)).scalar())


def newest_real_run(
    scores: DataFrame, run: str = "scored_at", *, smoke_prefix: str = "smoke-"
) -> DataFrame:
    """Rows of the newest run not made of smoke rows only, else of the newest run."""
    per_run = scores.groupBy(run).agg(
        F.bool_and(F.col("deployment_id").startswith(smoke_prefix)).alias("smoke")
    )
    pick = per_run.agg(
        F.coalesce(F.max(F.when(~F.col("smoke"), F.col(run))), F.max(run)).alias("run")
    )
    return scores.where(F.col(run) == pick.scalar())


def upcoming_with_scores(
    upcoming: DataFrame, scores: DataFrame, key: str = "deployment_id"
) -> DataFrame:
    """Upcoming rows with their scores of the newest real run, where it has them."""
    newest = newest_real_run(scores)
    kept = [c for c in newest.columns if c == key or c not in upcoming.columns]
    return upcoming.join(newest.select(kept), key, "left")


def run_list(scores: DataFrame, run: str = "scored_at") -> DataFrame:
    """Runs with their size, for a reader to order: the run stamp sorts by time."""
    return scores.groupBy(run).agg(F.count("*").alias("rows"))
