"""Quality gate of training runs against every earlier run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def run_gate(
    runs: DataFrame, *, auc_tolerance: float = 0.02, auc_floor: float = 0.65,
    min_recall: float = 0.90,
) -> DataFrame:
    """`runs` (model, run_at, roc_auc, recall, warnings) -> the checks and the verdict.

    The bar is the best area any earlier run of the same registered model reached, not
    the live one's; runs are metadata, a few per month and model.
    """
    before = Window.partitionBy("model").orderBy("run_at").rowsBetween(
        Window.unboundedPreceding, -1
    )
    best = F.max("roc_auc").over(before)
    required = F.coalesce(best, F.lit(auc_floor)) - F.lit(auc_tolerance)

    def check(condition):
        return F.coalesce(condition, F.lit(False))

    return runs.select(
        "model", "run_at", "roc_auc", "recall", "warnings", required.alias("required_auc"),
        F.when(best.isNotNull(), "earlier runs").otherwise("floor").alias("basis"),
    ).select(
        "*",
        check(F.col("roc_auc") >= F.col("required_auc")).alias("auc_ok"),
        check(F.col("recall") >= min_recall).alias("recall_ok"),
        check(F.col("warnings") == 0).alias("warnings_ok"),
    ).withColumn("passed", F.col("auc_ok") & F.col("recall_ok") & F.col("warnings_ok"))
