"""Time-aware splitting. Cutoffs are scalar subqueries, so tagging rows needs no join."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplens.operators.contract import ContractViolation
from shiplens.operators.prefix import running_totals


def _date_counts(df: DataFrame, date: str) -> DataFrame:
    """Rows per date with running totals; dates as microseconds so they can be ranged."""
    daily = (
        df.where(F.col(date).isNotNull())
        .groupBy(F.unix_micros(F.col(date).cast("timestamp")).alias("at"))
        .agg(F.count("*").alias("n"), F.lit(1).alias("one"))
    )
    return running_totals(daily, "at", ["n", "one"])


def quantile_cutoff(df: DataFrame, date: str, quantile: float) -> DataFrame:
    """One row `cutoff`: the date at position floor(rows * quantile) of the date order."""
    position = F.least(
        F.greatest(F.floor(F.col("n_all") * F.lit(float(quantile))), F.lit(1)),
        F.col("n_all") - 1,
    )
    return _date_counts(df, date).where(F.col("n_upto") > position).agg(
        F.timestamp_micros(F.min("at")).alias("cutoff")
    )


def tag_sides(df: DataFrame, date: str, cutoff: Column, side: str = "side") -> DataFrame:
    """`train` strictly before the cutoff, `test` from it on: a date never splits."""
    return df.withColumn(side, F.when(F.col(date) < cutoff, "train").otherwise("test"))


@dataclass(frozen=True)
class TimeSplit:
    train: DataFrame
    test: DataFrame
    cutoff: object


def split_by_time(
    df: DataFrame, date: str, *, quantile: float | None = None, cutoff: object = None
) -> TimeSplit:
    """Both sides, checked to be non-empty. The cutoff is read back: one value."""
    if cutoff is None:
        cutoff = quantile_cutoff(df, date, quantile).first()["cutoff"]
    counts = df.agg(
        F.count_if(F.col(date) < F.lit(cutoff)).alias("train"),
        F.count_if(F.col(date) >= F.lit(cutoff)).alias("test"),
        F.count_if(F.col(date).isNull()).alias("undated"),
    ).first()
    if counts["undated"]:
        raise ContractViolation(f"{counts['undated']} rows have no usable {date}")
    if not counts["train"] or not counts["test"]:
        raise ContractViolation(
            f"Time split leaves a side empty (cutoff={cutoff}, train={counts['train']}, "
            f"test={counts['test']})"
        )
    before = F.col(date) < F.lit(cutoff)
    return TimeSplit(df.where(before), df.where(~before), cutoff)


def expanding_folds(
    df: DataFrame, date: str, folds: int, initial_quantile: float
) -> DataFrame:
    """(fold, cutoff, last_date, dates): consecutive date chunks after the initial window.

    Chunk sizes differ by at most one date, the larger ones first. Fold i trains on every
    date before its cutoff and validates on its own chunk.
    """
    initial = F.greatest(
        F.floor(F.col("one_all") * F.lit(float(initial_quantile))), F.lit(1)
    )
    left = F.col("one_all") - initial
    place = F.col("one_upto") - 1 - initial
    base, extra = F.floor(left / folds), F.pmod(left, F.lit(folds))
    wide = extra * (base + 1)
    number = F.when(place < wide, F.floor(place / (base + 1))).otherwise(
        extra + F.floor((place - wide) / base)
    )
    return (
        _date_counts(df, date).where((place >= 0) & (left >= folds))
        .groupBy((number + 1).cast("int").alias("fold"))
        .agg(
            F.timestamp_micros(F.min("at")).alias("cutoff"),
            F.timestamp_micros(F.max("at")).alias("last_date"),
            F.count("*").alias("dates"),
        )
    )


def fold_sides(df: DataFrame, date: str, bounds: DataFrame) -> DataFrame:
    """Rows repeated per fold they take part in, with `fold` and `side`.

    `bounds` has one row per fold and is read as one array expanded per row, so nothing
    is shuffled and rows in no fold vanish in the same pass.
    """
    folds = bounds.agg(
        F.array_sort(F.collect_list(F.struct("fold", "cutoff", "last_date"))).alias("f")
    ).scalar()
    when = F.col(date)
    return (
        df.withColumn("_fold", F.explode(folds)).where(when <= F.col("_fold.last_date"))
        .withColumns({
            "fold": F.col("_fold.fold"),
            "side": F.when(when < F.col("_fold.cutoff"), "train").otherwise("validation"),
        })
        .drop("_fold")
    )


def date_ranges(df: DataFrame, date: str, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min(date).alias("start"), F.max(date).alias("end"), F.count("*").alias("rows"),
    )


def one_class_groups(df: DataFrame, label: str, keys: list[str]) -> DataFrame:
    """Groups whose rows carry fewer than two classes."""
    return df.groupBy(*keys).agg(
        F.min(label).alias("low"), F.max(label).alias("high")
    ).where(F.col("low").eqNullSafe(F.col("high"))).select(*keys)


def calibration_slice(
    df: DataFrame, date: str, key: str, share: float = 0.2
) -> tuple[Column, DataFrame]:
    """Condition that marks the last ceil(share) of rows in (date, hash of key) order.

    The cut may fall inside one date. Rows of that date are ordered by a 64-bit hash of
    their key, a stable order that ranges evenly however many rows share the date. Also
    returns the one-row table of the cut, for inspection.
    """
    hashed = F.xxhash64(F.col(key))
    ordered = df.select(F.unix_micros(F.col(date).cast("timestamp")).alias("at"),
                        hashed.alias("h"))
    fit = F.col("n_all") - F.greatest(
        F.ceil(F.col("n_all") * F.lit(float(share))), F.lit(1)
    )
    day = _date_counts(df, date).where(
        (F.col("n_upto") > fit) & (F.col("n_upto") - F.col("n") <= fit)
    ).agg(
        F.max("at").alias("day"), F.max(fit - (F.col("n_upto") - F.col("n"))).alias("need"),
        F.max("n_all").alias("rows"),
    )
    on_day = ordered.where(F.col("at") == day.select("day").scalar())
    ranked = running_totals(on_day.groupBy("h").agg(F.count("*").alias("n")), "h", ["n"])
    first = ranked.where(
        F.col("n_upto") - F.col("n") >= day.select("need").scalar()
    ).agg(F.min("h").alias("h"))
    cut = day.select("day", "need", "rows", first.scalar().alias("hash")).first()
    at = F.unix_micros(F.col(date).cast("timestamp"))
    held = (at > F.lit(cut["day"])) | (
        (at == F.lit(cut["day"])) & (hashed >= F.lit(cut["hash"]))
    )
    return held, df.sparkSession.createDataFrame(
        [tuple(cut)], "day long, need long, rows long, hash long"
    )
