"""Exact running totals and quantiles without pulling an ordering into one task.

A global ordered window sends every row to one partition. Running totals are taken on two levels
instead: Spark deals the rows out by ranges of the ordering, each range is summed up, the sums, one
row a range, are scanned as a table, and a range's own running total starts from what came before it.

Quantiles need no ordering of the rows at all. A mergeable sketch of each column gives a bracket that
holds the wanted ranks, one aggregation counts the values below and inside it, and only the values
inside are put in order. The sketch decides where to look, never what is found: a bracket that the
counts refute is opened again on that side.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiplens.sources.scratch import materialise

#: A sketch's rank error is one part in SKETCH of its values; IN_ORDER is how many values of a
#: bracket, equal ones not merged yet, one task may be given to put in order.
SKETCH, IN_ORDER = 10_000, 10_000


def running_totals(
    df: DataFrame,
    value: str,
    totals: list[str],
    *,
    keys: list[str] | None = None,
    descending: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Adds `<t>_upto` (inclusive running total) and `<t>_all` for every total.

    `df` holds one row per (keys, value); `value` may be of any type with an order, null coming last
    upwards. Without `ranges` there are as many as the session has shuffle partitions, fewer where they
    would be small.
    """
    keys = keys or []
    order = F.col(value).desc_nulls_first() if descending else F.col(value).asc_nulls_last()
    by = [*(F.col(k) for k in keys), order]
    dealt = df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)
    # written, so that both levels see the same ranges
    placed = materialise(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    sums = placed.groupBy(*keys, "_range").agg(*[F.sum(t).alias(f"_{t}") for t in totals])
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_range").alias("_of"),
        *[F.coalesce(F.sum(f"_{t}").over(before), F.lit(0)).alias(f"_{t}_before") for t in totals],
        *[F.sum(f"_{t}").over(whole).alias(f"{t}_all") for t in totals],
    )
    same = F.col("_range") == F.col("_of")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    inside = Window.partitionBy(*keys, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = placed.withColumns({f"{t}_upto": F.sum(t).over(inside) for t in totals})
    return run.join(offsets, same).withColumns({
        f"{t}_upto": F.col(f"{t}_upto") + F.col(f"_{t}_before") for t in totals
    }).drop("_range", "_of", *[f"_key_{k}" for k in keys], *[f"_{t}_before" for t in totals])


@dataclass(frozen=True)
class _Bracket:
    """Where the values of rank `first` and `last` (from 0) of a column lie: between low and high,
    both included; `below` values are less than low and `inside` within."""

    column: str
    probability: float
    n: int
    low: float
    high: float
    below: int
    inside: int

    @property
    def spot(self) -> float:
        return (self.n - 1) * self.probability

    @property
    def first(self) -> int:
        return math.floor(self.spot)

    @property
    def last(self) -> int:
        return math.ceil(self.spot)

    def holds(self, value: Column) -> Column:
        return (value >= F.lit(self.low)) & (value <= F.lit(self.high))


def _numbers(df: DataFrame, named: dict[str, Column]) -> dict:
    return df.agg(*[c.alias(n) for n, c in named.items()]).first().asDict()


def _narrowed(df: DataFrame, brackets: list[_Bracket]) -> list[_Bracket]:
    """Each bracket cut to the part that the sketch of its values points at, and counted."""
    sketches = {}
    for i, b in enumerate(brackets):
        v = F.col(b.column).cast("double")
        at = [max(0.0, (b.first - b.below) / b.inside - 2 / SKETCH), min(1.0, (b.last - b.below + 1) / b.inside + 2 / SKETCH)]
        sketches[f"b{i}"] = F.percentile_approx(F.when(b.holds(v), v), F.array(*map(F.lit, at)), F.lit(SKETCH))
    found = _numbers(df, sketches)
    cut = [replace(b, low=found[f"b{i}"][0], high=found[f"b{i}"][1]) for i, b in enumerate(brackets)]
    counts = {}
    for i, b in enumerate(cut):
        v = F.col(b.column).cast("double")
        counts |= {f"b{i}": F.count_if(v < F.lit(b.low)), f"i{i}": F.count_if(b.holds(v))}
    found = _numbers(df, counts)
    out = []
    for i, (old, b) in enumerate(zip(brackets, cut)):
        below, end = found[f"b{i}"], found[f"b{i}"] + found[f"i{i}"]
        if below > b.first:
            below, b = old.below, replace(b, low=old.low)
        if end <= b.last:
            end, b = old.below + old.inside, replace(b, high=old.high)
        out.append(replace(b, below=below, inside=end - below))
    return out


def exact_quantiles(
    df: DataFrame, columns: list[str] | tuple[str, ...], probabilities: list[float],
    *, in_order: int | None = None,
) -> DataFrame:
    """(column, probability, quantile) with linear interpolation, nulls ignored.

    `df` is read four times at least, so it should be cheap to read; none of its rows is shuffled but
    those of the brackets. A column with no value is absent.
    """
    spark = df.sparkSession
    first = _numbers(df, {f"{f}{i}": g(F.col(c).cast("double")) for i, c in enumerate(columns)
                          for f, g in (("n", F.count), ("low", F.min), ("high", F.max))})
    brackets = [
        _Bracket(c, float(p), n, first[f"low{i}"], first[f"high{i}"], 0, n)
        for i, c in enumerate(columns) if (n := first[f"n{i}"]) for p in probabilities
    ]
    if not brackets:
        return spark.createDataFrame([], "column string, probability double, quantile double")
    open_ = list(range(len(brackets)))
    while open_ := [i for i in open_ if brackets[i].inside > (in_order or IN_ORDER) and brackets[i].low < brackets[i].high]:
        new = _narrowed(df, [brackets[i] for i in open_])
        # one that is no smaller is made of few values, each with many rows: those are merged below
        moved = [b.inside < brackets[i].inside for i, b in zip(open_, new)]
        for i, b in zip(open_, new):
            brackets[i] = b
        open_ = [i for i, m in zip(open_, moved) if m]
    entries = F.array_compact(F.array(*[
        F.when(b.holds(F.col(b.column).cast("double")),
               F.struct(F.lit(i).alias("ask"), F.col(b.column).cast("double").alias("v")))
        for i, b in enumerate(brackets)
    ]))
    counts = df.select(F.inline(entries)).groupBy("ask", "v").agg(F.count("*").alias("n"))
    # a row for each column and probability
    asks = spark.createDataFrame(
        [(i, b.column, b.probability, b.below, b.first, b.last, b.spot - b.first) for i, b in enumerate(brackets)],
        "ask int, column string, probability double, below long, first long, last long, share double")
    upto = F.sum("n").over(Window.partitionBy("ask").orderBy("v"))
    run = counts.withColumn("upto", upto).join(F.broadcast(asks), "ask").withColumns({
        "end": F.col("upto") + F.col("below"), "begin": F.col("upto") + F.col("below") - F.col("n")})

    def at(rank: str) -> Column:
        return F.max(F.when((F.col("begin") <= F.col(rank)) & (F.col(rank) < F.col("end")), F.col("v")))

    between = F.col("low") + (F.col("high") - F.col("low")) * F.col("share")
    return run.groupBy("column", "probability", "share").agg(at("first").alias("low"), at("last").alias("high")).select(
        "column", "probability",
        F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(between).alias("quantile"))
