"""Running totals, quantiles, splits and metrics against numpy and pandas."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shiplens.operators import metrics, prefix, profile, splits
from shiplens.operators.contract import ContractViolation


@pytest.mark.parametrize("ranges, descending", [(None, False), (1, False), (29, False), (29, True), (500, True)])
def test_running_totals_match_a_sorted_cumsum(spark, ranges, descending):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"k": np.repeat(["a", "b"], 100), "v": np.r_[
        rng.permutation(100) / 7, np.arange(100) % 100 * 1e6], "n": rng.integers(0, 9, 200)})
    out = prefix.running_totals(
        spark.createDataFrame(pdf), "v", ["n"], keys=["k"], descending=descending,
        ranges=ranges).toPandas()
    for _, group in out.groupby("k"):
        group = group.sort_values("v", ascending=not descending)
        assert (group["n"].cumsum() == group["n_upto"]).all()
        assert (group["n_all"] == group["n"].sum()).all()


def test_one_hot_value_and_extremes_in_quantiles(spark):
    rng = np.random.default_rng(2)
    hot = np.where(rng.random(900) < 0.4, 3.0, rng.normal(size=900) * 1e3)
    pdf = pd.DataFrame({"a": hot, "b": rng.integers(0, 2, 900).astype(float),
                        "c": np.where(rng.random(900) < 0.5, np.nan, rng.random(900))})
    df = spark.createDataFrame(pdf).select(
        *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in "abc"])
    for size in (10**6, 11, 1):
        out = {(r["column"], r["probability"]): r["quantile"] for r in prefix.exact_quantiles(
            df, ["a", "b", "c"], [0.0, 0.25, 0.5, 1.0], in_order=size).collect()}
        for (column, p), value in out.items():
            assert value == pytest.approx(pdf[column].quantile(p), abs=1e-12)
        assert len(out) == 12


def test_totals_of_texts_and_missing_values(spark):
    rows = [("a", v, n) for n, v in enumerate(["b", None, "a", "é", "", "z"])] + [(None, v, 10) for v in ("x", None)]
    got = prefix.running_totals(spark.createDataFrame(rows, "k string, v string, n long"), "v", ["n"], keys=["k"], ranges=5)
    out = {(r["k"], r["v"]): (r["n_upto"], r["n_all"]) for r in got.collect()}
    assert out == {("a", ""): (4, 15), ("a", "a"): (6, 15), ("a", "b"): (6, 15), ("a", "z"): (11, 15), ("a", "é"): (14, 15),
                   ("a", None): (15, 15), (None, "x"): (10, 20), (None, None): (20, 20)}
    assert prefix.running_totals(spark.createDataFrame([], "v long, n long"), "v", ["n"]).count() == 0


def test_brackets_are_narrowed_and_only_their_values_are_ordered(spark, monkeypatch):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"a": rng.normal(size=20_000), "b": np.where(rng.random(20_000) < 0.5, 1.0, rng.random(20_000)),
                        "c": rng.integers(0, 3, 20_000).astype(float), "d": 7.0, "e": np.r_[np.inf, rng.normal(size=19_999)]})
    df = spark.createDataFrame(pdf)
    monkeypatch.setattr(prefix, "SKETCH", 50)
    rounds = []
    true = prefix._narrowed
    monkeypatch.setattr(prefix, "_narrowed", lambda df, b: rounds.append([x.inside for x in b]) or true(df, b))
    out = {(r["column"], r["probability"]): r["quantile"] for r in prefix.exact_quantiles(
        df, list(pdf), [0.0, 0.01, 0.5, 0.999, 1.0], in_order=100).collect()}
    assert len(out) == 25 and len(rounds) > 1 and max(rounds[1]) < 20_000
    for (column, p), value in out.items():
        want = np.inf if (column, p) == ("e", 1.0) else np.quantile(pdf[column], p)
        assert value == pytest.approx(want, abs=1e-12), (column, p)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None)], "a double, b double")
    assert [tuple(r) for r in prefix.exact_quantiles(df, ["a", "b"], [0.5]).collect()] == [("b", 0.5, 1.0)]
    assert prefix.exact_quantiles(df, ["a"], [0.5]).count() == 0
    assert prefix.exact_quantiles(df.limit(0), ["a", "b"], [0.5]).count() == 0


def dated(spark, counts):
    rows = [(f"r{d}-{i}", datetime(2025, 1, 1) + timedelta(days=d), i % 2)
            for d, n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, "id string, day timestamp, label int")


def test_cutoff_keeps_dates_whole(spark):
    df = dated(spark, {0: 5, 1: 1, 2: 90, 3: 4})
    split = splits.split_by_time(df, "day", quantile=0.8)
    assert (split.train.count(), split.test.count()) == (6, 94)
    fixed = splits.split_by_time(df, "day", cutoff="2025-01-04 00:00:00")
    assert fixed.test.count() == 4


def test_one_date_cannot_be_split(spark):
    with pytest.raises(ContractViolation, match="side empty"):
        splits.split_by_time(dated(spark, {0: 10}), "day", quantile=0.8)


@pytest.mark.parametrize("days, folds, share", [(23, 4, 0.4), (10, 3, 0.5), (9, 5, 0.4)])
def test_folds_match_even_date_chunks(spark, days, folds, share):
    df = dated(spark, {d: 1 + d % 3 for d in range(days)})
    got = splits.expanding_folds(df, "day", folds, share).orderBy("fold").collect()
    left = np.arange(days)[max(int(np.floor(days * share)), 1):]
    want = [c for c in np.array_split(left, folds)]
    assert [r["dates"] for r in got] == [len(c) for c in want]
    assert [(r["cutoff"] - datetime(2025, 1, 1)).days for r in got] == [
        int(c[0]) for c in want]
    sides = splits.fold_sides(df, "day", splits.expanding_folds(df, "day", folds, share))
    worst = sides.groupBy("fold").agg(
        F.max(F.when(F.col("side") == "train", F.col("day"))).alias("a"),
        F.min(F.when(F.col("side") == "validation", F.col("day"))).alias("b"))
    assert all(r["a"] < r["b"] for r in worst.collect())


def test_too_few_dates_give_no_folds(spark):
    assert splits.expanding_folds(dated(spark, {0: 3, 1: 3}), "day", 4, 0.4).count() == 0


@pytest.mark.parametrize("counts", [{0: 40, 1: 60}, {0: 10, 1: 80, 2: 10}, {d: 1 for d in range(30)}])
def test_calibration_slice_is_the_last_fifth(spark, counts):
    df = dated(spark, counts)
    held, _ = splits.calibration_slice(df, "day", "id")
    n = sum(counts.values())
    assert df.where(held).count() == int(np.ceil(n * 0.2))
    edge = df.agg(F.max(F.when(~held, F.col("day"))), F.min(F.when(held, F.col("day")))).first()
    assert edge[0] <= edge[1]


def scored_frame(seed=3, n=400):
    rng = np.random.default_rng(seed)
    p = np.round(rng.random(n), 2)
    p[: n // 3] = 0.29  # a hot score
    return pd.DataFrame({"label": (rng.random(n) < p).astype(int), "probability": p,
                         "fold": rng.integers(0, 2, n)})


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return np.mean((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg))


def brute_average_precision(y, p):
    total, last = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        hit = p >= t
        recall = (y[hit] == 1).sum() / (y == 1).sum()
        total += (recall - last) * (y[hit] == 1).mean()
        last = recall
    return total


def test_sweep_and_choice(spark):
    pdf = scored_frame()
    y, p = pdf["label"].to_numpy(), pdf["probability"].to_numpy()
    got = metrics.threshold_sweep(spark.createDataFrame(pdf), 5.0).orderBy("threshold").collect()
    assert len(got) == 99
    for i, row in enumerate(got, start=1):
        t = i / 100
        assert row["threshold"] == t
        assert row["false_negatives"] == ((p < t) & (y == 1)).sum()
        assert row["false_positives"] == ((p >= t) & (y == 0)).sum()
    best = metrics.best_threshold(spark.createDataFrame(pdf), 5.0).first()
    costs = [(r["expected_cost"], r["threshold"]) for r in got]
    assert (best["expected_cost"], best["threshold"]) == min(costs)


def test_grouped_metrics(spark):
    pdf = scored_frame()
    rows = metrics.evaluate(spark.createDataFrame(pdf), F.lit(0.4), 5.0, ["fold"]).collect()
    for row in rows:
        part = pdf[pdf["fold"] == row["fold"]]
        y, p = part["label"].to_numpy(), part["probability"].to_numpy()
        hit = p >= 0.4
        assert row["roc_auc"] == pytest.approx(brute_auc(y, p))
        assert row["average_precision"] == pytest.approx(brute_average_precision(y, p))
        assert row["precision"] == pytest.approx((y[hit] == 1).mean())
        assert row["recall"] == pytest.approx((hit & (y == 1)).sum() / (y == 1).sum())
        assert row["brier"] == pytest.approx(((p - y) ** 2).mean())
        c = np.clip(p, 1e-15, 1 - 1e-15)
        assert row["log_loss"] == pytest.approx(-np.mean(np.where(y == 1, np.log(c), np.log(1 - c))))


def test_one_class_has_no_area_and_zero_rates(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "label int, probability double")
    row = metrics.evaluate(df, F.lit(0.5), 5.0).first()
    assert row["roc_auc"] is None and row["average_precision"] is None
    assert row["precision"] == 0.0 and row["recall"] == 0.0 and row["f1"] == 0.0


def test_curves(spark):
    pdf = scored_frame(5, 60)
    y, p = pdf["label"].to_numpy(), pdf["probability"].to_numpy()
    df = spark.createDataFrame(pdf)
    full = metrics.roc_points(df, drop_collinear=False).collect()
    points = {r["threshold"]: (r["false_positive_rate"], r["true_positive_rate"]) for r in full}
    for t in set(p):
        assert points[t] == pytest.approx(
            (((p >= t) & (y == 0)).sum() / (y == 0).sum(),
             ((p >= t) & (y == 1)).sum() / (y == 1).sum()))
    assert points[float("inf")] == (0.0, 0.0)
    kept = sorted((r["false_positive_rate"], r["true_positive_rate"])
                  for r in metrics.roc_points(df).collect())
    assert len(kept) <= len(points) and set(kept) <= set(points.values())
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(kept, kept[1:]))
    assert area == pytest.approx(brute_auc(y, p))
    assert metrics.pr_points(df).count() == len(set(p))


def test_profiles(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 3.0, 10.0], "b": [2.0, None, 6.0, 1.0]})
    df = spark.createDataFrame(pdf).select(
        "a", F.when(~F.isnan("b"), F.col("b")).alias("b"))
    got = {r["column"]: r for r in profile.describe(df, ["a", "b"]).collect()}
    want = pdf.describe()
    for column in "ab":
        assert got[column]["q50"] == want[column]["50%"]
        assert got[column]["std"] == pytest.approx(want[column]["std"])
    corr = profile.correlations(df, ["a", "b"]).first()["correlation"]
    assert corr == pytest.approx(pdf.corr().loc["a", "b"])
    cat = spark.createDataFrame([("x",), ("y",), (None,), (None,)], "c string")
    row = profile.category_profile(cat, ["c"]).first()
    assert (row["unique_values"], row["missing_rows"], row["most_common"]) == (3, 2, None)
