"""Splits, preprocessing, metrics, exploration, decisions and fleet tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog import table_sql as S
from catalog.registry import ORACLES, query
from catalog.tables import deployments, raw_feed, scored, table
from shiplens.operators import features as ft
from shiplens.operators import fleet, metrics, models, prep, profile, runs, scoring, splits
from shiplens.operators.contract import DEPLOYMENTS as C
from shiplens.operators.prefix import exact_quantiles
from shiplens.sources.scratch import materialise, new_path

DAY = "yyyy-MM-dd"
R9 = 9
RATIO = 5.0


def _rounded(df, *columns, digits=R9):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- exploration ---------------------------------------------------------------------

@query("contract_summary", f"""
WITH {S.RAW_FEED}
SELECT count(*) AS rows, count(DISTINCT deployment_date) AS unique_dates,
  min(deployment_date) AS date_start, max(deployment_date) AS date_end,
  count(*) - count(DISTINCT deployment_id) AS duplicates FROM raw""")
def contract_summary(spark, sf):
    return profile.contract_summary(raw_feed(spark, sf))


@query("outcome_share", f"""
WITH {S.DEPLOYMENTS}
SELECT deployment_outcome AS value, count(*) AS rows,
  round(count(*) / (SELECT count(*) FROM dep)::DOUBLE, 9) AS share FROM dep GROUP BY 1""")
def outcome_share(spark, sf):
    return _rounded(profile.shares(
        deployments(spark, sf, ("deployment_outcome",)), "deployment_outcome"), "share")


@query("monthly_risk", """
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS period, count(*) AS rows,
  round(avg(CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END), 9) AS risk_rate
FROM orders GROUP BY 1""")
def monthly_risk(spark, sf):
    df = deployments(spark, sf, ("deployment_date", "deployment_outcome"))
    out = profile.risk_by_period(df, "month")
    return _rounded(out.withColumn("period", F.date_format("period", DAY)), "risk_rate")


@query("daily_event_risk", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS period, count(*) AS rows,
  round(avg(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END), 9) AS risk_rate
FROM events GROUP BY 1""")
def daily_event_risk(spark, sf):
    df = table(spark, sf, "events").select(
        F.col("ts").alias("deployment_date"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS")
        .alias("deployment_outcome"))
    out = profile.risk_by_period(df, "day")
    return _rounded(out.withColumn("period", F.date_format("period", DAY)), "risk_rate")


@query("category_profile", f"""
WITH {S.DEPLOYMENTS}, c AS (
  SELECT name, value, count(*) AS n FROM ({' UNION ALL '.join(
      f"SELECT '{c}' AS name, {c} AS value FROM dep" for c in S.CATEGORICAL)}) GROUP BY ALL)
SELECT name AS "column", count(*) AS unique_values,
  sum(CASE WHEN value IS NULL THEN n ELSE 0 END) AS missing_rows,
  (SELECT value FROM c d WHERE d.name = c.name ORDER BY n DESC, value NULLS FIRST LIMIT 1)
    AS most_common
FROM c GROUP BY name""")
def category_profile(spark, sf):
    return profile.category_profile(deployments(spark, sf, C.categorical), C.categorical)


SELECTED = ("version_jump_magnitude", "network_stress_score", "error_rate_predeploy",
            "uptime_days", "past_failure_count", "max_cvss_score")


@query("describe_numeric", f"""
WITH {S.DEPLOYMENTS}
{' UNION ALL '.join(f'''
SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 9) AS mean,
  round(stddev_samp({c}), 9) AS std, min({c}) AS min, max({c}) AS max,
  round(quantile_cont({c}, 0.25), 9) AS q25, round(quantile_cont({c}, 0.5), 9) AS q50,
  round(quantile_cont({c}, 0.75), 9) AS q75 FROM dep''' for c in SELECTED)}""")
def describe_numeric(spark, sf):
    return _rounded(profile.describe(materialise(deployments(spark, sf, SELECTED), "numbers"), SELECTED),
                    "mean", "std", "q25", "q50", "q75")


@query("correlation_pairs", f"""
WITH {S.DEPLOYMENTS}
{' UNION ALL '.join(
    f"SELECT '{a}' AS left, '{b}' AS right, round(corr({a}, {b}), 7) AS correlation FROM dep"
    for i, a in enumerate(SELECTED) for b in SELECTED[i + 1:])}""")
def correlation_pairs(spark, sf):
    return _rounded(profile.correlations(deployments(spark, sf, SELECTED), SELECTED),
                    "correlation", digits=7)


@query("derived_summary", f"""
WITH {S.FEATURES}
{' UNION ALL '.join(
    f'''SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS missing,
    round(avg({c}), 9) AS mean, min({c}) AS minimum, max({c}) AS maximum FROM feat'''
    for c in S.DERIVED)}""")
def derived_summary(spark, sf):
    return _rounded(profile.derived_summary(ft.derive(deployments(spark, sf))), "mean")


@query("jump_value_counts", f"""
WITH {S.FEATURES}
SELECT major_version_jump AS value, count(*) AS rows FROM feat GROUP BY 1""")
def jump_value_counts(spark, sf):
    return profile.value_counts(ft.derive(deployments(spark, sf)), "major_version_jump")


# --- splits --------------------------------------------------------------------------

_DATES = ("deployment_id", "deployment_date", "deployment_outcome")
_CUTOFF = """
cut AS (SELECT min(d) AS cutoff FROM (
  SELECT o_orderdate AS d, sum(count(*)) OVER (ORDER BY o_orderdate) AS upto,
    sum(count(*)) OVER () AS n FROM orders GROUP BY o_orderdate)
  WHERE upto > least(greatest(floor(n * 0.8::DOUBLE), 1), n - 1))
"""


@query("time_split", f"""
WITH {_CUTOFF}
SELECT CASE WHEN o_orderdate < cutoff THEN 'train' ELSE 'test' END AS side, count(*) AS rows,
  strftime(min(o_orderdate), '%Y-%m-%d') AS start, strftime(max(o_orderdate), '%Y-%m-%d') AS "end",
  strftime(any_value(cutoff), '%Y-%m-%d') AS cutoff FROM orders, cut GROUP BY 1""")
def time_split(spark, sf):
    df = deployments(spark, sf, _DATES)
    cut = splits.quantile_cutoff(df, "deployment_date", 0.8)
    sides = splits.tag_sides(df, "deployment_date", cut.scalar())
    out = splits.date_ranges(sides, "deployment_date", ["side"])
    return out.withColumn("cutoff", cut.scalar()).withColumns(
        {c: F.date_format(c, DAY) for c in ("start", "end", "cutoff")})


@query("fixed_cutoff_split", """
SELECT CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'train' ELSE 'test' END AS side,
  count(*) AS rows, strftime(min(o_orderdate), '%Y-%m-%d') AS start,
  strftime(max(o_orderdate), '%Y-%m-%d') AS "end" FROM orders GROUP BY 1""")
def fixed_cutoff_split(spark, sf):
    df = deployments(spark, sf, _DATES)
    sides = splits.tag_sides(df, "deployment_date", F.lit("2000-01-01").cast("timestamp"))
    return splits.date_ranges(sides, "deployment_date", ["side"]).withColumns(
        {c: F.date_format(c, DAY) for c in ("start", "end")})


_FOLDS = f"""
{_CUTOFF},
dates AS (SELECT DISTINCT o_orderdate AS d FROM orders, cut WHERE o_orderdate < cutoff),
numbered AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS i, count(*) OVER () AS u FROM dates),
folds AS (
  SELECT fold, min(d) AS cutoff, max(d) AS last_date, count(*) AS dates FROM (
    SELECT d, ntile(4) OVER (ORDER BY d) AS fold FROM numbered
    WHERE i >= greatest(floor(u * 0.4::DOUBLE), 1)) GROUP BY fold)
"""


@query("expanding_folds", f"""
WITH {_FOLDS}
SELECT fold, strftime(cutoff, '%Y-%m-%d') AS cutoff, strftime(last_date, '%Y-%m-%d') AS last_date,
  dates FROM folds""")
def expanding_folds(spark, sf):
    return _fold_bounds(deployments(spark, sf, _DATES)).withColumns(
        {c: F.date_format(c, DAY) for c in ("cutoff", "last_date")})


def _train_side(df):
    cut = splits.quantile_cutoff(df, "deployment_date", 0.8)
    return df.where(F.col("deployment_date") < cut.scalar())


def _fold_bounds(df):
    return splits.expanding_folds(_train_side(df), "deployment_date", 4, 0.4)


@query("date_ranges", f"""
WITH {_FOLDS}
SELECT fold, CASE WHEN o_orderdate < folds.cutoff THEN 'train' ELSE 'validation' END AS side,
  strftime(min(o_orderdate), '%Y-%m-%d') AS start, strftime(max(o_orderdate), '%Y-%m-%d') AS "end",
  count(*) AS rows
FROM orders JOIN folds ON o_orderdate <= last_date GROUP BY 1, 2""")
def date_ranges(spark, sf):
    df = deployments(spark, sf, _DATES)
    sides = splits.fold_sides(_train_side(df), "deployment_date", _fold_bounds(df))
    return splits.date_ranges(sides, "deployment_date", ["fold", "side"]).withColumns(
        {c: F.date_format(c, DAY) for c in ("start", "end")})


@query("one_class_folds", f"""
WITH {_FOLDS}, rows AS (
  SELECT fold, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus = 'O' AS ok
  FROM orders JOIN folds ON o_orderdate <= last_date AND o_orderdate >= folds.cutoff)
SELECT fold, day FROM rows GROUP BY 1, 2 HAVING count(DISTINCT ok) < 2""")
def one_class_folds(spark, sf):
    df = deployments(spark, sf, _DATES)
    sides = splits.fold_sides(_train_side(df), "deployment_date", _fold_bounds(df))
    held = sides.where(F.col("side") == "validation").withColumns({
        "label": ft.risk_label(F.col("deployment_outcome")),
        "day": F.date_format("deployment_date", DAY)})
    return splits.one_class_groups(held, "label", ["fold", "day"])


@query("calibration_slice", """
SELECT count(*) - greatest(ceil(count(*) * 0.2::DOUBLE), 1) AS fit_rows,
  greatest(ceil(count(*) * 0.2::DOUBLE), 1) AS held_rows FROM orders""")
def calibration_slice(spark, sf):
    df = deployments(spark, sf, _DATES)
    held, _ = splits.calibration_slice(df, "deployment_date", "deployment_id")
    return df.agg(F.count_if(~held).alias("fit_rows"), F.count_if(held).alias("held_rows"))


@query("model_input_columns", f"""
WITH {S.FEATURES}
{' UNION ALL '.join(
    f"SELECT '{c}' AS " + '"column"' + f", count({c}) AS present FROM feat"
    for c in ("deployment_id", *S.CATEGORICAL, *S.NUMERIC, *S.DERIVED))}""")
def model_input_columns(spark, sf):
    """What a model may see: the key and the features, and nothing that is known only afterwards."""
    inputs = ft.model_inputs(_featured(spark, sf))
    counts = inputs.agg(*[F.count(c).alias(c) for c in inputs.columns])
    return counts.unpivot([], inputs.columns, "column", "present")


# --- preprocessing -------------------------------------------------------------------

_TRAIN = f"""
{S.FEATURES}, {_CUTOFF},
train AS (SELECT feat.* FROM feat, cut WHERE deployment_date < cutoff),
test AS (SELECT feat.* FROM feat, cut WHERE deployment_date >= cutoff)
"""


def _featured(spark, sf):
    return ft.derive(deployments(spark, sf))


def _split(spark, sf):
    """Both sides of the feature table, derived once: fitting reads it several times."""
    featured = materialise(_featured(spark, sf), "features")
    split = splits.split_by_time(featured, "deployment_date", quantile=0.8)
    return split.train, split.test


def _train_numbers(spark, sf):
    """What quantiles read several times."""
    return materialise(_train_side(_featured(spark, sf)).select(*prep.NUMERIC), "numbers")


@query("medians", f"""
WITH {_TRAIN}
{' UNION ALL '.join(
    f"SELECT '{c}' AS " + '"column"' + f", quantile_cont({c}, 0.5) AS median FROM train"
    for c in S.NUMERIC + S.DERIVED)}""")
def medians(spark, sf):
    return prep.medians(_train_numbers(spark, sf))


@query("medians_in_ranges", f"""
WITH {_TRAIN}
{' UNION ALL '.join(
    f"SELECT '{c}' AS " + '"column"' + f", quantile_cont({c}, 0.5) AS median FROM train"
    for c in S.NUMERIC + S.DERIVED)}""")
def medians_in_ranges(spark, sf):
    """The same with brackets narrowed until few values are left, as a large table needs it."""
    return exact_quantiles(_train_numbers(spark, sf), list(prep.NUMERIC), [0.5], in_order=50).select(
        "column", F.col("quantile").alias("median"))


@query("vocabulary", f"""
WITH {_TRAIN}
{' UNION ALL '.join(
    f"SELECT '{c}' AS " + '"column"' + f", {c} AS value, count(*) AS rows FROM train GROUP BY {c}"
    for c in S.CATEGORICAL)}""")
def vocabulary(spark, sf):
    return prep.vocabulary(_train_side(_featured(spark, sf)))


_SCALED = f"""
SELECT deployment_id, {', '.join(
    f"round((coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM train)) - "
    f"(SELECT avg(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM train))) FROM train)) / "
    f"(SELECT CASE WHEN stddev_pop(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM train)))"
    f" = 0 THEN 1 ELSE stddev_pop(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM train)))"
    f" END FROM train), 6) AS s_{c}"
    for c in S.NUMERIC + S.DERIVED)} FROM test
"""


@query("scaled_matrix", f"WITH {_TRAIN} {_SCALED}")
def scaled_matrix(spark, sf):
    train, test = _split(spark, sf)
    fitted = prep.fit(train)
    vector = fitted.apply(test)
    return vector.select("deployment_id", *[
        F.round(vector_to_array("features")[i], 6).alias(f"s_{c}") for i, c in enumerate(fitted.numeric)])


@query("one_hot_matrix", f"""
WITH {_TRAIN}, levels AS (SELECT *, row_number() OVER (ORDER BY block, value NULLS LAST) - 1 AS place FROM ({' UNION ALL '.join(
    f"SELECT DISTINCT {i} AS block, {c} AS value FROM train" for i, c in enumerate(S.CATEGORICAL))})),
test_long AS ({' UNION ALL '.join(
    f"SELECT deployment_id, {i} AS block, {c} AS value FROM test" for i, c in enumerate(S.CATEGORICAL))})
SELECT deployment_id, coalesce(string_agg(place::VARCHAR, ',' ORDER BY place), '') AS places
FROM test_long LEFT JOIN levels ON levels.block = test_long.block
  AND levels.value IS NOT DISTINCT FROM test_long.value GROUP BY 1""")
def one_hot_matrix(spark, sf):
    """Where the ones of each encoded row stand."""
    train, test = _split(spark, sf)
    return _places(prep.fit(train), test)


@query("fitted_state", ORACLES["one_hot_matrix"])
def fitted_state(spark, sf):
    """The same from a fitted state that was written and read back."""
    train, test = _split(spark, sf)
    path = new_path(spark, "state")
    prep.fit(train).to_table(spark).write.json(path)
    return _places(prep.Preprocessor.from_table(spark.read.json(path)), test)


def _places(fitted, test):
    n = len(fitted.numeric)
    encoded = F.slice(vector_to_array("features"), n + 1, fitted.width - n)
    marked = F.transform(encoded, lambda x, i: F.when(x == 1.0, i.cast("string")))
    return fitted.apply(test).select("deployment_id", F.array_join(F.array_compact(marked), ",").alias("places"))


_EARLY = f"""
{S.FEATURES},
early AS (SELECT * FROM feat WHERE deployment_date < TIMESTAMP '1995-01-05'),
later AS (SELECT * FROM feat WHERE deployment_date >= TIMESTAMP '1995-01-05')
"""


@query("ood_report", f"""
WITH {_EARLY}, long AS ({' UNION ALL '.join(
    f"SELECT deployment_id, '{c}' AS name, {c} AS value, EXISTS (SELECT 1 FROM early e "
    f"WHERE e.{c} IS NOT DISTINCT FROM later.{c}) AS seen FROM later"
    for c in S.CATEGORICAL)})
SELECT deployment_id, '{{' || coalesce(string_agg('"' || name || '":' ||
  CASE WHEN value IS NULL THEN 'null' ELSE '"' || value || '"' END, ',' ORDER BY name)
  FILTER (WHERE NOT seen), '') || '}}' AS unseen_categories FROM long GROUP BY 1""")
def ood_report(spark, sf):
    featured = materialise(_featured(spark, sf), "features")
    split = splits.split_by_time(featured, "deployment_date", cutoff="1995-01-05 00:00:00")
    return prep.fit(split.train).apply(split.test).select("deployment_id", "unseen_categories")


# --- metrics -------------------------------------------------------------------------

_SWEEP = f"""
{S.SCORED},
steps AS (SELECT i / 100.0::DOUBLE AS threshold FROM range(1, 100) t(i)),
sweep AS (
  SELECT threshold,
    sum(CASE WHEN probability < threshold AND label = 1 THEN 1 ELSE 0 END) AS false_negatives,
    sum(CASE WHEN probability >= threshold AND label = 0 THEN 1 ELSE 0 END) AS false_positives
  FROM scored, steps GROUP BY threshold)
"""


@query("threshold_sweep", f"""
WITH {_SWEEP}
SELECT threshold, false_negatives, false_positives,
  false_negatives * 5.0::DOUBLE + false_positives AS expected_cost FROM sweep""")
def threshold_sweep(spark, sf):
    return metrics.threshold_sweep(scored(spark, sf), RATIO)


@query("best_threshold", f"""
WITH {_SWEEP}
SELECT threshold, false_negatives * 5.0::DOUBLE + false_positives AS expected_cost
FROM sweep ORDER BY 2, 1 LIMIT 1""")
def best_threshold(spark, sf):
    return metrics.best_threshold(scored(spark, sf), RATIO)


def _confusion_sql(group: str, threshold: str) -> str:
    head = f"{group}, " if group else ""
    tail = f"GROUP BY {group}" if group else ""
    return f"""
  SELECT {head}{threshold} AS threshold,
    count(*) FILTER (WHERE probability < {threshold} AND label = 0) AS tn,
    count(*) FILTER (WHERE probability >= {threshold} AND label = 0) AS fp,
    count(*) FILTER (WHERE probability < {threshold} AND label = 1) AS fn,
    count(*) FILTER (WHERE probability >= {threshold} AND label = 1) AS tp,
    avg((probability - label) * (probability - label)) AS brier,
    avg(-CASE WHEN label = 1 THEN ln(greatest(least(probability, 1 - 1e-15), 1e-15))
         ELSE ln(1 - greatest(least(probability, 1 - 1e-15), 1e-15)) END) AS log_loss
  FROM scored {tail}"""


_RATES = """
threshold, tn AS true_negatives, fp AS false_positives, fn AS false_negatives,
tp AS true_positives, round((tp + tn) / (tp + tn + fp + fn)::DOUBLE, 9) AS accuracy,
round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp)::DOUBLE END, 9) AS precision,
round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn)::DOUBLE END, 9) AS recall,
round(CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp)::DOUBLE END, 9) AS specificity,
round(CASE WHEN tn + fp = 0 THEN 0 ELSE fp / (tn + fp)::DOUBLE END, 9) AS false_positive_rate,
round(CASE WHEN tp + fn = 0 THEN 0 ELSE fn / (tp + fn)::DOUBLE END, 9) AS false_negative_rate,
round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn)::DOUBLE END, 9) AS f1,
fn * 5.0::DOUBLE + fp AS expected_cost, round(brier, 9) AS brier, round(log_loss, 9) AS log_loss
"""
RATE_COLUMNS = ("accuracy", "precision", "recall", "specificity", "false_positive_rate",
                "false_negative_rate", "f1", "brier", "log_loss")


@query("confusion_metrics", f"""
WITH {S.SCORED}, c AS ({_confusion_sql('', '0.3::DOUBLE')}) SELECT {_RATES} FROM c""")
def confusion_metrics(spark, sf):
    return _rounded(metrics.binary_metrics(scored(spark, sf), F.lit(0.3), RATIO), *RATE_COLUMNS)


@query("brier_log_loss", f"""
WITH {S.SCORED}, c AS ({_confusion_sql('vendor_name', '0.3::DOUBLE')})
SELECT vendor_name, round(brier, 9) AS brier, round(log_loss, 9) AS log_loss FROM c""")
def brier_log_loss(spark, sf):
    return _rounded(metrics.binary_metrics(
        scored(spark, sf), F.lit(0.3), RATIO, ["vendor_name"]), "brier", "log_loss"
    ).select("vendor_name", "brier", "log_loss")


def _curve(group: str) -> str:
    part = f"PARTITION BY {group}" if group else ""
    head = f"{group}, " if group else ""
    return f"""
  SELECT {head}probability, sum(label) AS pos, sum(1 - label) AS neg,
    sum(sum(label)) OVER ({part} ORDER BY probability DESC) AS tp,
    sum(sum(1 - label)) OVER ({part} ORDER BY probability DESC) AS fp,
    sum(sum(label)) OVER ({part}) AS p, sum(sum(1 - label)) OVER ({part}) AS n,
    row_number() OVER ({part} ORDER BY probability DESC) AS i,
    count(*) OVER ({part}) AS points
  FROM scored GROUP BY {head}probability"""


@query("roc_auc", f"""
WITH {S.SCORED}, c AS ({_curve('')})
SELECT round(sum(neg * (tp - pos / 2.0::DOUBLE)) / (max(p) * max(n)), 9) AS roc_auc FROM c""")
def roc_auc(spark, sf):
    return _rounded(metrics.ranking_metrics(scored(spark, sf)), "roc_auc").select("roc_auc")


@query("average_precision", f"""
WITH {S.SCORED}, c AS ({_curve('')})
SELECT round(sum(pos * (tp / (tp + fp)::DOUBLE)) / max(p), 9) AS average_precision FROM c""")
def average_precision(spark, sf):
    return _rounded(metrics.ranking_metrics(scored(spark, sf)), "average_precision").select(
        "average_precision")


@query("ranking_by_vendor", f"""
WITH {S.SCORED}, c AS ({_curve('vendor_name')})
SELECT vendor_name, round(sum(neg * (tp - pos / 2.0::DOUBLE)) / (max(p) * max(n)), 9) AS roc_auc,
  round(sum(pos * (tp / (tp + fp)::DOUBLE)) / max(p), 9) AS average_precision
FROM c GROUP BY 1""")
def ranking_by_vendor(spark, sf):
    return _rounded(metrics.ranking_metrics(scored(spark, sf), ["vendor_name"]),
                    "roc_auc", "average_precision")


@query("roc_points", f"""
WITH {S.SCORED}, c AS ({_curve('')}),
d AS (SELECT *, lead(pos) OVER (ORDER BY i) AS np, lead(neg) OVER (ORDER BY i) AS nn FROM c)
SELECT round(fp / n::DOUBLE, 9) AS false_positive_rate, round(tp / p::DOUBLE, 9) AS true_positive_rate,
  round(probability, 9) AS threshold
FROM d WHERE i = 1 OR i = points OR np <> pos OR nn <> neg
UNION ALL SELECT 0, 0, 'inf'::DOUBLE""")
def roc_points(spark, sf):
    out = metrics.roc_points(scored(spark, sf))
    return _rounded(out, "false_positive_rate", "true_positive_rate").withColumn(
        "threshold", F.when(F.col("threshold") == float("inf"), F.col("threshold"))
        .otherwise(F.round("threshold", 9)))


@query("pr_points", f"""
WITH {S.SCORED}, c AS ({_curve('')})
SELECT round(tp / p::DOUBLE, 9) AS recall, round(tp / (tp + fp)::DOUBLE, 9) AS precision,
  round(probability, 9) AS threshold FROM c""")
def pr_points(spark, sf):
    return _rounded(metrics.pr_points(scored(spark, sf)), "recall", "precision", "threshold")


_FOLD_SCORED = f"""
{S.SCORED}, {_FOLDS},
fold_scored AS (SELECT fold, label, probability FROM scored
  JOIN folds ON deployment_date <= last_date AND deployment_date >= folds.cutoff)
"""


@query("fold_metrics", f"""
WITH {_FOLD_SCORED}, c AS ({_confusion_sql('fold', '0.3::DOUBLE').replace('FROM scored', 'FROM fold_scored')}),
r AS ({_curve('fold').replace('FROM scored', 'FROM fold_scored')})
SELECT fold, {_RATES}, (SELECT round(sum(neg * (tp - pos / 2.0::DOUBLE)) / (max(p) * max(n)), 9)
    FROM r WHERE r.fold = c.fold) AS roc_auc,
  (SELECT round(sum(pos * (tp / (tp + fp)::DOUBLE)) / max(p), 9) FROM r WHERE r.fold = c.fold)
    AS average_precision FROM c""")
def fold_metrics(spark, sf):
    bounds = _fold_bounds(deployments(spark, sf, _DATES))
    held = splits.fold_sides(scored(spark, sf), "deployment_date", bounds).where(
        F.col("side") == "validation")
    return _rounded(metrics.evaluate(held, F.lit(0.3), RATIO, ["fold"]),
                    *RATE_COLUMNS, "roc_auc", "average_precision")


_TRIED = ORACLES["fold_metrics"]


@query("selected_trials", f"""
WITH t AS (SELECT 'trial-' || fold AS trial, CASE WHEN fold % 2 = 1 THEN 'logistic' ELSE 'boosted' END AS family,
  fold, expected_cost, roc_auc FROM ({_TRIED})),
r AS (SELECT *, row_number() OVER (PARTITION BY family ORDER BY expected_cost, coalesce(roc_auc, 0) DESC, fold) AS own,
  row_number() OVER (ORDER BY expected_cost, coalesce(roc_auc, 0) DESC, family = 'boosted', fold) AS place FROM t)
SELECT family, trial, expected_cost, place = 1 AS preferred FROM r WHERE own = 1""")
def selected_trials(spark, sf):
    """The best trial of each family and the best of all, every fold standing for a trial."""
    trials = materialise(fold_metrics(spark, sf).select(
        F.concat(F.lit("trial-"), "fold").alias("trial"),
        F.when(F.col("fold") % 2 == 1, "logistic").otherwise("boosted").alias("family"),
        F.format_string('{"fold": %03d}', "fold").alias("params"), "expected_cost", "roc_auc"))
    first = models.preferred(trials).select("trial", F.lit(True).alias("preferred"))
    return models.family_best(trials).join(first, "trial", "left").select(
        "family", "trial", "expected_cost", F.coalesce("preferred", F.lit(False)).alias("preferred"))


@query("isotonic_calibration", f"""
WITH {S.SCORED},
d AS (SELECT probability, sum(label)::DOUBLE AS s, count(*)::DOUBLE AS w, row_number() OVER (ORDER BY probability) AS i
  FROM scored GROUP BY 1),
c AS (SELECT *, sum(s) OVER (ORDER BY i) AS upto_s, sum(w) OVER (ORDER BY i) AS upto_w FROM d),
spans AS (SELECT j.i AS j, k.i AS k, min((k.upto_s - j.upto_s + j.s) / (k.upto_w - j.upto_w + j.w))
    OVER (PARTITION BY j.i ORDER BY k.i DESC) AS low FROM c j JOIN c k ON k.i >= j.i)
SELECT probability, round(max(low), 9) AS calibrated FROM spans JOIN c ON c.i = spans.k GROUP BY 1""")
def isotonic_calibration(spark, sf):
    """Every score with its calibrated value; the restatement is the min-max formula."""
    rows = scored(spark, sf).select("probability", F.col("label").cast("double"))
    fitted = models.fit_calibrator(rows, "probability")
    return fitted.transform(rows.select("probability").distinct()).select(
        "probability", F.round("prediction", 9).alias("calibrated"))


@query("class_report", f"""
WITH {S.SCORED}, c AS ({_confusion_sql('', '0.3::DOUBLE')}),
k AS (SELECT 'success' AS class, tn / (tn + fn)::DOUBLE AS precision, tn / (tn + fp)::DOUBLE AS recall,
        2 * tn / (2 * tn + fn + fp)::DOUBLE AS f1, tn + fp AS support FROM c
      UNION ALL SELECT 'risky', tp / (tp + fp)::DOUBLE, tp / (tp + fn)::DOUBLE,
        2 * tp / (2 * tp + fn + fp)::DOUBLE, tp + fn FROM c),
u AS (SELECT * FROM k
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM k
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
    sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM k)
SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1,
  support FROM u""")
def class_report(spark, sf):
    return _rounded(metrics.class_report(scored(spark, sf), F.lit(0.3)),
                    "precision", "recall", "f1")


# --- decisions, runs and fleet -------------------------------------------------------

_DECIDED = f"""
{S.SCORED},
scores AS (
  SELECT deployment_id, vendor_name, deployment_type, device_type, round(probability, 4)
      AS risk_probability,
    CASE WHEN probability >= 0.4::DOUBLE THEN 'NO_GO' ELSE 'GO' END AS risk_prediction,
    CASE WHEN probability >= 0.4::DOUBLE THEN 'HIGH' WHEN probability >= 0.2::DOUBLE
         THEN 'MEDIUM' ELSE 'LOW' END AS risk_band,
    CASE WHEN device_type IS NULL THEN '{{"device_type":null}}' ELSE '{{}}' END
      AS unseen_categories,
    strftime(date_trunc('month', deployment_date), '%Y-%m-%d') AS scored_at, o_orderkey
  FROM scored)
"""


def _scores(spark, sf):
    df = scored(spark, sf).withColumn(
        "unseen_categories",
        F.when(F.col("device_type").isNull(), '{"device_type":null}').otherwise("{}"))
    return df, scoring.decide(df, 0.4, "run-1")


def _scored_history(spark, sf):
    """Every deployment scored in the month it was planned: one run per month."""
    df, _ = _scores(spark, sf)
    p = F.col("probability")
    return df.select(
        "deployment_id", "vendor_name", "deployment_type",
        F.round(p, 4).alias("risk_probability"),
        scoring.decision(p, F.lit(0.4)).alias("risk_prediction"),
        scoring.band(p, F.lit(0.4)).alias("risk_band"), "unseen_categories",
        F.date_format(F.date_trunc("month", "deployment_date"), DAY).alias("scored_at"))


@query("decisions", f"""
WITH {_DECIDED}
SELECT deployment_id, risk_probability, risk_prediction, risk_band, unseen_categories,
  'run-1' AS model_run FROM scores""")
def decisions(spark, sf):
    return _scores(spark, sf)[1]


_SUMMARY = """
count(*) AS total, count(*) FILTER (WHERE risk_prediction = 'GO') AS go,
count(*) FILTER (WHERE risk_prediction = 'NO_GO') AS no_go,
count(*) FILTER (WHERE risk_band = 'HIGH') AS high,
count(*) FILTER (WHERE risk_band = 'MEDIUM') AS medium,
count(*) FILTER (WHERE risk_band = 'LOW') AS low,
round(avg(risk_probability), 9) AS average_probability,
count(*) FILTER (WHERE unseen_categories <> '{}') AS unseen_rows
"""


@query("run_summary", f"WITH {_DECIDED} SELECT {_SUMMARY} FROM scores")
def run_summary(spark, sf):
    return _rounded(scoring.run_summary(_scores(spark, sf)[1]), "average_probability")


@query("run_summaries", f"""
WITH {_DECIDED} SELECT scored_at, {_SUMMARY} FROM scores GROUP BY scored_at""")
def run_summaries(spark, sf):
    return _rounded(scoring.run_summary(_scored_history(spark, sf), ["scored_at"]),
                    "average_probability")


@query("unseen_rows", f"""
WITH {_DECIDED}
SELECT deployment_id, unseen_categories FROM scores WHERE unseen_categories <> '{{}}'""")
def unseen_rows(spark, sf):
    return scoring.unseen_rows(_scores(spark, sf)[1])


@query("newest_run", f"""
WITH {_DECIDED}
SELECT deployment_id, scored_at, risk_band FROM scores
WHERE scored_at = (SELECT max(scored_at) FROM scores)""")
def newest_run(spark, sf):
    return fleet.newest_run(_scored_history(spark, sf)).select(
        "deployment_id", "scored_at", "risk_band")


_SMOKE = """
smoked AS (SELECT *, CASE WHEN scored_at >= '2001-07-01' THEN 'smoke-' || deployment_id
                          ELSE deployment_id END AS id FROM scores),
real AS (SELECT scored_at FROM smoked GROUP BY 1 HAVING NOT bool_and(starts_with(id, 'smoke-')))
"""


@query("newest_real_run", f"""
WITH {_DECIDED}, {_SMOKE}
SELECT id AS deployment_id, scored_at, risk_band FROM smoked
WHERE scored_at = (SELECT max(scored_at) FROM real)""")
def newest_real_run(spark, sf):
    smoked = _scored_history(spark, sf).withColumn(
        "deployment_id",
        F.when(F.col("scored_at") >= "2001-07-01", F.concat(F.lit("smoke-"), "deployment_id"))
        .otherwise(F.col("deployment_id")))
    return fleet.newest_real_run(smoked).select("deployment_id", "scored_at", "risk_band")


@query("upcoming_scores", f"""
WITH {_DECIDED}, {_SMOKE}, newest AS (
  SELECT id, scored_at, risk_probability, risk_prediction, risk_band FROM smoked
  WHERE scored_at = (SELECT max(scored_at) FROM real))
SELECT s.deployment_id, n.risk_probability, n.risk_prediction, n.risk_band, n.scored_at
FROM scores s LEFT JOIN newest n ON n.id = s.deployment_id""")
def upcoming_scores(spark, sf):
    smoked = _scored_history(spark, sf).withColumn(
        "deployment_id",
        F.when(F.col("scored_at") >= "2001-07-01", F.concat(F.lit("smoke-"), "deployment_id"))
        .otherwise(F.col("deployment_id")))
    return fleet.upcoming_with_scores(deployments(spark, sf, ("deployment_id",)), smoked).select(
        "deployment_id", "risk_probability", "risk_prediction", "risk_band", "scored_at")


@query("run_list", f"WITH {_DECIDED} SELECT scored_at, count(*) AS rows FROM scores GROUP BY 1")
def run_list(spark, sf):
    return fleet.run_list(_scored_history(spark, sf))


@query("fleet_by_band", f"""
WITH {_DECIDED}, b AS (SELECT unnest(['HIGH', 'MEDIUM', 'LOW']) AS risk_band)
SELECT b.risk_band, count(deployment_id) AS rows FROM b LEFT JOIN scores USING (risk_band)
GROUP BY 1""")
def fleet_by_band(spark, sf):
    return fleet.band_counts(_scores(spark, sf)[1])


def _fleet(spark, sf):
    inputs = deployments(spark, sf, (
        "deployment_id", "vendor_name", "device_type", "hardware_series", "current_firmware",
        "target_firmware", "deployment_type"))
    return fleet.with_inputs(_scores(spark, sf)[1], inputs)


@query("nogo_by_vendor", f"""
WITH {_DECIDED}
SELECT vendor_name, count(*) AS rows FROM scores WHERE risk_prediction = 'NO_GO'
  AND vendor_name IS NOT NULL GROUP BY 1""")
def nogo_by_vendor(spark, sf):
    return fleet.nogo_by(_fleet(spark, sf))


@query("counts_by_type", f"""
WITH {_DECIDED} SELECT deployment_type, count(*) AS rows FROM scores GROUP BY 1""")
def counts_by_type(spark, sf):
    return fleet.counts_by(_fleet(spark, sf))


@query("fleet_register", f"""
WITH {_DECIDED}
SELECT s.deployment_id, d.vendor_name, d.device_type, d.hardware_series, d.current_firmware,
  d.target_firmware, risk_probability, risk_prediction, risk_band
FROM scores s JOIN dep d USING (deployment_id)
WHERE risk_band IN ('HIGH', 'MEDIUM') AND risk_prediction = 'NO_GO'
  AND d.vendor_name IN ('BUILDING', 'MACHINERY')""")
def fleet_register(spark, sf):
    return fleet.register(_fleet(spark, sf), bands=["HIGH", "MEDIUM"], decisions=["NO_GO"],
                          vendors=["BUILDING", "MACHINERY"])


@query("scores_with_inputs", f"""
WITH {_DECIDED}
SELECT s.deployment_id, s.risk_band, s.device_type, d.current_firmware
FROM scores s LEFT JOIN dep d USING (deployment_id)""")
def scores_with_inputs(spark, sf):
    return _fleet(spark, sf).select(
        "deployment_id", "risk_band", "device_type", "current_firmware")


@query("run_constants", f"""
WITH {S.SCORED}, r AS (
  SELECT strftime(date_trunc('month', deployment_date), '%Y-%m-%d') AS scored_at,
    CASE WHEN month(deployment_date) = 3 THEN CASE WHEN label = 1 THEN '0.4' ELSE '0.3' END
         WHEN month(deployment_date) = 4 THEN NULL ELSE '0.35' END AS threshold FROM scored)
SELECT scored_at, CASE WHEN min(threshold) = max(threshold) THEN min(threshold) END AS threshold
FROM r GROUP BY 1""")
def run_constants(spark, sf):
    return scoring.run_constants(_threshold_history(spark, sf), ["threshold"], ["scored_at"])


def _threshold_history(spark, sf):
    month = F.month("deployment_date")
    return scored(spark, sf).select(
        F.date_format(F.date_trunc("month", "deployment_date"), DAY).alias("scored_at"),
        F.when(month == 3, F.when(F.col("label") == 1, "0.4").otherwise("0.3"))
        .when(month == 4, F.lit(None)).otherwise("0.35").alias("threshold"))


@query("threshold_attribution", f"""
WITH {S.SCORED}, r AS (
  SELECT strftime(date_trunc('month', deployment_date), '%Y-%m-%d') AS scored_at,
    CASE WHEN month(deployment_date) = 3 THEN CASE WHEN label = 1 THEN '0.4' ELSE '0.3' END
         WHEN month(deployment_date) = 4 THEN NULL ELSE '0.35' END AS threshold FROM scored),
c AS (SELECT scored_at, CASE WHEN min(threshold) = max(threshold) THEN min(threshold) END AS t
  FROM r GROUP BY 1)
SELECT scored_at, coalesce(t::DOUBLE, 0.19::DOUBLE) AS threshold,
  CASE WHEN t IS NULL THEN 'champion' ELSE 'run' END AS source FROM c""")
def threshold_attribution(spark, sf):
    return scoring.attributed_threshold(_threshold_history(spark, sf), 0.19, ["scored_at"])


@query("run_gate", f"""
WITH {S.SCORED}, m AS (
  SELECT vendor_name AS model, strftime(date_trunc('month', deployment_date), '%Y-%m-%d') AS run_at,
    round(avg(probability) + 0.3::DOUBLE, 6) AS roc_auc,
    round(sum(CASE WHEN label = 1 AND probability >= 0.02::DOUBLE THEN 1 ELSE 0 END)
      / sum(label)::DOUBLE, 6) AS recall,
    count(*) FILTER (WHERE past_failure_count IS NULL) AS warnings
  FROM scored GROUP BY ALL),
g AS (SELECT *, max(roc_auc) OVER (PARTITION BY model ORDER BY run_at
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM m)
SELECT model, run_at, roc_auc, recall, warnings,
  round(coalesce(best, 0.65::DOUBLE) - 0.02::DOUBLE, 6) AS required_auc,
  CASE WHEN best IS NULL THEN 'floor' ELSE 'earlier runs' END AS basis,
  coalesce(roc_auc >= coalesce(best, 0.65::DOUBLE) - 0.02::DOUBLE, false) AS auc_ok,
  coalesce(recall >= 0.90::DOUBLE, false) AS recall_ok, warnings = 0 AS warnings_ok,
  coalesce(roc_auc >= coalesce(best, 0.65::DOUBLE) - 0.02::DOUBLE AND recall >= 0.90::DOUBLE
    AND warnings = 0, false) AS passed FROM g""")
def run_gate(spark, sf):
    table_of_runs = scored(spark, sf).groupBy(
        F.col("vendor_name").alias("model"),
        F.date_format(F.date_trunc("month", "deployment_date"), DAY).alias("run_at"),
    ).agg(
        F.round(F.avg("probability") + 0.3, 6).alias("roc_auc"),
        F.round(F.try_divide(
            F.count_if((F.col("label") == 1) & (F.col("probability") >= 0.02)),
            F.sum("label")), 6).alias("recall"),
        F.count_if(F.col("past_failure_count").isNull()).alias("warnings"))
    return _rounded(runs.run_gate(table_of_runs), "required_auc", digits=6)
