from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from shiplens.functions.values import clean_missing, number_text, strict_double, strip, token_estimate
from shiplens.operators import contract as ct
from tests.frames import frame, training_rows

C = ct.DEPLOYMENTS


def broken(spark, **changes):
    rows = training_rows(8)
    rows[2].update(changes)
    return frame(spark, rows)


def test_valid_table_is_coerced(spark):
    out = ct.validate(frame(spark, training_rows(8)))
    assert dict(out.dtypes)["uptime_days"] == "double"
    assert dict(out.dtypes)["deployment_date"] == "timestamp"
    assert out.count() == 8


@pytest.mark.parametrize("changes, word", [
    ({"deployment_outcome": "ROLLBACK_REQUIRED"}, "invalid_outcome"),
    ({"deployment_outcome": None}, "invalid_outcome"),
    ({"deployment_date": "soon"}, "unparseable_date"),
    ({"uptime_days": "not-a-number"}, "non_numeric:uptime_days"),
    ({"uptime_days": "1d"}, "non_numeric:uptime_days"),
    ({"deployment_id": "deployment-0001"}, "1 deployment_id values occur more than once"),
])
def test_each_defect_stops_the_table(spark, changes, word):
    with pytest.raises(ct.ContractViolation, match=word):
        ct.validate(broken(spark, **changes))


def test_every_offender_comes_with_the_violation(spark):
    rows = training_rows(60)
    for i, row in enumerate(rows):
        row["uptime_days"] = f"bad {i}"
    with pytest.raises(ct.ContractViolation) as caught:
        ct.validate(frame(spark, rows))
    assert {r["value"] for r in caught.value.offenders.collect()} == {f"bad {i}" for i in range(60)}
    rows = training_rows(60)
    for i, row in enumerate(rows):
        row["deployment_id"] = f"d{i // 2}"
    with pytest.raises(ct.ContractViolation, match="30") as caught:
        ct.validate(frame(spark, rows))
    assert {r["deployment_id"] for r in caught.value.offenders.collect()} == {f"d{i}" for i in range(30)}


def test_columns_outside_the_contract_are_warned_of(spark):
    with pytest.warns(UserWarning, match="extra"):
        ct.validate(frame(spark, training_rows(4)).withColumn("extra", F.lit(1)))


def test_missing_columns_are_named(spark):
    df = frame(spark, training_rows(4)).drop("deployment_date", "cve_count")
    with pytest.raises(ct.ContractViolation, match="cve_count.*deployment_date"):
        ct.validate(df)
    assert ct.unexpected_columns(df.withColumn("x", F.lit(1)), C) == ["x"]


def test_scoring_does_not_parse_dates(spark):
    scoring = C.scoring()
    df = broken(spark, deployment_date="soon").select(*scoring.columns)
    assert ct.validate(df, scoring).where("deployment_date = 'soon'").count() == 1


def test_quarantine_keeps_every_row_once(spark):
    rows = training_rows(10)
    rows[1]["deployment_id"] = rows[0]["deployment_id"]
    rows[4]["uptime_days"], rows[4]["deployment_date"] = "x", "soon"
    rows[5]["deployment_id"] = rows[6]["deployment_id"] = None
    good, bad = ct.split_valid(frame(spark, rows))
    assert good.count() == 5
    reasons = {tuple(r["reasons"]) for r in bad.collect()}
    assert reasons == {("duplicate_key",), ("unparseable_date", "non_numeric:uptime_days")}
    assert bad.count() == 5


def test_null_counts_come_from_one_pass(spark):
    rows = training_rows(6)
    rows[0]["cve_count"] = rows[3]["cve_count"] = None
    out = {r["column"]: r["nulls"] for r in
           ct.null_counts(ct.validate(frame(spark, rows)), C.numeric).collect()}
    assert out["cve_count"] == 2 and out["uptime_days"] == 0


def test_missing_tokens_and_nan_become_null(spark):
    df = spark.createDataFrame(
        [("NA", float("nan")), ("", 1.0), ("None", 2.0), ("x", 3.0)], "a string, b double")
    rows = clean_missing(df).collect()
    assert [r["a"] for r in rows] == [None, None, None, "x"]
    assert rows[0]["b"] is None and rows[3]["b"] == 3.0


@pytest.mark.parametrize("text, value", [
    (" 4 ", 4.0), ("+4", 4.0), ("1e3", 1000.0), (".5", 0.5), ("1d", None), ("1_0", None),
    ("0x1", None), ("inf", float("inf")), ("", None), ("4.", 4.0),
])
def test_strict_numbers(spark, text, value):
    row = spark.createDataFrame([(text,)], "t string").select(strict_double(F.col("t"))).first()
    assert row[0] == value


def test_number_text_reads_like_python(spark):
    values = [7.0, 0.1, 12345678.0, 1.5e15, 0.00012, 1234567.25, 1e16]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(number_text(F.col("v"))).collect()][:6] == [
        repr(v) for v in values][:6]


def test_text_helpers(spark):
    text = "  one  two three \n"
    row = spark.createDataFrame([(text,)], "t string").select(
        strip(F.col("t")), token_estimate(F.col("t"))).first()
    assert row[0] == text.strip() and row[1] == int(len(text.split()) * 1.3)


def test_declared_casts_leave_bad_columns_alone(spark):
    df = ct.cast_declared(broken(spark, uptime_days="x"), ("uptime_days", "cve_count"))
    assert dict(df.dtypes)["uptime_days"] == "string"
    assert dict(df.dtypes)["cve_count"] == "double"


def test_rows_of_heavy_and_missing_keys_do_not_meet_in_one_task(spark):
    rows = training_rows(40)
    base = frame(spark, rows).crossJoin(spark.range(30).select(F.col("id").alias("n")))  # a small fixture
    kind = F.pmod(F.hash("deployment_id", "n"), F.lit(3))
    fed = base.withColumn("deployment_id", F.when(kind == 0, F.lit(None)).when(kind == 1, F.lit("hot")).otherwise(
        F.concat("deployment_id", F.lit("-"), "n"))).drop("n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled",
                                             "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "12")
        tagged = ct.with_reasons(fed, C, heavy_rows=50)
        again = F.array_contains("reasons", "duplicate_key")
        got = tagged.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
        sizes = sorted(r["n"] for r in got)
        assert sum(sizes) == 1200 and sizes[-1] < 3 * sizes[len(sizes) // 2]
        assert tagged.where(again != (F.col("deployment_id").isNull() | (F.col("deployment_id") == "hot"))).count() == 0
        assert set(tagged.columns) == {*fed.columns, "reasons"}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("ids, want", [([None], []), ([None, None], [None, None]), (["a", None, "a"], ["a", "a"]), (["a", "b"], [])])
def test_few_repeated_or_missing_keys(spark, ids, want):
    rows = training_rows(len(ids))
    for row, i in zip(rows, ids):
        row["deployment_id"] = i
    tagged = ct.with_reasons(frame(spark, rows), C)
    assert [r["deployment_id"] for r in tagged.where(F.array_contains("reasons", "duplicate_key")).collect()] == want
    assert tagged.count() == len(ids)


def test_the_join_carries_reasons_and_not_what_rules_read(spark):
    df = spark.createDataFrame([("a", "SUCCESS", "soon", "1", "x" * 50)], "deployment_id string, deployment_outcome string, deployment_date string, uptime_days string, extra string")
    fed = df.select("*", *[F.lit("1").alias(c) for c in C.columns if c not in df.columns])
    plan = ct.with_reasons(fed, C).select("reasons")._jdf.queryExecution().optimizedPlan().toString()
    top, left = plan.splitlines()[1:3]
    assert re.search(r"Join LeftOuter, .*_mine#\d+ = _deal#\d+", top)
    assert "_rules" in plan.splitlines()[0] and not re.search(r"(\[|, )deployment_outcome#\d+[,\]]", left)
    assert [r["reasons"] for r in ct.with_reasons(fed, C).collect()] == [["unparseable_date"]]
