from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shiplens.functions import flags as fl
from shiplens.functions.narrative import context_block, query_text
from shiplens.functions.versions import jump_band, major
from shiplens.operators import features as ft
from shiplens.operators.contract import DEPLOYMENTS, ContractViolation, validate
from tests.frames import frame, training_rows


def checked(spark, rows):
    return validate(frame(spark, rows))


@pytest.mark.parametrize("text, value", [
    ("4.2.0", 4), (" 4 .1", 4), ("+4", 4), ("-3.1", -3), ("v4.1", None), ("", None), ("10", 10),
])
def test_major(spark, text, value):
    assert spark.createDataFrame([(text,)], "t string").select(major(F.col("t"))).first()[0] == value


def test_downgrade_stays_negative_and_unsafe_columns_go(spark):
    rows = training_rows(4)
    rows[0].update(current_firmware="4.2.0", target_firmware="2.0.0")
    rows[1].update(current_firmware="junk", target_firmware="2.0.0")
    rows[2].update(deployment_type="EMERGENCY", maintenance_window=None, kernel_touched=None,
                   bootloader_touched=None)
    out = {r["deployment_id"]: r for r in ft.derive(checked(spark, rows)).collect()}
    assert out["deployment-0000"]["major_version_jump"] == -2.0
    assert out["deployment-0000"]["major_version_changed"] == 1.0
    assert out["deployment-0001"]["major_version_changed"] is None
    assert out["deployment-0002"]["emergency_no_maintenance"] == 0.0
    assert out["deployment-0002"]["core_system_touched"] == 0.0
    assert [out[f"deployment-000{i}"]["deployment_risk"] for i in range(4)] == [0, 1, 0, 1]
    kept = set(ft.derive(checked(spark, rows)).columns)
    assert not kept & {"device_id", "time_to_failure_hours", "rollback_required",
                       "current_firmware"}
    assert "deployment_date" not in ft.model_inputs(ft.derive(checked(spark, rows))).columns


def test_parse_failures_over_one_percent_stop_training(spark):
    rows = training_rows(100)
    rows[0]["current_firmware"] = "x"
    ft.require_parseable(checked(spark, rows))
    rows[1]["current_firmware"] = "y"
    with pytest.raises(ContractViolation, match="2 of 100"):
        ft.require_parseable(checked(spark, rows))


def test_flag_vocabularies_differ_where_they_should(spark):
    rows = training_rows(3)
    rows[0].update(current_firmware="5.0", target_firmware="4.0", past_failure_count=1,
                   network_stress_score=0.66, max_cvss_score=None)
    row = checked(spark, rows).where("deployment_id = 'deployment-0000'").select(
        fl.raised(fl.page_flag_conditions()).alias("page"),
        fl.raised(fl.corpus_flag_conditions()).alias("corpus")).first()
    assert "major_version_changed" in row["page"] and "repeat_failure_device" in row["page"]
    assert "major_version_jump" not in row["corpus"]
    assert "repeat_failure_device" not in row["corpus"]
    assert "high_network_stress" in row["corpus"] and "high_network_stress" not in row["page"]
    assert "high_cvss" not in row["page"]


def test_masks_round_trip(spark):
    df = spark.createDataFrame([(["kernel_touched", "tier_1_device"],)], "f array<string>")
    mask = df.select(fl.flags_mask(F.col("f")).alias("m"))
    assert mask.select(fl.flags_from_mask(F.col("m"))).first()[0] == [
        "kernel_touched", "tier_1_device"]


def test_bands(spark):
    df = spark.createDataFrame([(8.0,), (7.99,), (5.0,), (4.9,), (None,)], "m double")
    assert [r[0] for r in df.select(jump_band(F.col("m"))).collect()] == [
        "extreme", "major", "major", None, None]


def test_texts(spark):
    rows = training_rows(1)
    rows[0].update(max_cvss_score=None, maintenance_window=None)
    df = checked(spark, rows).withColumn("flags", F.array().cast("array<string>"))
    text = df.select(query_text(F.col("flags"))).first()[0]
    assert text == (
        "historical failures for Cisco ROUTER firmware upgrade 1.2.0 to 2.0.1 risk flags: no "
        "major flags CVSS score nan site criticality LOW deployment type STANDARD")
    assert "deployment-" not in text
    block = df.withColumns({
        "risk_probability": F.lit(0.256789), "risk_band": F.lit("HIGH"),
        "risk_prediction": F.lit("NO_GO")}).select(
        context_block(F.col("flags"), scored=True)).first()[0].split("\n")
    assert block[4] == "Major version: 1 -> 2"
    assert block[7] == "Maintenance window: unknown"
    assert block[11] == "Model score: HIGH / NO_GO (probability 0.2568, about 26%)"
    assert block[12] == "Active Risk Flags: none"


def test_feature_profile(spark):
    rows = training_rows(8)
    rows[0]["cve_count"] = None
    rows[1]["current_firmware"] = "x"
    table = {(r["section"], r["name"], r["value"]): r["n"]
             for r in ft.feature_profile(ft.derive(checked(spark, rows))).collect()}
    assert table["rows", "rows", None] == 8
    assert table["nulls", "cve_count", None] == 1
    assert table["firmware_parse_failures", "major_version_jump", None] == 1
    assert table["label_rate", "deployment_risk", None] == 0.5
    assert table["outcome", "deployment_outcome", "SUCCESS"] == 4
    assert table["vocabulary", "vendor_name", "Cisco"] == 2
    assert DEPLOYMENTS.key == "deployment_id"
