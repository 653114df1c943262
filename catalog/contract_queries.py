"""Contract checks, features, flags and texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import table_sql as S
from catalog.registry import query
from catalog.tables import deployments, raw_feed, table
from shiplens.functions import flags as fl
from shiplens.functions.narrative import context_block, query_text
from shiplens.functions.values import content_hash, token_estimate
from shiplens.functions.versions import jump_band, major, major_jump
from shiplens.operators import contract as ct
from shiplens.operators import features as ft

C = ct.DEPLOYMENTS


@query("contract_null_counts", f"""
WITH {S.DEPLOYMENTS}
SELECT * FROM ({' UNION ALL '.join(
    f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
    f"count(*) AS rows FROM dep" for c in S.NUMERIC)})""")
def contract_null_counts(spark, sf):
    return ct.null_counts(deployments(spark, sf), C.numeric)


@query("contract_duplicates", f"""
WITH {S.RAW_FEED}
SELECT deployment_id, count(*) AS rows FROM raw GROUP BY 1 HAVING count(*) > 1""")
def contract_duplicates(spark, sf):
    return ct.duplicate_keys(raw_feed(spark, sf), C)


_BAD_ROWS = """
  SELECT 'invalid_outcome' AS rule, 'deployment_outcome' AS column,
    coalesce(deployment_outcome, '<missing>') AS value FROM raw
    WHERE coalesce(deployment_outcome, '') NOT IN ('SUCCESS','DEGRADED','ROLLBACK','FAILED')
  UNION ALL SELECT 'unparseable_date', 'deployment_date', deployment_date FROM raw
    WHERE TRY_CAST(deployment_date AS TIMESTAMP) IS NULL
  UNION ALL SELECT 'non_numeric:kernel_touched', 'kernel_touched', kernel_touched FROM raw
    WHERE kernel_touched IS NOT NULL AND TRY_CAST(kernel_touched AS DOUBLE) IS NULL
  UNION ALL SELECT 'non_numeric:uptime_days', 'uptime_days', uptime_days FROM raw
    WHERE uptime_days IS NOT NULL AND TRY_CAST(uptime_days AS DOUBLE) IS NULL
"""


@query("contract_offenders", f"""
WITH {S.RAW_FEED}, bad AS ({_BAD_ROWS})
SELECT rule, "column", value, count(*) AS rows FROM bad GROUP BY ALL""")
def contract_offenders(spark, sf):
    return ct.offenders(raw_feed(spark, sf), C)


@query("contract_vocabulary", f"""
WITH {S.RAW_FEED}, bad AS ({_BAD_ROWS})
SELECT value, count(*) AS rows FROM bad WHERE rule = 'invalid_outcome' GROUP BY 1""")
def contract_vocabulary(spark, sf):
    bad = ct.offenders(raw_feed(spark, sf), C)
    return bad.where(F.col("rule") == "invalid_outcome").select("value", "rows")


@query("contract_date_check", f"""
WITH {S.RAW_FEED}
SELECT count(*) AS rows,
  count(*) FILTER (WHERE TRY_CAST(deployment_date AS TIMESTAMP) IS NULL) AS bad,
  strftime(min(TRY_CAST(deployment_date AS TIMESTAMP)), '%Y-%m-%d') AS first_date,
  strftime(max(TRY_CAST(deployment_date AS TIMESTAMP)), '%Y-%m-%d') AS last_date
FROM raw""")
def contract_date_check(spark, sf):
    day = ct.parsed_date(F.col("deployment_date"), C)
    return raw_feed(spark, sf).agg(
        F.count("*").alias("rows"), F.count_if(day.isNull()).alias("bad"),
        F.date_format(F.min(day), "yyyy-MM-dd").alias("first_date"),
        F.date_format(F.max(day), "yyyy-MM-dd").alias("last_date"))


@query("contract_quarantine", f"""
WITH {S.RAW_FEED}, dup AS (
  SELECT deployment_id FROM raw GROUP BY 1 HAVING count(*) > 1),
tagged AS (
  SELECT concat_ws(',',
    CASE WHEN deployment_id IN (SELECT deployment_id FROM dup) THEN 'duplicate_key' END,
    CASE WHEN coalesce(deployment_outcome, '') NOT IN
      ('SUCCESS','DEGRADED','ROLLBACK','FAILED') THEN 'invalid_outcome' END,
    CASE WHEN TRY_CAST(deployment_date AS TIMESTAMP) IS NULL THEN 'unparseable_date' END,
    CASE WHEN kernel_touched IS NOT NULL AND TRY_CAST(kernel_touched AS DOUBLE) IS NULL
      THEN 'non_numeric:kernel_touched' END,
    CASE WHEN uptime_days IS NOT NULL AND TRY_CAST(uptime_days AS DOUBLE) IS NULL
      THEN 'non_numeric:uptime_days' END) AS reasons FROM raw)
SELECT reasons, count(*) AS rows FROM tagged GROUP BY 1""")
def contract_quarantine(spark, sf):
    good, bad = ct.split_valid(raw_feed(spark, sf), C)
    sides = bad.select(F.array_join("reasons", ",").alias("reasons")).unionByName(
        good.select(F.lit("").alias("reasons")))
    return sides.groupBy("reasons").agg(F.count("*").alias("rows"))


@query("contract_quarantine_hot_key", f"""
WITH {S.RAW_FEED.replace("SELECT format('DEP_{:06d}',", "SELECT CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'DEP_hot' END AS hot, o_orderkey % 3 = 2 AS own, format('DEP_{:06d}',", 1)},
fed AS (SELECT * REPLACE (CASE WHEN own THEN deployment_id ELSE hot END AS deployment_id) FROM raw),
tagged AS (
  SELECT concat_ws(',',
    CASE WHEN count(*) OVER (PARTITION BY deployment_id) > 1 THEN 'duplicate_key' END,
    CASE WHEN coalesce(deployment_outcome, '') NOT IN
      ('SUCCESS','DEGRADED','ROLLBACK','FAILED') THEN 'invalid_outcome' END,
    CASE WHEN TRY_CAST(deployment_date AS TIMESTAMP) IS NULL THEN 'unparseable_date' END,
    CASE WHEN kernel_touched IS NOT NULL AND TRY_CAST(kernel_touched AS DOUBLE) IS NULL
      THEN 'non_numeric:kernel_touched' END,
    CASE WHEN uptime_days IS NOT NULL AND TRY_CAST(uptime_days AS DOUBLE) IS NULL
      THEN 'non_numeric:uptime_days' END) AS reasons FROM fed)
SELECT reasons, count(*) AS rows FROM tagged GROUP BY 1""")
def contract_quarantine_hot_key(spark, sf):
    """A third of the rows without id and a third with one id: no task of the tagging holds either."""
    k = F.col("o_orderkey")
    orders = table(spark, sf, "orders")
    feeds = [raw_feed(spark, sf, orders.where(k % 3 == part)) for part in range(3)]
    fed = feeds[0].withColumn("deployment_id", F.lit(None).cast("string")).union(
        feeds[1].withColumn("deployment_id", F.lit("DEP_hot"))).union(feeds[2])
    tagged = ct.with_reasons(fed, C)
    return tagged.select(F.array_join("reasons", ",").alias("reasons")).groupBy("reasons").agg(F.count("*").alias("rows"))


@query("derive_features", f"""
WITH {S.FEATURES}
SELECT deployment_id, major_version_jump, major_version_changed, emergency_no_maintenance,
  core_system_touched, deployment_risk FROM feat""")
def derive_features(spark, sf):
    df = deployments(spark, sf, (
        "deployment_id", *C.versions, "deployment_type", "maintenance_window",
        "kernel_touched", "bootloader_touched", "deployment_outcome"))
    return ft.derive(df).select("deployment_id", *ft.DERIVED, ft.LABEL)


@query("version_parse_rate", f"""
WITH {S.FEATURES}
SELECT count(*) AS rows, count(*) FILTER (WHERE major_version_jump IS NULL) AS failures,
  count(*) FILTER (WHERE major_version_jump IS NULL) / count(*)::DOUBLE AS rate FROM feat""")
def version_parse_rate(spark, sf):
    return ft.parse_failures(deployments(spark, sf, ("deployment_id", *C.versions)))


@query("version_parse_offenders", f"""
WITH {S.FEATURES}
SELECT deployment_id, current_firmware, target_firmware FROM feat
WHERE major_version_jump IS NULL""")
def version_parse_offenders(spark, sf):
    return ft.unparsed_rows(deployments(spark, sf, ("deployment_id", *C.versions)))


@query("version_majors", f"""
WITH {S.DEPLOYMENTS}
SELECT {S.MAJOR.format('current_firmware')} AS current_major,
  {S.MAJOR.format('target_firmware')} AS target_major, count(*) AS rows
FROM dep GROUP BY ALL""")
def version_majors(spark, sf):
    df = deployments(spark, sf, C.versions)
    return df.groupBy(major(F.col("current_firmware")).alias("current_major"),
                      major(F.col("target_firmware")).alias("target_major")).agg(
        F.count("*").alias("rows"))


_PAGE_SQL = f"""
WITH {S.FEATURES},
f AS (SELECT *, concat_ws(',',
    CASE WHEN coalesce(major_version_changed, 0) > 0 THEN 'major_version_changed' END,
    CASE WHEN core_system_touched > 0 THEN 'core_system_touched' END,
    CASE WHEN emergency_no_maintenance > 0 THEN 'emergency_no_maintenance' END,
    CASE WHEN max_cvss_score >= 7.0 THEN 'high_cvss' END,
    CASE WHEN coalesce(protocol_mismatch_flag, 0) <> 0 THEN 'protocol_mismatch' END,
    CASE WHEN network_stress_score >= 0.70::DOUBLE THEN 'high_network_stress' END,
    CASE WHEN coalesce(past_failure_count, 0) >= 1 THEN 'repeat_failure_device' END,
    CASE WHEN fleet_tier = 'TIER_1' THEN 'tier_1_device' END,
    CASE WHEN site_criticality = 'HIGH' THEN 'high_criticality_site' END) AS flags
  FROM feat)
"""
_CORPUS_FLAG_SQL = f"""
{S.FEATURES},
flagged AS (SELECT *, concat_ws(',',
    CASE WHEN coalesce(major_version_jump, 0) > 0 THEN 'major_version_jump' END,
    CASE WHEN coalesce(kernel_touched, 0) <> 0 THEN 'kernel_touched' END,
    CASE WHEN coalesce(bootloader_touched, 0) <> 0 THEN 'bootloader_touched' END,
    CASE WHEN coalesce(protocol_mismatch_flag, 0) <> 0 THEN 'protocol_mismatch_flag' END,
    CASE WHEN max_cvss_score >= 7.0 THEN 'high_cvss' END,
    CASE WHEN site_criticality = 'HIGH' THEN 'high_criticality_site' END,
    CASE WHEN emergency_no_maintenance = 1 THEN 'emergency_no_maintenance' END,
    CASE WHEN coalesce(past_failure_count, 0) >= 3 THEN 'repeat_failure_device' END,
    CASE WHEN fleet_tier = 'TIER_1' THEN 'tier_1_device' END,
    CASE WHEN coalesce(network_stress_score, 0) >= 0.65::DOUBLE THEN 'high_network_stress' END)
    AS flags,
  CASE WHEN version_jump_magnitude >= 8.0 THEN 'extreme'
       WHEN version_jump_magnitude >= 5.0 THEN 'major' END AS transition_class
  FROM feat)
"""


@query("flags_page", f"{_PAGE_SQL} SELECT deployment_id, flags FROM f")
def flags_page(spark, sf):
    return deployments(spark, sf).select(
        "deployment_id",
        F.array_join(fl.raised(fl.page_flag_conditions()), ",").alias("flags"))


@query("flags_corpus", f"""
WITH {_CORPUS_FLAG_SQL} SELECT deployment_id, flags, transition_class FROM flagged""")
def flags_corpus(spark, sf):
    return deployments(spark, sf).select(
        "deployment_id",
        F.array_join(fl.raised(fl.corpus_flag_conditions()), ",").alias("flags"),
        jump_band(F.col("version_jump_magnitude")).alias("transition_class"))


@query("deployment_flags", f"""
WITH {_CORPUS_FLAG_SQL} SELECT deployment_id, flags, transition_class FROM flagged""")
def deployment_flags(spark, sf):
    """Of rows that pass the contract, checked first."""
    return ft.deployment_flags(deployments(spark, sf), C.scoring()).select(
        "deployment_id", F.array_join("active_flags", ",").alias("flags"), "transition_class")


@query("flag_rates_by_vendor", f"""
{_PAGE_SQL}
SELECT vendor_name, flag, count(*) AS rows FROM (
  SELECT vendor_name, unnest(string_split(flags, ',')) AS flag FROM f WHERE flags <> '')
GROUP BY ALL""")
def flag_rates_by_vendor(spark, sf):
    flagged = deployments(spark, sf).select(
        "vendor_name", F.explode(fl.raised(fl.page_flag_conditions())).alias("flag"))
    return flagged.groupBy("vendor_name", "flag").agg(F.count("*").alias("rows"))


@query("jump_band", f"""
WITH {_CORPUS_FLAG_SQL}
SELECT transition_class, count(*) AS rows FROM flagged GROUP BY 1""")
def jump_band_counts(spark, sf):
    df = deployments(spark, sf, ("version_jump_magnitude",))
    return df.groupBy(
        jump_band(F.col("version_jump_magnitude")).alias("transition_class")
    ).agg(F.count("*").alias("rows"))


QUERY_TEXT_SQL = """
'historical failures for ' || coalesce(vendor_name, 'nan') || ' ' || coalesce(device_type, 'nan')
|| ' firmware upgrade ' || current_firmware || ' to ' || target_firmware || ' risk flags: '
|| CASE WHEN flags = '' THEN 'no major flags' ELSE replace(flags, ',', ' ') END
|| ' CVSS score ' || coalesce(max_cvss_score::VARCHAR, 'nan')
|| ' site criticality ' || site_criticality || ' deployment type ' || deployment_type
"""


@query("query_text", f"""
WITH {_CORPUS_FLAG_SQL}
SELECT deployment_id, {QUERY_TEXT_SQL} AS query FROM flagged""")
def query_texts(spark, sf):
    return deployments(spark, sf).select(
        "deployment_id", query_text(fl.raised(fl.corpus_flag_conditions())).alias("query"))


@query("context_block", f"""
WITH {_CORPUS_FLAG_SQL}
SELECT deployment_id, 'Vendor: ' || coalesce(vendor_name, 'nan')
  || chr(10) || 'Device type: ' || coalesce(device_type, 'nan')
  || chr(10) || 'Fleet tier: ' || fleet_tier
  || chr(10) || 'Firmware: ' || current_firmware || ' -> ' || target_firmware
  || chr(10) || 'Major version: '
  || coalesce({S.MAJOR.format('current_firmware')}::VARCHAR, 'unknown') || ' -> '
  || coalesce({S.MAJOR.format('target_firmware')}::VARCHAR, 'unknown')
  || chr(10) || 'Version jump magnitude: ' || coalesce(version_jump_magnitude::VARCHAR, 'unknown')
  || ' (not the major_version_jump flag)'
  || chr(10) || 'Deployment type: ' || deployment_type
  || chr(10) || 'Maintenance window: ' || CASE WHEN maintenance_window <> 0 THEN 'yes' ELSE 'no' END
  || chr(10) || 'Site criticality: ' || site_criticality
  || chr(10) || 'Max CVSS: ' || coalesce(max_cvss_score::VARCHAR, 'nan')
  || chr(10) || 'Past failures on this device: ' || coalesce(past_failure_count::VARCHAR, 'unknown')
  || chr(10) || 'Active Risk Flags: '
  || CASE WHEN flags = '' THEN 'none' ELSE replace(flags, ',', ', ') END AS context
FROM flagged""")
def context_blocks(spark, sf):
    return deployments(spark, sf).select(
        "deployment_id", context_block(fl.raised(fl.corpus_flag_conditions())).alias("context"))


_WORDS = fl.CORPUS_FLAG_WORDS


@query("keyword_mentions", " UNION ALL ".join(
    f"SELECT '{flag}' AS flag, count(*) FILTER (WHERE "
    + " OR ".join(f"contains(lower(text), '{w}')" for w in ws)
    + ") AS documents FROM documents" for flag, ws in _WORDS.items()))
def keyword_mentions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    wide = docs.agg(*[
        F.count_if(fl.mentions(F.col("text"), name)).alias(name) for name in fl.CORPUS_FLAGS])
    return wide.unpivot([], fl.CORPUS_FLAGS, "flag", "documents")


@query("token_estimates", """
SELECT doc_id, floor(len(regexp_extract_all(text,
  '[^\\t-\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+'))
  * 1.3::DOUBLE)::BIGINT AS tokens FROM documents""")
def token_estimates(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs.select("doc_id", token_estimate(F.col("text")).alias("tokens"))


@query("content_hashes", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def content_hashes(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs.select("doc_id", content_hash(F.col("text")).alias("sha256"))


@query("feature_profile", f"""
WITH {S.FEATURES}
SELECT 'rows' AS section, 'rows' AS name, NULL::VARCHAR AS value, count(*)::DOUBLE AS n FROM feat
UNION ALL SELECT 'label_rate', 'deployment_risk', NULL, round(avg(deployment_risk), 9) FROM feat
UNION ALL SELECT 'firmware_parse_failures', 'major_version_jump', NULL,
  count(*) FILTER (WHERE major_version_jump IS NULL) FROM feat
UNION ALL {' UNION ALL '.join(
    f"SELECT 'nulls', '{c}', NULL, count(*) FILTER (WHERE {c} IS NULL) FROM feat"
    for c in S.CATEGORICAL + S.NUMERIC + S.DERIVED)}
UNION ALL SELECT 'outcome', 'deployment_outcome', deployment_outcome, count(*) FROM feat GROUP BY 3
UNION ALL {' UNION ALL '.join(
    f"SELECT 'vocabulary', '{c}', {c}, count(*) FROM feat WHERE {c} IS NOT NULL GROUP BY 3"
    for c in S.CATEGORICAL)}""")
def feature_profile(spark, sf):
    profile = ft.feature_profile(ft.derive(deployments(spark, sf)))
    return profile.withColumn("n", F.round("n", 9))
