"""The views of tables.py restated in SQL, as CTE bodies for the oracle queries."""

from __future__ import annotations

ORDER_PART = """
  format('DEP_{:06d}', o_orderkey) AS deployment_id,
  'device-' || o_custkey AS device_id,
  'fingerprint-' || o_orderkey AS firmware_fingerprint,
  'TIER_' || (o_custkey % 3 + 1) AS fleet_tier,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'HIGH'
       WHEN o_orderpriority = '3-MEDIUM' THEN 'MEDIUM' ELSE 'LOW' END AS site_criticality,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'EMERGENCY'
       WHEN o_orderpriority = '2-HIGH' THEN 'PLANNED' ELSE 'STANDARD' END AS deployment_type,
  CASE WHEN o_orderkey % 211 = 0 THEN 'v' ELSE '' END || (1 + o_custkey % 7) || '.'
    || (o_orderkey % 4) || '.0' AS current_firmware,
  (1 + o_orderkey % 9) || '.' || (o_custkey % 3) || '.1' AS target_firmware,
  CASE WHEN o_orderkey % 41 <> 0 THEN abs((1 + o_orderkey % 9) - (1 + o_custkey % 7))::DOUBLE
       + (o_orderkey % 8)::DOUBLE / 8.0::DOUBLE END AS version_jump_magnitude,
  CASE WHEN o_orderkey % 53 <> 0 THEN (o_custkey % 2)::DOUBLE END AS kernel_touched,
  ((o_orderkey // 2) % 2)::DOUBLE AS bootloader_touched,
  CASE WHEN o_orderkey % 5 = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS protocol_mismatch_flag,
  CASE WHEN o_orderkey % 3 <> 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS maintenance_window,
  o_orderdate AS deployment_date,
  CASE o_orderstatus WHEN 'O' THEN 'SUCCESS' WHEN 'F' THEN 'FAILED'
       ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'DEGRADED' ELSE 'ROLLBACK' END
  END AS deployment_outcome
"""

DEPLOYMENTS = f"""
lines AS (
  SELECT l_orderkey,
    min(l_linenumber::BIGINT * 10000000000 + l_partkey) % 10000000000 AS first_part,
    sum(l_quantity) / (count(*)::DOUBLE * 50.0::DOUBLE) AS network_stress_score,
    max(l_tax) AS error_rate_predeploy,
    max(l_quantity) * 7.0::DOUBLE AS uptime_days,
    (count(*) FILTER (WHERE l_returnflag = 'R'))::DOUBLE AS past_failure_count,
    count(*)::DOUBLE AS cve_count,
    round(max(l_discount) * 100.0::DOUBLE, 1) AS max_cvss_score,
    (max(l_linenumber) - 1)::DOUBLE AS cross_vendor_dependency_count,
    sum(l_quantity) AS dependent_device_count
  FROM lineitem GROUP BY l_orderkey),
dep AS (
  SELECT {ORDER_PART},
    o_orderkey, o_custkey,
    'site-' || c_nationkey AS site_id, c_mktsegment AS vendor_name,
    p_type AS device_type, p_brand AS hardware_series,
    p_size::DOUBLE AS firmware_release_age_days,
    network_stress_score, error_rate_predeploy, uptime_days, past_failure_count, cve_count,
    max_cvss_score, cross_vendor_dependency_count, dependent_device_count
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN lines ON o_orderkey = l_orderkey
  LEFT JOIN part ON first_part = p_partkey)
"""

MAJOR = "TRY_CAST(regexp_extract({0}, '^\\s*([+-]?[0-9]+)\\s*(\\.|$)', 1) AS BIGINT)"

FEATURES = f"""
{DEPLOYMENTS},
jumps AS (
  SELECT *, ({MAJOR.format('target_firmware')}
             - {MAJOR.format('current_firmware')})::DOUBLE AS major_version_jump FROM dep),
feat AS (
  SELECT *,
    CASE WHEN major_version_jump IS NULL THEN NULL
         WHEN major_version_jump <> 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS major_version_changed,
    CASE WHEN deployment_type = 'EMERGENCY' AND maintenance_window = 0
         THEN 1.0 ELSE 0.0 END::DOUBLE AS emergency_no_maintenance,
    CASE WHEN coalesce(kernel_touched, 0) <> 0 OR coalesce(bootloader_touched, 0) <> 0
         THEN 1.0 ELSE 0.0 END::DOUBLE AS core_system_touched,
    CASE WHEN deployment_outcome = 'SUCCESS' THEN 0 ELSE 1 END AS deployment_risk
  FROM jumps)
"""

NUMERIC = (
    "version_jump_magnitude", "kernel_touched", "bootloader_touched",
    "protocol_mismatch_flag", "maintenance_window", "network_stress_score",
    "error_rate_predeploy", "uptime_days", "past_failure_count",
    "firmware_release_age_days", "cve_count", "max_cvss_score",
    "cross_vendor_dependency_count", "dependent_device_count",
)
DERIVED = (
    "major_version_jump", "major_version_changed", "emergency_no_maintenance",
    "core_system_touched",
)
CATEGORICAL = (
    "vendor_name", "device_type", "hardware_series", "fleet_tier",
    "site_criticality", "deployment_type",
)

_PLAIN = {
    name: f"(o_orderkey % {3 + i})::VARCHAR" for i, name in enumerate(NUMERIC)
}
RAW_FEED = f"""
raw AS (
  SELECT format('DEP_{{:06d}}', CASE WHEN o_orderkey % 400 = 7 THEN o_orderkey - 1
                                    ELSE o_orderkey END) AS deployment_id,
    CASE WHEN o_orderkey % 301 = 0 THEN 'ROLLBACK_REQUIRED'
         WHEN o_orderkey % 307 = 0 THEN NULL
         WHEN o_orderstatus = 'O' THEN 'SUCCESS' WHEN o_orderstatus = 'F' THEN 'FAILED'
         WHEN o_orderkey % 2 = 0 THEN 'DEGRADED' ELSE 'ROLLBACK' END AS deployment_outcome,
    CASE WHEN o_orderkey % 311 = 0 THEN 'soon'
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS deployment_date,
    CASE WHEN o_orderkey % 313 = 0 THEN '1d' WHEN o_orderkey % 53 = 0 THEN NULL
         ELSE (o_custkey % 2)::VARCHAR END AS kernel_touched,
    CASE WHEN o_orderkey % 317 = 0 THEN 'not-a-number' WHEN o_orderkey % 331 = 0 THEN NULL
         ELSE (o_orderkey % 900)::VARCHAR END AS uptime_days,
    CASE WHEN o_orderkey % 41 <> 0 THEN '1' END AS version_jump_magnitude
  FROM orders)
"""

SCORED = f"""
{DEPLOYMENTS},
scored AS (
  SELECT *, CASE WHEN deployment_outcome = 'SUCCESS' THEN 0 ELSE 1 END AS label,
    least((coalesce(past_failure_count, 0) * 9::DOUBLE + coalesce(max_cvss_score, 0) * 2::DOUBLE
      + CASE WHEN site_criticality = 'HIGH' THEN 11.0 ELSE 0.0 END::DOUBLE
      + (o_orderkey % 83)::DOUBLE) / 180.0::DOUBLE, 1.0::DOUBLE) AS probability
  FROM dep)
"""
