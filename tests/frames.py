"""Deployment rows by rule, as text, the way a feed delivers them."""

from __future__ import annotations

from datetime import date, timedelta

from shiplens.operators.contract import DEPLOYMENTS

OUTCOMES = ("SUCCESS", "DEGRADED", "SUCCESS", "ROLLBACK")


def training_rows(n: int) -> list[dict]:
    rows = []
    for i in range(n):
        rows.append({
            "deployment_id": f"deployment-{i:04d}", "device_id": f"device-{i:04d}",
            "firmware_fingerprint": f"fingerprint-{i:04d}", "site_id": f"site-{i % 12:02d}",
            "vendor_name": ("Cisco", "Juniper", "Arista", "Nokia")[i % 4],
            "device_type": ("ROUTER", "SWITCH", "FIREWALL", "GATEWAY", "SENSOR",
                            "CONTROLLER")[i % 6],
            "hardware_series": f"series-{i % 16:02d}",
            "fleet_tier": ("TIER_1", "TIER_2", "TIER_3")[i % 3],
            "site_criticality": ("LOW", "MEDIUM", "HIGH")[i % 3],
            "deployment_type": ("STANDARD", "PLANNED", "EMERGENCY")[i % 3],
            "current_firmware": f"{1 + i % 3}.2.0", "target_firmware": f"{1 + (i + 1) % 4}.0.1",
            "version_jump_magnitude": i % 5, "kernel_touched": i % 2,
            "bootloader_touched": i // 2 % 2, "protocol_mismatch_flag": i // 3 % 2,
            "maintenance_window": (i + 1) % 2, "network_stress_score": i % 10 / 10,
            "error_rate_predeploy": i % 7 / 100, "uptime_days": 30 + i,
            "past_failure_count": i % 4, "firmware_release_age_days": 10 + i % 60,
            "cve_count": i % 6, "max_cvss_score": i % 10,
            "cross_vendor_dependency_count": i % 3, "dependent_device_count": 1 + i % 20,
            "deployment_date": str(date(2025, 1, 1) + timedelta(days=i)),
            "deployment_outcome": OUTCOMES[i % 4], "time_to_failure_hours": i % 48,
            "rollback_required": int(i % 4 == 3),
        })
    return rows


def frame(spark, rows: list[dict]):
    schema = ", ".join(f"{c} string" for c in DEPLOYMENTS.columns)
    text = [
        tuple(None if r.get(c) is None else str(r[c]) for c in DEPLOYMENTS.columns) for r in rows
    ]
    return spark.createDataFrame(text, schema)
