"""The two risk-flag vocabularies. They differ on purpose and stay separate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shiplens.functions.versions import major_jump

# Flags of the fleet page, in display order.
PAGE_FLAGS = [
    "major_version_changed", "core_system_touched", "emergency_no_maintenance",
    "high_cvss", "protocol_mismatch", "high_network_stress",
    "repeat_failure_device", "tier_1_device", "high_criticality_site",
]
# Flags the documents are written in, in their order, with the words
# that count as a text discussing each.
CORPUS_FLAG_WORDS = {
    "major_version_jump": ["major_version_jump", "major version", "version jump"],
    "kernel_touched": ["kernel_touched", "kernel"],
    "bootloader_touched": ["bootloader_touched", "bootloader"],
    "protocol_mismatch_flag": ["protocol_mismatch", "protocol mismatch"],
    "high_cvss": ["high_cvss", "cvss"],
    "high_criticality_site": [
        "high_criticality_site", "high criticality", "high-criticality",
    ],
    "emergency_no_maintenance": [
        "emergency_no_maintenance", "emergency", "maintenance window",
    ],
    "repeat_failure_device": ["repeat_failure_device", "repeat failure", "past failure"],
    "tier_1_device": ["tier_1", "tier 1"],
    "high_network_stress": ["network stress", "network_stress"],
}
CORPUS_FLAGS = list(CORPUS_FLAG_WORDS)


def _on(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def touched(name: str) -> Column:
    return _on(F.col(name) != 0)


def emergency_without_window() -> Column:
    return _on(F.col("deployment_type") == "EMERGENCY") & _on(
        F.col("maintenance_window") == 0
    )


def page_flag_conditions() -> dict[str, Column]:
    jump = major_jump(F.col("current_firmware"), F.col("target_firmware"))
    return {
        "major_version_changed": _on(jump != 0),
        "core_system_touched": touched("kernel_touched") | touched("bootloader_touched"),
        "emergency_no_maintenance": emergency_without_window(),
        "high_cvss": _on(F.col("max_cvss_score") >= 7.0),
        "protocol_mismatch": touched("protocol_mismatch_flag"),
        "high_network_stress": _on(F.col("network_stress_score") >= 0.70),
        "repeat_failure_device": _on(F.col("past_failure_count") >= 1),
        "tier_1_device": _on(F.col("fleet_tier") == "TIER_1"),
        "high_criticality_site": _on(F.col("site_criticality") == "HIGH"),
    }


def corpus_flag_conditions() -> dict[str, Column]:
    jump = major_jump(F.col("current_firmware"), F.col("target_firmware"))
    return {
        "major_version_jump": _on(jump > 0),
        "kernel_touched": touched("kernel_touched"),
        "bootloader_touched": touched("bootloader_touched"),
        "protocol_mismatch_flag": touched("protocol_mismatch_flag"),
        "high_cvss": _on(F.col("max_cvss_score") >= 7.0),
        "high_criticality_site": _on(F.col("site_criticality") == "HIGH"),
        "emergency_no_maintenance": emergency_without_window(),
        "repeat_failure_device": _on(F.col("past_failure_count") >= 3),
        "tier_1_device": _on(F.col("fleet_tier") == "TIER_1"),
        "high_network_stress": _on(F.col("network_stress_score") >= 0.65),
    }


def raised(conditions: dict[str, Column]) -> Column:
    """Names of the conditions that hold, in vocabulary order."""
    return F.array_compact(
        F.array(*[F.when(on, F.lit(name)) for name, on in conditions.items()])
    )


def bitmask(conditions: list[Column]) -> Column:
    bits = [F.when(on, F.lit(1 << i)).otherwise(F.lit(0)) for i, on in enumerate(conditions)]
    return reduce(lambda a, b: a + b, bits)


def flags_mask(flags: Column) -> Column:
    """Active flag names as bits in vocabulary order."""
    return bitmask([F.array_contains(flags, name) for name in CORPUS_FLAGS])


def flags_from_mask(mask: Column) -> Column:
    return F.array_compact(
        F.array(*[
            F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, F.lit(name))
            for i, name in enumerate(CORPUS_FLAGS)
        ])
    )


def mentions(text: Column, flag: str) -> Column:
    lowered = F.lower(text)
    return reduce(
        lambda a, b: a | b, [F.contains(lowered, F.lit(w)) for w in CORPUS_FLAG_WORDS[flag]]
    )


def mention_mask(text: Column) -> Column:
    return bitmask([_on(mentions(text, name)) for name in CORPUS_FLAGS])
