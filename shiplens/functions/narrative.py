"""Fixed texts made from one deployment row: the search query and the context block."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shiplens.functions.values import number_text
from shiplens.functions.versions import major


def _shown(name: str) -> Column:
    """Python's view of a value inside a text: missing prints as nan."""
    return F.coalesce(F.col(name).cast("string"), F.lit("nan"))


def _shown_number(name: str) -> Column:
    return F.coalesce(number_text(F.col(name)), F.lit("nan"))


def query_text(flags: Column) -> Column:
    """Search text with no identifiers in it, so ids cannot match ids."""
    named = F.when(F.size(flags) > 0, F.array_join(flags, " ")).otherwise("no major flags")
    return F.concat(
        F.lit("historical failures for "), _shown("vendor_name"), F.lit(" "),
        _shown("device_type"), F.lit(" firmware upgrade "), _shown("current_firmware"),
        F.lit(" to "), _shown("target_firmware"), F.lit(" risk flags: "), named,
        F.lit(" CVSS score "), _shown_number("max_cvss_score"),
        F.lit(" site criticality "), _shown("site_criticality"),
        F.lit(" deployment type "), _shown("deployment_type"),
    )


def context_block(flags: Column, *, scored: bool = False) -> Column:
    """The deployment as a writer may describe it, one fact per line."""

    def known(text: Column) -> Column:
        return F.coalesce(text, F.lit("unknown"))

    window = F.col("maintenance_window")
    facts = [
        ("Vendor: ", _shown("vendor_name"), ""),
        ("Device type: ", _shown("device_type"), ""),
        ("Fleet tier: ", known(F.col("fleet_tier")), ""),
        ("Firmware: ", F.concat(_shown("current_firmware"), F.lit(" -> "),
                                _shown("target_firmware")), ""),
        ("Major version: ", F.concat(known(major(F.col("current_firmware")).cast("string")),
                                     F.lit(" -> "),
                                     known(major(F.col("target_firmware")).cast("string"))), ""),
        ("Version jump magnitude: ", known(number_text(F.col("version_jump_magnitude"))),
         " (not the major_version_jump flag)"),
        ("Deployment type: ", _shown("deployment_type"), ""),
        ("Maintenance window: ", F.when(window.isNull(), "unknown")
         .when(window != 0, "yes").otherwise("no"), ""),
        ("Site criticality: ", _shown("site_criticality"), ""),
        ("Max CVSS: ", _shown_number("max_cvss_score"), ""),
        ("Past failures on this device: ", known(number_text(F.col("past_failure_count"))), ""),
    ]
    lines = [F.concat(F.lit(a), b, F.lit(c)) for a, b, c in facts]
    if scored:
        p = F.col("risk_probability")
        lines.append(F.when(
            p.isNotNull(),
            F.concat(
                F.lit("Model score: "), F.coalesce(F.col("risk_band"), F.lit("?")),
                F.lit(" / "), F.coalesce(F.col("risk_prediction"), F.lit("?")),
                F.format_string(" (probability %.4f, about %.0f%%)", p, p * 100),
            ),
        ))
    named = F.when(F.size(flags) > 0, F.array_join(flags, ", ")).otherwise("none")
    lines.append(F.concat(F.lit("Active Risk Flags: "), named))
    return F.concat_ws("\n", *lines)
