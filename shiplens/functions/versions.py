"""Firmware version strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shiplens.functions.values import strip


def major(version: Column) -> Column:
    """Whole number before the first dot, null where it does not parse."""
    head = strip(F.substring_index(version.cast("string"), ".", 1))
    return F.when(head.rlike(r"^[+-]?\d+$"), head.try_cast("bigint"))


def major_jump(current: Column, target: Column) -> Column:
    """Signed: a downgrade stays negative."""
    return (major(target) - major(current)).cast("double")


def jump_band(magnitude: Column) -> Column:
    """Band of the version-jump magnitude the transition summaries cover."""
    return F.when(magnitude >= 8.0, "extreme").when(magnitude >= 5.0, "major")
