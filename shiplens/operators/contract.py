"""Hold a table to a closed data contract.

All row-level rules are expressions evaluated in one scan. Offending values and
duplicate ids come back as tables, never as collected lists, because a broken feed can
make either as large as the input.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplens.functions.values import null_if_nan, strict_double


class ContractViolation(ValueError):
    """Data that must not reach a model. `offenders` holds every offending value, as a table."""

    def __init__(self, message: str, offenders: DataFrame | None = None) -> None:
        super().__init__(message)
        self.offenders = offenders


@dataclass(frozen=True)
class TableContract:
    """Column roles of a fact table. The defaults are the deployment table's."""

    key: str = "deployment_id"
    ids: tuple[str, ...] = ("deployment_id", "device_id", "site_id", "firmware_fingerprint")
    categorical: tuple[str, ...] = (
        "vendor_name", "device_type", "hardware_series", "fleet_tier",
        "site_criticality", "deployment_type",
    )
    versions: tuple[str, ...] = ("current_firmware", "target_firmware")
    numeric: tuple[str, ...] = (
        "version_jump_magnitude", "kernel_touched", "bootloader_touched",
        "protocol_mismatch_flag", "maintenance_window", "network_stress_score",
        "error_rate_predeploy", "uptime_days", "past_failure_count",
        "firmware_release_age_days", "cve_count", "max_cvss_score",
        "cross_vendor_dependency_count", "dependent_device_count",
    )
    date: str = "deployment_date"
    outcome: str = "deployment_outcome"
    allowed_outcomes: tuple[str, ...] = ("SUCCESS", "DEGRADED", "ROLLBACK", "FAILED")
    leakage: tuple[str, ...] = ("time_to_failure_hours", "rollback_required")
    date_format: str | None = None
    training: bool = True
    extra: tuple[str, ...] = field(default=())

    def scoring(self) -> TableContract:
        return replace(self, training=False)

    @property
    def columns(self) -> tuple[str, ...]:
        base = (*self.ids, *self.categorical, *self.versions, *self.numeric, self.date)
        return (*base, self.outcome, *self.leakage) if self.training else base


DEPLOYMENTS = TableContract()
#: Rows of one key that one task may bring together, and parts that rows of larger keys are dealt over.
HEAVY_ROWS, DEALS = 200_000, 65_536


def missing_columns(df: DataFrame, contract: TableContract) -> list[str]:
    return sorted(set(contract.columns) - set(df.columns))


def unexpected_columns(df: DataFrame, contract: TableContract) -> list[str]:
    return sorted(set(df.columns) - set(contract.columns))


def require_columns(df: DataFrame, contract: TableContract) -> None:
    missing = missing_columns(df, contract)
    if missing:
        raise ContractViolation(f"Missing required columns: {missing}")


def parsed_date(value: Column, contract: TableContract) -> Column:
    if contract.date_format is None:
        return F.try_to_timestamp(value.cast("string"))
    return F.try_to_timestamp(value.cast("string"), F.lit(contract.date_format))


def as_number(df: DataFrame, name: str) -> Column:
    """The column as a double; text is parsed strictly, numbers are only cast."""
    if df.schema[name].dataType.typeName() == "string":
        return strict_double(F.col(name))
    return null_if_nan(F.col(name).cast("double"))


def row_rules(df: DataFrame, contract: TableContract) -> dict[str, tuple[str, Column]]:
    """Rule name -> (column, condition that marks a row as broken). Never null."""
    rules = {}
    if contract.training:
        outcome = F.col(contract.outcome)
        rules["invalid_outcome"] = (
            contract.outcome,
            ~F.coalesce(outcome.isin(list(contract.allowed_outcomes)), F.lit(False)),
        )
        rules["unparseable_date"] = (
            contract.date, parsed_date(F.col(contract.date), contract).isNull(),
        )
    for name in contract.numeric:
        if df.schema[name].dataType.typeName() == "string":
            rules[f"non_numeric:{name}"] = (
                name, F.col(name).isNotNull() & strict_double(F.col(name)).isNull(),
            )
    return rules


def coerce(df: DataFrame, contract: TableContract) -> DataFrame:
    """Numbers to double and, when training, the date to a timestamp."""
    casts = {name: as_number(df, name) for name in contract.numeric}
    if contract.training:
        casts[contract.date] = parsed_date(F.col(contract.date), contract)
    return df.withColumns(casts)


def null_counts(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """(column, nulls, rows) for every column from a single aggregation pass."""
    wide = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    return wide.unpivot("rows", list(columns), "column", "nulls").select(
        "column", "nulls", "rows"
    )


def duplicate_keys(df: DataFrame, contract: TableContract) -> DataFrame:
    """Every key that occurs more than once; nulls count as equal to each other."""
    key = contract.key
    return df.groupBy(key).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def offenders(df: DataFrame, contract: TableContract) -> DataFrame:
    """(rule, column, value, rows): distinct offending values over all row rules."""
    found = F.array_compact(F.array(*[
        F.when(broken, F.struct(
            F.lit(rule).alias("rule"), F.lit(column).alias("column"),
            F.coalesce(F.col(column).cast("string"), F.lit("<missing>")).alias("value"),
        ))
        for rule, (column, broken) in row_rules(df, contract).items()
    ]))
    return (
        df.select(F.explode(found).alias("f")).groupBy("f.rule", "f.column", "f.value")
        .agg(F.count("*").alias("rows"))
    )


def summary(df: DataFrame, contract: TableContract) -> DataFrame:
    """One row: row count and the number of rows that break each row rule."""
    return df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(bad).alias(rule) for rule, (_, bad) in row_rules(df, contract).items()],
    )


def validate(df: DataFrame, contract: TableContract = DEPLOYMENTS) -> DataFrame:
    """The coerced table, or ContractViolation naming the first kind of defect found."""
    require_columns(df, contract)
    if extra := unexpected_columns(df, contract):
        warnings.warn(f"Columns outside the contract: {extra}", stacklevel=2)
    repeated = duplicate_keys(df, contract)
    if n := repeated.count():
        raise ContractViolation(f"{n} {contract.key} values occur more than once", repeated)
    counts = summary(df, contract).first().asDict()
    broken = {rule: n for rule, n in counts.items() if rule != "rows" and n}
    if broken:
        raise ContractViolation(f"Rows breaking the contract: {broken}", offenders(df, contract))
    return coerce(df, contract)


def with_reasons(
    df: DataFrame, contract: TableContract = DEPLOYMENTS, reasons: str = "reasons", *,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Every row with the names of the rules it breaks, duplicates included.

    Rows of one key meet in one task of the join, so keys that are missing or have more than
    `heavy_rows` rows are found first: there are at most rows / heavy_rows of them, few enough to
    send to every task. Their rows are tagged where they are and dealt evenly over the join's tasks.
    """
    require_columns(df, contract)
    repeated = duplicate_keys(df, contract).select(F.col(contract.key).alias("_key"), "rows")
    many = F.col("_key").isNull() | (F.col("rows") > heavy_rows)
    heavy = repeated.where(many).select("_key", F.lit(True).alias("_heavy"))
    # 0 in every row, but no literal: that would be folded, and rows dealt by their key alone
    zero = F.least("rows", F.lit(0)).cast("int")
    light = repeated.where(~many).select("_key", zero.alias("_deal"), F.lit(True).alias("_repeated"))
    split = df.join(F.broadcast(heavy), df[contract.key].eqNullSafe(F.col("_key")), "left").drop("_key")
    aside = F.col("_heavy").isNotNull() | F.col(contract.key).isNull()
    deal = F.pmod(F.hash(F.monotonically_increasing_id()), F.lit(DEALS)) + 1
    rules = [
        F.when(broken, F.lit(rule)) for rule, (_, broken) in row_rules(df, contract).items()
    ]
    # Row rules come before the join, so that it carries what they found and not all they read.
    dealt = split.withColumns({
        "_mine": F.when(aside, deal).otherwise(0), "_rules": F.array_compact(F.array(*rules))})
    joined = dealt.join(
        light, (dealt[contract.key] == light["_key"]) & (F.col("_mine") == F.col("_deal")), "left")
    again = F.when(F.coalesce("_heavy", "_repeated"), F.lit("duplicate_key"))
    return joined.withColumn(reasons, F.concat(F.array_compact(F.array(again)), "_rules")).drop(
        "_key", "_repeated", "_heavy", "_mine", "_deal", "_rules")


def split_valid(
    df: DataFrame, contract: TableContract = DEPLOYMENTS
) -> tuple[DataFrame, DataFrame]:
    """(coerced good rows, raw bad rows with `reasons`)."""
    return split_tagged(with_reasons(df, contract), contract)


def split_tagged(
    tagged: DataFrame, contract: TableContract = DEPLOYMENTS
) -> tuple[DataFrame, DataFrame]:
    good = tagged.where(F.size("reasons") == 0).drop("reasons")
    return coerce(good, contract), tagged.where(F.size("reasons") > 0)


def cast_declared(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """Declared-double columns cast only where every value converts.

    A column with any bad value stays as it is, so the contract check can name it.
    """
    present = [c for c in columns if c in df.columns]
    bad = df.agg(*[
        F.count_if(F.col(c).isNotNull() & strict_double(F.col(c)).isNull()).alias(c)
        for c in present
    ]).first()
    return df.withColumns(
        {c: strict_double(F.col(c)) for c in present if not bad[c]}
    )
