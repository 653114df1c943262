"""Missing values, strict numbers and Python-compatible text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The tokens a pandas CSV reader takes as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# Every character Python's str.strip() and str.split() treat as white space.
WHITESPACE = (
    r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)
NUMBER_LITERAL = (
    rf"(?i)^[{WHITESPACE}]*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf|infinity)[{WHITESPACE}]*$"
)


def null_if_na(value: Column) -> Column:
    return F.when(~value.isin(NA_TOKENS), value)


def null_if_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def strict_double(value: Column) -> Column:
    """A double, or null where the text is not a plain number (`1d` is not one)."""
    text = value.cast("string")
    return F.when(
        text.rlike(NUMBER_LITERAL), F.trim(text).try_cast("double")
    )


def clean_missing(df: DataFrame) -> DataFrame:
    """NA tokens and NaN become null once, at ingestion, for every column."""
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        kind = field.dataType.typeName()
        if kind == "string":
            column = null_if_na(column)
        elif kind in ("double", "float"):
            column = null_if_nan(column)
        out.append(column.alias(field.name))
    return df.select(*out)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A[{WHITESPACE}]+|[{WHITESPACE}]+\z", "")


def is_blank(text: Column) -> Column:
    return ~text.rlike(rf"[^{WHITESPACE}]")


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"[^{WHITESPACE}]+"), F.lit(0))


def token_estimate(text: Column) -> Column:
    """Word count times 1.3, cut to a whole number."""
    return F.floor(F.size(words(text)) * F.lit(1.3)).cast("bigint")


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def number_text(value: Column) -> Column:
    """A double as Python prints it: fixed notation from 1e-4 up to 1e16."""
    plain = value.cast("double")
    size = F.abs(plain)
    wide = F.regexp_replace(
        plain.cast("string").cast("decimal(38,18)").cast("string"), r"0+$", ""
    )
    wide = F.when(wide.endswith("."), F.concat(wide, F.lit("0"))).otherwise(wide)
    odd = ((size >= 1e7) & (size < 1e16)) | ((size >= 1e-4) & (size < 1e-3))
    return F.when(odd, wide).otherwise(plain.cast("string"))
