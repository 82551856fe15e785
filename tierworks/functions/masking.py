"""Role dependent masking and row access."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Role names and the text shown to everybody else.
FULL_ACCESS = ("ADMIN", "ENGINEER")
PARTIAL_ACCESS = "ANALYST"
REDACTED = "**REDACTED**"
ANALYST_REGION = "APAC"


def mask_email(value: str | Column, role: str) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    if role in FULL_ACCESS:
        return column
    if role == PARTIAL_ACCESS:
        return F.regexp_replace(column, ".+@", "****@")
    return F.lit(REDACTED)


def row_filter(df: DataFrame, region: str, role: str, analyst_region: str = ANALYST_REGION) -> DataFrame:
    """Admins see everything, analysts one region, others nothing."""
    if role == "ADMIN":
        return df
    if role == PARTIAL_ACCESS:
        return df.filter(F.col(region) == analyst_region)
    return df.filter(F.lit(False))
