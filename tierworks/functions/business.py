"""The platform's named functions, as native expressions.

``register`` also makes them callable from SQL text.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tierworks.functions.flags import first_match, label_lookup

# One-letter sensor states.
STATUS_LETTERS = {"A": "ACTIVE", "I": "INACTIVE", "M": "MAINTENANCE", "E": "ERROR"}

# Lower limits of the revenue tiers.
REVENUE_TIERS = [(1_000_000, "PLATINUM"), (500_000, "GOLD"), (100_000, "SILVER")]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stable_round(value: str | Column, places: int) -> Column:
    """Half-up rounding of a double through a decimal.

    Sums of doubles depend in their last bits on the order of the rows, which a
    cluster does not fix; the decimal drops these bits first, so that a value on
    the edge between two results is always rounded the same way.  Values too large
    for it, NaN and infinities stay as they are.
    """
    number = _col(value).cast("double")
    return F.when(F.abs(number) < 1e18, F.round(number.cast("decimal(28,9)"), places).cast("double")).otherwise(number)


def quality_score(passed: str | Column, total: str | Column) -> Column:
    """Percentage passed, two places; 0 for an empty total."""
    share = _col(passed).cast("double") / F.nullif(_col(total), F.lit(0)) * 100
    return F.when(_col(total) == 0, F.lit(0.0)).otherwise(stable_round(share, 2))


def parse_status(raw: str | Column) -> Column:
    """Full state name for a letter, the upper-cased text otherwise, UNKNOWN for nothing."""
    raw = _col(raw)
    text = F.trim(F.upper(raw))
    return F.when(raw.isNull() | (raw == ""), "UNKNOWN").otherwise(
        label_lookup(text, STATUS_LETTERS, default=text)
    )


def anomaly_score(reading: str | Column, mean: str | Column, stddev: str | Column) -> Column:
    """Absolute z-score, four places; 0 where the deviation is missing or zero."""
    sd = _col(stddev)
    z = F.abs((_col(reading) - _col(mean)) / F.nullif(sd, F.lit(0.0)))
    return F.when(sd.isNull() | (sd == 0), F.lit(0.0)).otherwise(stable_round(z, 4))


def revenue_tier(revenue: str | Column) -> Column:
    value = _col(revenue)
    return first_match([(value >= floor, tier) for floor, tier in REVENUE_TIERS], "BRONZE")


def date_range(spark: SparkSession, start: str, end: str) -> "DataFrame":  # noqa: F821
    """One row per day, both ends included."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(days).alias("dt"))


def register(spark: SparkSession) -> None:
    """SQL functions of the session with the same meaning as the columns above."""
    spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION quality_score(passed BIGINT, total BIGINT)
           RETURNS DOUBLE
           RETURN CASE WHEN total = 0 THEN 0D
                       ELSE CAST(round(CAST(CAST(passed AS DOUBLE) / nullif(total, 0) * 100 AS DECIMAL(28, 9)), 2) AS DOUBLE) END"""
    )
    spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION revenue_tier(revenue DOUBLE)
           RETURNS STRING
           RETURN CASE WHEN revenue >= 1000000 THEN 'PLATINUM' WHEN revenue >= 500000 THEN 'GOLD'
                       WHEN revenue >= 100000 THEN 'SILVER' ELSE 'BRONZE' END"""
    )
    spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION anomaly_score(r DOUBLE, mean DOUBLE, sd DOUBLE)
           RETURNS DOUBLE
           RETURN CASE WHEN sd IS NULL OR sd = 0 THEN 0D
                       WHEN abs((r - mean) / nullif(sd, 0D)) >= 1e18D THEN abs((r - mean) / nullif(sd, 0D))
                       ELSE CAST(round(CAST(abs((r - mean) / nullif(sd, 0D)) AS DECIMAL(28, 9)), 4) AS DOUBLE) END"""
    )
    spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION sensor_state(raw STRING)
           RETURNS STRING
           RETURN CASE WHEN raw IS NULL OR raw = '' THEN 'UNKNOWN'
                       ELSE coalesce(element_at(map('A', 'ACTIVE', 'I', 'INACTIVE', 'M',
                            'MAINTENANCE', 'E', 'ERROR'), trim(upper(raw))), trim(upper(raw))) END"""
    )
    spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION generate_date_range(a DATE, z DATE)
           RETURNS TABLE (dt DATE)
           RETURN SELECT explode(sequence(a, z)) AS dt"""
    )
