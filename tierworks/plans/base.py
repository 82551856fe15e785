"""Inputs shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierworks import bindings as b
from tierworks.operators import gold, scd, silver, spc
from tierworks.sources import staging

VENDOR_TRACKED = ["vendor_name", "country", "payment_terms"]


def staged_readings(spark: SparkSession, d: str) -> DataFrame:
    return staging.stage_sensor(b.sensor_readings(spark, d))


def silver_readings(spark: SparkSession, d: str) -> DataFrame:
    return silver.clean_sensors(staged_readings(spark, d), b.TEST_BAND)


def kpi(spark: SparkSession, d: str, require_valid: bool = True) -> DataFrame:
    return gold.daily_sensor_kpi(silver_readings(spark, d), require_valid)


def stats(spark: SparkSession, d: str) -> DataFrame:
    return gold.daily_sensor_stats(silver_readings(spark, d))


def alerts(spark: SparkSession, d: str) -> DataFrame:
    return spc.sensor_alerts(stats(spark, d))


def staged_orders(spark: SparkSession, d: str) -> DataFrame:
    return staging.stage_orders(b.raw_orders(spark, d))


def staged_equipment(spark: SparkSession, d: str) -> DataFrame:
    return staging.stage_equipment(b.equipment_master(spark, d))


def dim_equipment(spark: SparkSession, d: str) -> DataFrame:
    return silver.dim_equipment(silver.equipment_enriched(staged_equipment(spark, d), b.AS_OF))


def validated_orders(spark: SparkSession, d: str) -> DataFrame:
    return silver.validate_orders(staged_orders(spark, d), staged_equipment(spark, d), b.AS_OF)


def revenue(spark: SparkSession, d: str) -> DataFrame:
    return gold.daily_revenue(validated_orders(spark, d))


def staged_vendors(spark: SparkSession, d: str, load: int = 1) -> DataFrame:
    raw = b.vendors_v1(spark, d) if load == 1 else b.vendors_v2(spark, d)
    return staging.stage_vendors(raw)


def vendor_history(spark: SparkSession, d: str) -> DataFrame:
    """History after the first load."""
    return scd.scd2_build(staged_vendors(spark, d), "vendor_number", VENDOR_TRACKED, "loaded_at")


def vendor_history2(spark: SparkSession, d: str) -> DataFrame:
    """History after both loads."""
    return scd.scd2_merge(
        vendor_history(spark, d), staged_vendors(spark, d, 2), "vendor_number", VENDOR_TRACKED, b.V2_TIME
    )
