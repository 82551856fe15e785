"""Staging projections: raw names to working names, nothing else."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _staged(df: DataFrame, *columns: str, **renamed: str) -> DataFrame:
    extra = [F.col(source).alias(name) for name, source in renamed.items()]
    return df.select(*columns, *extra, F.col("_loaded_at").alias("loaded_at"))


def stage_sensor(raw: DataFrame) -> DataFrame:
    return _staged(
        raw, "sensor_id", "sensor_name", "equipment_name", "reading_value", "reading_timestamp",
        "status", "process_area",
    )


def stage_orders(raw: DataFrame) -> DataFrame:
    return _staged(
        raw, "order_id", "order_type", "equipment_id", "material_id", "order_date", "order_quantity",
        "net_value", "status", "priority", "created_by",
    )


def stage_materials(raw: DataFrame) -> DataFrame:
    return _staged(
        raw, "material_id", "material_name", "material_type", "unit_of_measure", "plant_code",
        material_group="material_type",
    )


def stage_vendors(raw: DataFrame) -> DataFrame:
    return _staged(
        raw, "vendor_id", "vendor_name", "vendor_type", "country", "payment_terms",
        vendor_number="vendor_id",
    )


def stage_equipment(raw: DataFrame) -> DataFrame:
    return _staged(
        raw, "equipment_id", "equipment_name", "equipment_type", "location", "install_date",
        "manufacturer", "status",
    )
