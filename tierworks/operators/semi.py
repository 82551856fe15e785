"""JSON payloads, arrays and structs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierworks.schemas import IOT_PAYLOAD


def json_paths(df: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """Field, array element and nested object of a payload, with casts."""
    v = F.parse_json(payload)
    return df.select(
        "event_id",
        F.variant_get(v, "$.sensor_id", "string").alias("sensor_id"),
        F.variant_get(v, "$.status", "string").alias("status"),
        F.variant_get(v, "$.readings[0].value", "double").alias("first_reading"),
        F.variant_get(v, "$.metadata.location", "string").alias("location"),
        F.to_json(F.variant_get(v, "$.tags", "array<string>")).alias("tags"),
    )


def flatten_array(df: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """One row per element of the readings array, with its position.

    The outer form with a filter after it parses each payload once; the plain form
    makes Spark parse it a second time to skip empty arrays.
    """
    return (
        df.withColumn("_p", F.from_json(payload, IOT_PAYLOAD))
        .select("event_id", "event_timestamp", F.col("_p.sensor_id").alias("sensor_id"),
                F.posexplode_outer("_p.readings").alias("reading_index", "_r"))
        .filter(F.col("reading_index").isNotNull())
        .select(
            "event_id", "event_timestamp", "sensor_id", "reading_index",
            F.col("_r.value").alias("reading_value"), F.col("_r.unit").alias("unit"),
            F.col("_r.quality").alias("quality"),
        )
    )


def flatten_object(df: DataFrame, path: str, payload: str = "raw_payload") -> DataFrame:
    """One row per attribute of a nested object."""
    pairs = F.from_json(F.get_json_object(payload, path), "map<string,string>")
    rows = df.select("event_id", F.explode_outer(pairs).alias("attribute_name", "attribute_value"))
    return rows.filter(F.col("attribute_name").isNotNull())


def object_construct(*columns: str | Column) -> Column:
    return F.to_json(F.struct(*columns))


def array_construct(*values: object) -> Column:
    return F.array(*[F.lit(v) for v in values])


def array_checks(df: DataFrame, tag: str, payload: str = "raw_payload") -> DataFrame:
    """Number of readings and whether a tag is present."""
    p = F.from_json(payload, IOT_PAYLOAD)
    return df.withColumn("_p", p).select(
        "event_id",
        F.size("_p.readings").alias("num_readings"),
        F.array_contains("_p.tags", tag).alias("has_tag"),
    )


# Type names of a warehouse VARIANT by the Spark type of the value.
_TYPE_NAMES = [("OBJECT", "OBJECT"), ("ARRAY", "ARRAY"), ("STRING", "VARCHAR"), ("BOOLEAN", "BOOLEAN"),
               ("BIGINT", "INTEGER"), ("DECIMAL", "DECIMAL"), ("DOUBLE", "DOUBLE"), ("VOID", "NULL_VALUE")]


def _type_name(value: Column) -> Column:
    spark_name = F.schema_of_variant(value)
    name = F.lit(None).cast("string")
    for prefix, label in reversed(_TYPE_NAMES):
        name = F.when(spark_name.startswith(prefix), label).otherwise(name)
    return name


def json_types(df: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """Types of payload, array and element; a JSON null is told from a missing field."""
    v = F.parse_json(payload)

    def part(path: str) -> Column:
        return F.variant_get(v, path, "variant")

    return df.select(
        "event_id",
        _type_name(v).alias("payload_type"),
        _type_name(part("$.readings")).alias("readings_type"),
        _type_name(part("$.readings[1].value")).alias("value_type"),
        F.is_variant_null(part("$.note")).alias("note_is_json_null"),
        part("$.note").isNull().alias("note_is_missing"),
    )


def normalise_json(df: DataFrame, schema: T.StructType, keep: Sequence[str], payload: str = "raw_payload") -> DataFrame:
    return df.select(*keep, F.from_json(payload, schema).alias("_p")).select(*keep, "_p.*")


def sensor_info(df: DataFrame) -> DataFrame:
    return df.withColumn("sensor_info", F.struct("sensor_id", "sensor_name", "equipment_name"))


def explode_readings(lists: DataFrame, keys: Sequence[str], column: str = "all_readings") -> DataFrame:
    return lists.select(*keys, F.posexplode(column).alias("position", "single_reading"))


def hof_transform(lists: DataFrame, places: int, column: str = "all_readings") -> DataFrame:
    return lists.withColumn("rounded_readings", F.transform(column, lambda x: F.round(x, places)))


def hof_filter(lists: DataFrame, above: float, column: str = "all_readings") -> DataFrame:
    return lists.withColumn("high_readings", F.filter(column, lambda x: x.isNotNull() & (x > above)))


def hof_reduce(lists: DataFrame, column: str = "all_readings") -> DataFrame:
    """Sum of the array; a NULL element makes it NULL."""
    return lists.withColumn("total_reading", F.reduce(column, F.lit(0.0), lambda acc, x: acc + x))


def hof_exists(lists: DataFrame, above: float, column: str = "all_readings") -> DataFrame:
    return lists.withColumn("has_high_reading", F.exists(column, lambda x: x > above))


def distinct_statuses(df: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """Distinct units among the readings and tags of a payload, and how many."""
    p = F.from_json(payload, IOT_PAYLOAD)
    units = F.array_distinct(F.concat(F.transform("_p.readings", lambda r: r.unit), F.col("_p.tags")))
    return df.withColumn("_p", p).withColumn("_u", units).select(
        "event_id", F.array_join(F.array_sort("_u"), ",").alias("distinct_values"), F.size("_u").alias("n_values")
    )
