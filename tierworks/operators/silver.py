"""Bronze to Silver: typing, flags, cleaning and enrichment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierworks.functions import flags
from tierworks.functions.business import stable_round
from tierworks.functions.keys import surrogate_key
from tierworks.functions.timeparts import boundary_diff, grid_start, to_zone
from tierworks.operators.sequences import first_rows
from tierworks.schemas import DEFAULT_BAND, Band

# Physical unit per sensor type.
UNITS = {"VIBRATION": "mm/s", "TEMPERATURE": "C", "PRESSURE": "bar", "FLOW": "m3/h"}


def enforce_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns with its types; a bad value fails the query."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def safe_cast(df: DataFrame, column: str, kind: str, out: str | None = None, flag: str = "cast_flag") -> DataFrame:
    """Cast without failing; text which does not fit becomes NULL and is flagged FAIL."""
    out = out or column
    typed = F.col(column).try_cast(kind)
    bad = F.col(column).isNotNull() & typed.isNull()
    return df.withColumns({flag: F.when(bad, "FAIL").otherwise("PASS"), out: typed})


def with_time_parts(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns(
        {
            "reading_date": F.to_date(ts),
            "reading_hour": F.hour(ts),
            "hour_start": F.date_trunc("hour", ts).cast("timestamp_ntz"),
        }
    )


def with_date_diffs(df: DataFrame, start: str, end: str, parts: Sequence[str]) -> DataFrame:
    return df.withColumns({f"{p}s_between": boundary_diff(p, start, end) for p in parts})


def clean_sensors(staged: DataFrame, band: Band = DEFAULT_BAND) -> DataFrame:
    """Silver readings: key, quality flag and validity; nothing is removed."""
    return staged.select(
        surrogate_key("sensor_id", "reading_timestamp").alias("sensor_reading_sk"),
        *staged.columns,
        flags.quality_flag("reading_value", band).alias("quality_flag"),
        flags.is_valid("reading_value", band).alias("is_valid"),
    )


def order_line_items(orders: DataFrame) -> DataFrame:
    """Unit price and tier of orders with a positive quantity."""
    return orders.filter(F.col("order_quantity") > 0).select(
        "order_id",
        "material_id",
        "order_quantity",
        "net_value",
        stable_round(F.col("net_value") / F.nullif(F.col("order_quantity"), F.lit(0)), 2).alias("unit_price"),
        flags.order_tier("net_value").alias("order_tier"),
    )


def null_if_invalid(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Replace impossible values by NULL; nothing is imputed."""
    return df.withColumns({c: F.when(~bad, F.col(c)) for c, bad in rules.items()})


def standardise_units(df: DataFrame, type_col: str, value: str, units: Mapping[str, str] = UNITS) -> DataFrame:
    """Unit per sensor type, and Fahrenheit for temperatures."""
    unit = flags.label_lookup(F.col(type_col), units)
    fahrenheit = F.when(F.col(type_col) == "TEMPERATURE", F.col(value) * 9 / 5 + 32)
    return df.withColumns({"unit": unit, "value_fahrenheit": fahrenheit})


def with_audit(df: DataFrame, run_id: str, target: str, loaded_at: str) -> DataFrame:
    return df.withColumns(
        {
            "_loaded_at": F.lit(loaded_at).cast("timestamp_ntz"),
            "_run_id": F.lit(run_id),
            "_target": F.lit(target),
        }
    )


def with_zone(df: DataFrame, ts: str, from_zone: str, zone: str, out: str) -> DataFrame:
    return df.withColumn(out, to_zone(ts, from_zone, zone))


# Fixed value: layout of an application log line.
LOG_PATTERN = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) (\w+) \[(\w+)\] code=(E\d+) user=(\d+)$"


def parse_logs(df: DataFrame, line: str = "line", pattern: str = LOG_PATTERN) -> DataFrame:
    """Fields of a log line; lines of another form keep NULL fields and ``parsed`` false."""
    parsed = F.col(line).rlike(pattern)

    def part(i: int) -> Column:
        return F.when(parsed, F.regexp_extract(F.col(line), pattern, i))

    return df.withColumns(
        {
            "parsed": parsed,
            "logged_at": part(1).cast("timestamp_ntz"),
            "level": part(2),
            "component": part(3),
            "error_code": part(4),
            "user_id": part(5).cast("bigint"),
        }
    )


def align_timestamps(df: DataFrame, ts: str, step_seconds: int, out: str = "aligned_at") -> DataFrame:
    return df.withColumn(out, grid_start(ts, step_seconds))


def select_except(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def keep_status(df: DataFrame, statuses: Sequence[str], column: str = "status") -> DataFrame:
    return df.filter(F.col(column).isin(*statuses))


def drop_noise(df: DataFrame, value: str) -> DataFrame:
    return df.filter(F.col(value).isNotNull() & (F.col(value) > 0))


def promotable(df: DataFrame, require_valid: bool = True) -> DataFrame:
    """Rows allowed into Gold.

    With ``require_valid`` a WARN row outside the same band never passes, as the
    models are written; without it WARN rows count.
    """
    good = F.col("quality_flag").isin("PASS", "WARN")
    return df.filter(good & F.col("is_valid") if require_valid else good)


def latest_slice(df: DataFrame, date_col: str) -> DataFrame:
    """Rows of the latest date, found by a scalar subquery."""
    last = df.agg(F.max(date_col)).scalar()
    return df.filter(F.col(date_col) == last)


def multi_version_keys(df: DataFrame, key: str, version: str) -> DataFrame:
    """Rows of keys with several versions, marked whether they hold the highest version."""
    several = (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"), F.max(version).alias("_top"))
        .filter(F.col("_n") > 1)
        .drop("_n")
    )
    return df.join(several, key).withColumn("is_latest", F.col(version) == F.col("_top")).drop("_top")


def validate_orders(orders: DataFrame, equipment: DataFrame, as_of: str) -> DataFrame:
    """Latest row per order, enriched by equipment, flagged; orphans stay with NULLs.

    The equipment side is hinted nothing: Spark broadcasts it while its size is
    known to be small and otherwise shuffles, splitting skewed units by AQE.
    """
    latest = first_rows(
        orders, ["order_id"],
        [F.col("loaded_at").desc_nulls_last(), F.col("net_value").desc_nulls_last()],
    )
    known = equipment.select(
        F.col("equipment_id").alias("_eq"),
        "equipment_name",
        "equipment_type",
        F.col("location").alias("equipment_location"),
    )
    return latest.join(known, F.col("equipment_id") == F.col("_eq"), "left").select(
        surrogate_key("order_id").alias("order_sk"),
        "order_id", "order_type", "equipment_id", "order_date", "order_quantity", "net_value",
        "status", "priority", "created_by", "loaded_at",
        "equipment_name", "equipment_type", "equipment_location",
        flags.orders_flag(F.col("_eq").isNotNull()).alias("quality_flag"),
        F.datediff(F.lit(as_of).cast("date"), F.col("order_date")).alias("days_since_order"),
    )


def equipment_enriched(staged: DataFrame, as_of: str, status_first: bool = False) -> DataFrame:
    return staged.select(
        surrogate_key("equipment_id").alias("equipment_sk"),
        "equipment_id", "equipment_name", "equipment_type", "location", "install_date", "status", "loaded_at",
        F.datediff(F.lit(as_of).cast("date"), F.col("install_date")).alias("days_since_install"),
        flags.lifecycle_stage("install_date", "status", as_of, status_first=status_first).alias("lifecycle_stage"),
    )


def dim_equipment(enriched: DataFrame) -> DataFrame:
    return enriched.select(
        "equipment_sk", "equipment_id", "equipment_name", "equipment_type", "location",
        "install_date", "status", "days_since_install", "lifecycle_stage",
    )


def lab_silver(readings: DataFrame, band: Band, ts: str = "reading_timestamp") -> DataFrame:
    """Flag, keep running equipment, derive date and hour, one row per sensor and time."""
    inside = F.col("reading_value").between(band.lo, band.hi)
    flagged = readings.withColumn(
        "quality_flag", flags.first_match([(F.col("reading_value").isNull(), "FAIL"), (inside, "PASS")], "WARN")
    )
    running = keep_status(flagged, ["ACTIVE", "MAINTENANCE"])
    return with_time_parts(running, ts).drop("hour_start").dropDuplicates(["sensor_id", ts])
