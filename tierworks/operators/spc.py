"""Statistical process control over daily KPIs.

Six alert classes and one severity follow from the deviation, the mean, the
extremes and their values of the previous day present for the sensor.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierworks.functions.business import anomaly_score, stable_round
from tierworks.functions.flags import first_match
from tierworks.functions.keys import surrogate_key
from tierworks.operators.silver import latest_slice
from tierworks.schemas import AlertLimits



def limit_columns(limits: AlertLimits = AlertLimits(), overrides: str | None = None) -> dict[str, Column]:
    """Limits as columns: constants, or values of a joined struct falling back to the constants."""
    constants = {name: F.lit(value) for name, value in asdict(limits).items()}
    if overrides is None:
        return constants
    return {name: F.coalesce(F.col(f"{overrides}.{name}"), value) for name, value in constants.items()}


def variation() -> Column:
    """Coefficient of variation; NULL for a zero mean."""
    return F.col("stddev_reading") / F.nullif(F.abs(F.col("avg_reading")), F.lit(0.0))


def stability_level(lim: Mapping[str, Column]) -> Column:
    sd = F.col("stddev_reading")
    return first_match(
        [
            (sd.isNull(), "INSUFFICIENT_DATA"),
            (sd < lim["stable_below"], "STABLE"),
            (sd <= lim["unstable_above"], "NORMAL"),
        ],
        "UNSTABLE",
    )


def signal_quality(lim: Mapping[str, Column]) -> Column:
    mean, cv = F.col("avg_reading"), variation()
    return first_match(
        [
            (mean.isNull() | (mean == 0), "INVALID"),
            (cv > lim["very_noisy_cv"], "VERY_NOISY"),
            (cv > lim["noisy_cv"], "NOISY"),
        ],
        "CLEAN",
    )


def _above(sigmas: Column) -> Column:
    return F.col("max_reading") > F.col("avg_reading") + sigmas * F.col("stddev_reading")


def _below(sigmas: Column) -> Column:
    return F.col("min_reading") < F.col("avg_reading") - sigmas * F.col("stddev_reading")


def has_outlier(lim: Mapping[str, Column]) -> Column:
    k = lim["outlier_sigmas"]
    return F.coalesce(_above(k) | _below(k), F.lit(False))


def range_violated(lim: Mapping[str, Column]) -> Column:
    k = lim["range_sigmas"]
    return F.coalesce(_above(k) | _below(k), F.lit(False))


def volatility_trend(lim: Mapping[str, Column]) -> Column:
    sd, before = F.col("stddev_reading"), F.col("prev_stddev")
    return first_match(
        [
            (before.isNull(), "NO_HISTORY"),
            (sd > before * lim["degrading_ratio"], "DEGRADING"),
            (sd > before * lim["increasing_ratio"], "INCREASING"),
            (sd < before * lim["improving_ratio"], "IMPROVING"),
        ],
        "STEADY",
    )


def spike_status(lim: Mapping[str, Column]) -> Column:
    sd = F.col("stddev_reading")
    jump = F.abs(F.col("max_reading") - F.col("prev_max"))
    shift = F.abs(F.col("avg_reading") - F.coalesce(F.col("prev_avg"), F.col("avg_reading")))
    return first_match(
        [
            (F.col("prev_max").isNull(), "NO_HISTORY"),
            (jump > lim["spike_sigmas"] * F.coalesce(sd, F.lit(0.0)), "SPIKE"),
            (shift > sd, "SHIFT"),
        ],
        "NORMAL",
    )


def alert_severity(lim: Mapping[str, Column]) -> Column:
    sd = F.col("stddev_reading")
    unstable = sd > lim["unstable_above"]
    rising = F.col("prev_stddev").isNotNull() & (sd > F.col("prev_stddev") * lim["degrading_ratio"])
    return first_match(
        [
            (unstable & (variation() > lim["noisy_cv"]), "CRITICAL"),
            (unstable | _above(lim["outlier_sigmas"]) | rising, "WARNING"),
        ],
        "OK",
    )


def with_previous_day(kpi: DataFrame) -> DataFrame:
    """Deviation, mean and maximum of the sensor's previous existing day.

    One window gives all three.  It runs on daily rows, so even a sensor which
    owns most readings has one row per day here.
    """
    w = W.partitionBy("sensor_id").orderBy("kpi_date")
    return kpi.withColumns(
        {
            "prev_stddev": F.lag("stddev_reading").over(w),
            "prev_avg": F.lag("avg_reading").over(w),
            "prev_max": F.lag("max_reading").over(w),
        }
    )


def classify(kpi_with_previous: DataFrame, lim: Mapping[str, Column]) -> DataFrame:
    sigmas = lim["range_sigmas"]
    return kpi_with_previous.select(
        surrogate_key("sensor_id", "kpi_date").alias("alert_sk"),
        "sensor_id", "sensor_name", "equipment_name", "process_area", "kpi_date",
        "avg_reading", "stddev_reading", "min_reading", "max_reading", "total_readings",
        stability_level(lim).alias("stability_level"),
        signal_quality(lim).alias("signal_quality"),
        stable_round(variation(), 4).alias("coefficient_of_variation"),
        has_outlier(lim).alias("has_outlier"),
        stable_round(F.col("avg_reading") - sigmas * F.col("stddev_reading"), 2).alias("expected_lower"),
        stable_round(F.col("avg_reading") + sigmas * F.col("stddev_reading"), 2).alias("expected_upper"),
        range_violated(lim).alias("range_violated"),
        "prev_stddev",
        "prev_max",
        volatility_trend(lim).alias("volatility_trend"),
        spike_status(lim).alias("spike_status"),
        alert_severity(lim).alias("alert_severity"),
    )


def sensor_alerts(kpi: DataFrame, limits: AlertLimits = AlertLimits()) -> DataFrame:
    """One alert row per sensor and day."""
    return classify(with_previous_day(kpi), limit_columns(limits))


def sensor_alerts_with(kpi: DataFrame, limits_df: DataFrame, defaults: AlertLimits = AlertLimits()) -> DataFrame:
    """Alerts with limits per sensor from a table; missing sensors or values use the defaults."""
    names = [c for c in limits_df.columns if c != "sensor_id"]
    packed = limits_df.select(F.col("sensor_id").alias("_sensor"), F.struct(*names).alias("_limits"))
    joined = with_previous_day(kpi).join(packed, F.col("sensor_id") == F.col("_sensor"), "left")
    constants = limit_columns(defaults)
    lim = {**constants, **{n: F.coalesce(F.col(f"_limits.{n}"), constants[n]) for n in names}}
    return classify(joined, lim)


def alarm_summary(alerts: DataFrame) -> DataFrame:
    """Level, counts and exit code of the latest day."""
    severity = F.col("alert_severity")
    crit, warn = F.col("critical_count"), F.col("warning_count")
    return (
        latest_slice(alerts, "kpi_date")
        .agg(
            F.max("kpi_date").alias("kpi_date"),
            F.count_if(severity == "CRITICAL").alias("critical_count"),
            F.count_if(severity == "WARNING").alias("warning_count"),
            F.countDistinct("sensor_id").alias("sensor_count"),
        )
        .withColumns(
            {
                "alarm_level": first_match([(crit > 0, "CRITICAL"), (warn > 0, "WARNING")], "OK"),
                "exit_code": first_match([(crit > 0, 2), (warn > 0, 1)], 0),
            }
        )
    )


# Where each severity is sent.
ROUTES = {"CRITICAL": "PAGE", "WARNING": "EMAIL"}


def route(alerts: DataFrame) -> DataFrame:
    severity = F.col("alert_severity")
    rules = [(severity == level, target) for level, target in ROUTES.items()]
    return alerts.withColumn("route", first_match(rules, "DASHBOARD"))


def degrading_streaks(alerts: DataFrame, days: int = 3) -> DataFrame:
    """Runs of at least ``days`` consecutive calendar days with a DEGRADING trend."""
    w = W.partitionBy("sensor_id").orderBy("kpi_date")
    island = F.date_sub(F.col("kpi_date"), F.row_number().over(w))
    return (
        alerts.filter(F.col("volatility_trend") == "DEGRADING")
        .select("sensor_id", "kpi_date")
        .withColumn("_island", island)
        .groupBy("sensor_id", "_island")
        .agg(
            F.min("kpi_date").alias("first_day"),
            F.max("kpi_date").alias("last_day"),
            F.count(F.lit(1)).alias("streak_days"),
        )
        .filter(F.col("streak_days") >= days)
        .drop("_island")
    )


def repeat_spikes(alerts: DataFrame, days: int = 7, at_least: int = 2) -> DataFrame:
    """Spikes of a sensor in the last ``days`` days up to each spike, where there are several."""
    number = F.datediff(F.col("kpi_date"), F.lit("1970-01-01").cast("date"))
    w = W.partitionBy("sensor_id").orderBy("_day").rangeBetween(-(days - 1), 0)
    return (
        alerts.filter(F.col("spike_status") == "SPIKE")
        .select("sensor_id", "kpi_date", "max_reading", "prev_max", "has_outlier", number.alias("_day"))
        .withColumn("spikes_in_window", F.count(F.lit(1)).over(w))
        .filter(F.col("spikes_in_window") >= at_least)
        .drop("_day")
    )


def correlated_degradation(alerts: DataFrame) -> DataFrame:
    """Degrading sensors with the number of other degrading sensors of their unit that day."""
    degrading = alerts.filter(F.col("volatility_trend") == "DEGRADING").select(
        "sensor_id", "equipment_name", "kpi_date", "alert_severity"
    )
    sensors = F.size(F.collect_set("sensor_id").over(W.partitionBy("equipment_name", "kpi_date")))
    return (
        degrading.filter(F.col("equipment_name").isNotNull())
        .withColumn("other_sensors", (sensors - 1).cast("bigint"))
        .filter(F.col("other_sensors") > 0)
    )


def reading_scores(readings: DataFrame, kpi: DataFrame) -> DataFrame:
    """z-score of each reading against the KPI of its sensor and day."""
    stats = kpi.select("sensor_id", "kpi_date", "avg_reading", "stddev_reading")
    dated = readings.withColumn("kpi_date", F.col("reading_timestamp").cast("date"))
    return dated.join(stats, ["sensor_id", "kpi_date"]).withColumn(
        "anomaly_score", anomaly_score("reading_value", "avg_reading", "stddev_reading")
    )


def critical_with_context(alerts: DataFrame, dim: DataFrame) -> DataFrame:
    """Critical alerts with lifecycle and place of their unit; unknown units are kept."""
    units = dim.select("equipment_name", "equipment_id", "equipment_type", "location", "lifecycle_stage")
    return alerts.filter(F.col("alert_severity") == "CRITICAL").join(units, "equipment_name", "left")
