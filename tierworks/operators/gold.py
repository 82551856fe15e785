"""Silver to Gold: daily facts, summaries and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierworks.functions.business import stable_round
from tierworks.functions.keys import row_number_value, surrogate_key
from tierworks.operators.quantiles import aggregate_with_quantiles
from tierworks.operators.sequences import by_time, first_rows, with_row_number
from tierworks.operators.silver import promotable


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


KPI_KEYS = ["sensor_id", "sensor_name", "equipment_name", "process_area", "kpi_date"]


def kpi_rows(silver: DataFrame, require_valid: bool) -> DataFrame:
    ready = promotable(silver, require_valid).withColumn("kpi_date", F.col("reading_timestamp").cast("date"))
    return ready.select(*KPI_KEYS, "reading_value", "quality_flag")


def _kpi_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_readings"),
        F.avg("reading_value").alias("avg_reading"),
        F.min("reading_value").alias("min_reading"),
        F.max("reading_value").alias("max_reading"),
        F.stddev("reading_value").alias("stddev_reading"),
        count_where(F.col("quality_flag") == "WARN").alias("warn_count"),
    ]


def daily_sensor_stats(silver: DataFrame, require_valid: bool = True) -> DataFrame:
    """The daily KPIs without median and p95: all that alerts need, in one pass."""
    stats = kpi_rows(silver, require_valid).groupBy(*KPI_KEYS).agg(*_kpi_measures())
    return stats.select(surrogate_key("sensor_id", "kpi_date").alias("kpi_sk"), "*")


def daily_sensor_kpi(silver: DataFrame, require_valid: bool = True) -> DataFrame:
    """Readings per sensor and day: count, mean, extremes, sample deviation, median, p95, warnings."""
    kpi = aggregate_with_quantiles(
        kpi_rows(silver, require_valid), KPI_KEYS, "reading_value",
        {"median_reading": 0.5, "p95_reading": 0.95}, _kpi_measures(),
    )
    return kpi.select(
        surrogate_key("sensor_id", "kpi_date").alias("kpi_sk"), *KPI_KEYS,
        "total_readings", "avg_reading", "min_reading", "max_reading", "stddev_reading",
        "median_reading", "p95_reading", "warn_count",
    )


def daily_revenue(validated: DataFrame) -> DataFrame:
    """Revenue per day, equipment type and location, keyed over this whole grain.

    Orders are unique after ``silver.validate_orders``, so they are counted without a shuffle of their own.
    """
    good = validated.filter(F.col("quality_flag").isin("PASS", "WARN"))
    keys = ["revenue_date", "equipment_type", "equipment_location"]
    return (
        good.withColumn("revenue_date", F.col("order_date").cast("date"))
        .groupBy(*keys)
        .agg(
            F.count("order_id").alias("order_count"),
            F.sum(F.coalesce("net_value", F.lit(0.0))).alias("total_revenue"),
            F.avg(F.nullif(F.col("net_value"), F.lit(0.0))).alias("avg_order_value"),
            F.sum(F.coalesce("order_quantity", F.lit(0))).alias("total_quantity"),
            count_where(F.col("quality_flag") == "WARN").alias("warn_count"),
            F.count(F.lit(1)).alias("total_records"),
        )
        .select(surrogate_key(*keys).alias("revenue_sk"), "*")
    )


def equipment_daily_kpi(silver: DataFrame) -> DataFrame:
    """PASS readings per unit and day, rounded to two places, with the states seen."""
    return (
        silver.filter(F.col("quality_flag") == "PASS")
        .groupBy("equipment_name", "reading_date")
        .agg(
            F.count(F.lit(1)).alias("total_readings"),
            stable_round(F.avg("reading_value"), 2).alias("avg_reading"),
            stable_round(F.min("reading_value"), 2).alias("min_reading"),
            stable_round(F.max("reading_value"), 2).alias("max_reading"),
            stable_round(F.stddev("reading_value"), 2).alias("stddev_reading"),
            F.array_sort(F.collect_set("status")).alias("statuses"),
        )
    )


def sensor_summary(silver: DataFrame) -> DataFrame:
    return silver.groupBy("sensor_id").agg(F.count(F.lit(1)).alias("total_count"))


def conditional_counts(silver: DataFrame, by: Sequence[str]) -> DataFrame:
    flag = F.col("quality_flag")
    return silver.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_count"),
        count_where(flag == "PASS").alias("pass_count"),
        count_where(flag == "WARN").alias("warn_count"),
        count_where(flag == "FAIL").alias("fail_count"),
    )


def guarded_agg(df: DataFrame, keys: Sequence[str], value: str, min_rows: int = 1) -> DataFrame:
    """Groups with fewer than ``min_rows`` rows are left out."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.avg(value).alias("avg_value"))
        .filter(F.col("n_rows") >= min_rows)
    )


def hourly_agg(df: DataFrame, keys: Sequence[str], ts: str, value: str) -> DataFrame:
    hour = F.date_trunc("hour", ts).cast("timestamp_ntz").alias("hour_start")
    return df.groupBy(*keys, hour).agg(F.avg(value).alias("avg_value"), F.max(value).alias("max_value"))


def reading_lists(df: DataFrame, keys: Sequence[str], ts: str, unit: str = "hour") -> DataFrame:
    """Readings of each key as one array per time slot, in time order.

    ``unit`` is the slot and the only bound of an array: choose one whose readings suit one row.
    """
    slot = F.date_trunc(unit, ts).cast("timestamp_ntz").alias("slot_start")
    numbered = df.select(*keys, "reading_value", "status", ts, slot)
    entries = F.array_sort(F.collect_list(F.struct(F.col(ts).alias("t"), F.col("reading_value").alias("v"))))
    return (
        numbered.groupBy(*keys, "slot_start")
        .agg(entries.alias("_e"), F.array_sort(F.collect_set("status")).alias("unique_statuses"))
        .withColumn("all_readings", F.filter(F.transform("_e", lambda e: e.v), lambda v: v.isNotNull()))
        .withColumn("reading_count", F.size("all_readings"))
        .drop("_e")
    )


def summary_json(df: DataFrame, key: str, value: str) -> DataFrame:
    """One JSON object per group: key, mean, count."""
    grouped = df.groupBy(key).agg(F.avg(value).alias("avg_reading"), F.count(F.lit(1)).alias("count"))
    return grouped.select(key, F.to_json(F.struct(key, "avg_reading", "count")).alias("summary_json"))


def severity_daily(alerts: DataFrame) -> DataFrame:
    """Alerts per day and severity, one column per severity."""
    severity = F.col("alert_severity")
    return alerts.groupBy("kpi_date").agg(
        *[count_where(severity == s).alias(f"{s.lower()}_count") for s in ("CRITICAL", "WARNING", "OK")],
        F.count(F.lit(1)).alias("total_count"),
    )


def severity_overall(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("alert_severity").agg(F.count(F.lit(1)).alias("alert_count"))


def runs_scorecard(runs: DataFrame) -> DataFrame:
    """Pass rate of each gate, success rate, mean duration and totals over all runs."""

    def rate(condition: Column, name: str) -> Column:
        return (F.avg(condition.cast("int")) * 100).alias(name)

    return runs.agg(
        rate(F.col("bronze_gate") == "PASS", "bronze_pass_rate"),
        rate(F.col("silver_gate") == "PASS", "silver_pass_rate"),
        rate(F.col("gold_gate") == "PASS", "gold_pass_rate"),
        rate(F.col("status") == "SUCCESS", "success_rate"),
        F.avg("duration_min").alias("avg_duration_min"),
        F.sum("records_processed").alias("total_records"),
        F.sum("quarantined").alias("total_quarantined"),
    )


def named_metrics(kpi: DataFrame, revenue: DataFrame, silver: DataFrame) -> DataFrame:
    """The three published metrics as (metric, value) rows."""
    share = F.count_if(F.col("quality_flag").isin("PASS", "WARN")).cast("double")
    total = F.nullif(F.count(F.lit(1)), F.lit(0))
    parts = [
        kpi.agg(F.avg("avg_reading").alias("value")).withColumn("metric", F.lit("daily_avg_sensor_reading")),
        revenue.agg(F.sum("total_revenue").alias("value")).withColumn("metric", F.lit("total_daily_revenue")),
        silver.agg((share / total * 100).alias("value")).withColumn("metric", F.lit("quality_score_pct")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("metric", "value")


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation and extremes per numeric column, from one pass."""
    measures = []
    for c in columns:
        value = F.col(c).cast("double")
        measures.append(
            F.struct(
                F.lit(c).alias("column_name"), F.count(value).alias("count"), F.avg(value).alias("mean"),
                F.stddev(value).alias("stddev"), F.min(value).alias("min"), F.max(value).alias("max"),
            )
        )
    return df.agg(F.array(*measures).alias("p")).select(F.explode("p").alias("p")).select("p.*")


def flag_distribution(silver: DataFrame, flag: str = "quality_flag") -> DataFrame:
    return silver.groupBy(flag).agg(F.count(F.lit(1)).alias("n_rows"))


def fail_pct(silver: DataFrame, flag: str = "quality_flag") -> DataFrame:
    failed = F.count_if(F.col(flag) == "FAIL")
    return silver.agg((failed * 100.0 / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("fail_pct"))


def checksum(df: DataFrame, columns: Sequence[str], by: Sequence[Column]) -> DataFrame:
    """Content fingerprint per slice which does not depend on row order."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(row_number_value(columns)).alias("content_sum")
    )


def recent_alerts(alerts: DataFrame, n: int = 20) -> DataFrame:
    """Latest alerts which are not OK; ties are broken by the key."""
    return (
        alerts.filter(F.col("alert_severity") != "OK")
        .orderBy(F.col("kpi_date").desc(), "alert_sk")
        .limit(n)
    )


def first_critical(alerts: DataFrame, by: Sequence[str]) -> DataFrame:
    critical = alerts.filter(F.col("alert_severity") == "CRITICAL")
    return first_rows(critical, by, [F.col("kpi_date").asc(), F.col("sensor_id").asc()])


def volume_check(df: DataFrame, ts: str, alarm_below: int, lo: int, hi: int) -> DataFrame:
    """Rows per day against the healthy band."""
    n = F.col("n_rows")
    return (
        df.groupBy(F.col(ts).cast("date").alias("load_date"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn(
            "volume_status",
            F.when(n < alarm_below, "ALARM").when(n.between(lo, hi), "HEALTHY").otherwise("WATCH"),
        )
    )
