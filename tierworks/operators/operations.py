"""Run logs, health checks and run reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierworks.functions.flags import first_match
from tierworks.functions.timeparts import boundary_diff
from tierworks.operators.ordering import latest_per_key
from tierworks.schemas import RUN_LOG


def audit_row(df: DataFrame, procedure: str, status: str, at: str, error: str | None = None, log_id: int = 0) -> DataFrame:
    """Run-log row about a result, with its row count; append it with ``sources.sinks.publish``."""
    values = df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(log_id).alias("log_id"),
        F.lit(procedure).alias("procedure_name"),
        F.lit(status).alias("status"),
        "row_count",
        F.lit(at).alias("executed_at"),
        F.lit(error).alias("error_message"),
    )
    return values.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RUN_LOG.fields])


def union_checks(*checks: DataFrame) -> DataFrame:
    """All check results as one table."""
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result


def partner_kpi(kpi: DataFrame, as_of: str, days: int = 90) -> DataFrame:
    """What partners may see: a few columns of the last days."""
    bound = F.date_sub(F.lit(as_of).cast("date"), days)
    return kpi.filter(F.col("kpi_date") >= bound).select(
        "kpi_date", "sensor_name", "avg_reading", "p95_reading", "total_readings"
    )


def run_alerts(log: DataFrame, as_of: str, stale_hours: int = 24) -> DataFrame:
    """Latest run per procedure with minutes since the run before and an alert level."""
    now = F.lit(as_of).cast("timestamp_ntz")
    level = first_match(
        [
            (F.col("status") == "FAILURE", "CRITICAL"),
            (boundary_diff("hour", F.col("executed_at"), now) > stale_hours, "WARNING"),
        ],
        "OK",
    )
    latest = latest_per_key(log, "procedure_name", "executed_at", [F.col("log_id").desc()])
    return latest.select(
        "procedure_name", "status", "error_message", "executed_at", "minutes_since_last_run",
        level.alias("alert_level"),
    )


def _check(df: DataFrame, name: str, passed: Column, details: Column) -> DataFrame:
    return df.select(
        F.lit(name).alias("check_name"),
        F.when(passed, "PASS").otherwise("WARN").alias("status"),
        details.alias("details"),
    )


def health_checks(history: DataFrame, log: DataFrame, as_of: str) -> DataFrame:
    """Does a backup exist, and is the run log recent (24 hours)?"""
    now = F.lit(as_of).cast("timestamp_ntz")
    backups = history.agg(F.count_if(F.col("operation") == "BACKUP").alias("n"))
    audit = log.agg(F.max("executed_at").alias("last"))
    return _check(
        backups, "BACKUP_EXISTS", F.col("n") > 0, F.concat(F.lit("backups found: "), F.col("n").cast("string"))
    ).unionByName(
        _check(
            audit,
            "AUDIT_LOG_RECENT",
            F.coalesce(F.col("last") > now - F.expr("INTERVAL 24 HOURS"), F.lit(False)),
            F.concat(F.lit("last audit entry: "), F.coalesce(F.date_format("last", "yyyy-MM-dd HH:mm:ss"), F.lit("NONE"))),
        )
    )


def run_scorecard(days: DataFrame, max_fail_pct: float = 20.0) -> DataFrame:
    """Gate cascade per daily run: a failed gate makes the later ones SKIP.

    ``days`` has one row per run: null_rows, fail_pct, critical_count, n_rows, n_failed, duration_min.
    """
    bronze = F.col("null_rows") == 0
    silver = F.col("fail_pct") <= max_fail_pct
    gold = F.col("critical_count") == 0
    return days.select(
        "run_date",
        F.when(bronze, "PASS").otherwise("FAIL").alias("bronze_gate"),
        F.when(~bronze, "SKIP").when(silver, "PASS").otherwise("FAIL").alias("silver_gate"),
        F.when(~bronze | ~silver, "SKIP").when(gold, "PASS").otherwise("FAIL").alias("gold_gate"),
        F.when(bronze & silver & gold, "SUCCESS").otherwise("PARTIAL").alias("status"),
        "duration_min",
        F.when(bronze, F.col("n_rows")).otherwise(F.lit(0)).alias("records_processed"),
        F.when(bronze & silver & gold, F.lit(0)).otherwise(F.col("n_failed")).alias("quarantined"),
    )


def daily_runs(silver: DataFrame, alerts: DataFrame) -> DataFrame:
    """Measures of each day's run, the input of ``run_scorecard``."""
    by_day = (
        silver.groupBy(F.col("reading_timestamp").cast("date").alias("run_date"))
        .agg(
            F.count_if(F.col("reading_value").isNull()).alias("null_rows"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("quality_flag") == "FAIL").alias("n_failed"),
            F.min("reading_timestamp").alias("_from"),
            F.max("reading_timestamp").alias("_to"),
        )
        .withColumn("fail_pct", F.col("n_failed") * 100.0 / F.col("n_rows"))
        .withColumn("duration_min", boundary_diff("minute", "_from", "_to"))
        .drop("_from", "_to")
    )
    critical = alerts.groupBy(F.col("kpi_date").alias("run_date")).agg(
        F.count_if(F.col("alert_severity") == "CRITICAL").alias("critical_count")
    )
    return by_day.join(critical, "run_date", "left").fillna(0, ["critical_count"])
