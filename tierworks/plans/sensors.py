"""Queries on sensor readings: staging, flags, KPIs, windows, alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierworks import bindings as b
from tierworks.functions import flags
from tierworks.functions.business import stable_round
from tierworks.functions.keys import row_hash, surrogate_key
from tierworks.operators import gold, ordering, silver, spc
from tierworks.plans import base
from tierworks.plans.oracle import key, rounds, sql, stable
from tierworks.plans.oracle import row_hash as sql_row_hash
from tierworks.plans.registry import query, rounded
from tierworks.schemas import LAB_BAND, TABLES, Band
from tierworks.sources import ingest
from tierworks.sources.files import read_bronze

KPI_DOUBLES = ["avg_reading", "min_reading", "max_reading", "stddev_reading", "median_reading", "p95_reading"]
ALERT_DOUBLES = ["avg_reading", "stddev_reading", "min_reading", "max_reading", "prev_stddev", "prev_max"]
_KPI_COLS = (
    "kpi_sk, sensor_id, sensor_name, equipment_name, process_area, kpi_date, total_readings, warn_count, "
    + rounds(KPI_DOUBLES)
)
_ALERT_COLS = (
    "alert_sk, sensor_id, sensor_name, equipment_name, process_area, kpi_date, total_readings, stability_level, "
    "signal_quality, coefficient_of_variation, has_outlier, expected_lower, expected_upper, range_violated, "
    "volatility_trend, spike_status, alert_severity, " + rounds(ALERT_DOUBLES)
)


# --- scans and staging ----------------------------------------------------------------------


@query("src_01_bronze_scan", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def bronze_scan(spark: SparkSession, d: str) -> DataFrame:
    return read_bronze(spark, f"{d}/events.parquet", TABLES["events"])


@query("src_12_stage_sensor", sql("SELECT * FROM readings", "readings"))
def stage_sensor(spark: SparkSession, d: str) -> DataFrame:
    return base.staged_readings(spark, d)


@query(
    "src_14_date_spine",
    """SELECT CAST(unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS DATE) AS dt
 FROM events""",
)
def date_spine(spark: SparkSession, d: str) -> DataFrame:
    return ingest.date_spine(b.table(spark, d, "events"), "ts")


@query("src_15_recent_window", sql("SELECT * FROM readings WHERE reading_timestamp >= TIMESTAMP '2024-01-25 00:00:00'", "readings"))
def recent_window(spark: SparkSession, d: str) -> DataFrame:
    return ingest.recent(base.staged_readings(spark, d), "reading_timestamp", 7, b.AS_OF)


# --- projections and flags ------------------------------------------------------------------


@query("prj_03_time_parts", """SELECT event_id, CAST(ts AS DATE) AS reading_date, CAST(hour(ts) AS INTEGER) AS reading_hour,
 date_trunc('hour', ts) AS hour_start FROM events""")
def time_parts(spark: SparkSession, d: str) -> DataFrame:
    df = silver.with_time_parts(b.table(spark, d, "events"), "ts")
    return df.select("event_id", "reading_date", "reading_hour", "hour_start")


@query("prj_04_date_diffs", """SELECT event_id, date_diff('year', ts, TIMESTAMP '2025-02-01 00:30:00') AS years_between,
 date_diff('month', ts, TIMESTAMP '2025-02-01 00:30:00') AS months_between,
 date_diff('day', ts, TIMESTAMP '2025-02-01 00:30:00') AS days_between,
 date_diff('hour', ts, TIMESTAMP '2025-02-01 00:30:00') AS hours_between,
 date_diff('minute', ts, TIMESTAMP '2025-02-01 00:30:00') AS minutes_between FROM events""")
def date_diffs(spark: SparkSession, d: str) -> DataFrame:
    df = b.table(spark, d, "events").withColumn("_end", F.lit("2025-02-01 00:30:00").cast("timestamp_ntz"))
    parts = ["year", "month", "day", "hour", "minute"]
    out = silver.with_date_diffs(df, "ts", "_end", parts)
    return out.select("event_id", *[f"{p}s_between" for p in parts])


@query("prj_05_quality_flag", sql("SELECT sensor_reading_sk, reading_value, quality_flag FROM silver", "silver"))
def quality_flag(spark: SparkSession, d: str) -> DataFrame:
    return base.silver_readings(spark, d).select("sensor_reading_sk", "reading_value", "quality_flag")


@query("prj_05_quality_flag_fail_band", """SELECT event_id, CASE WHEN value < 0.5 OR value > 300 THEN 'FAIL'
 WHEN value < 1 OR value > 150 THEN 'WARN' ELSE 'PASS' END AS quality_flag FROM events""")
def quality_flag_fail_band(spark: SparkSession, d: str) -> DataFrame:
    band = Band(1.0, 150.0, 0.5, 300.0)
    return b.table(spark, d, "events").select("event_id", flags.quality_flag("value", band).alias("quality_flag"))


@query("prj_06_is_valid", sql("SELECT sensor_id, reading_timestamp, is_valid FROM silver", "silver"))
def is_valid(spark: SparkSession, d: str) -> DataFrame:
    return base.silver_readings(spark, d).select("sensor_id", "reading_timestamp", "is_valid")


@query("prj_07_bronze_gate", sql("""SELECT sensor_id, reading_timestamp, CASE WHEN sensor_id IS NULL THEN 'FAIL'
 WHEN reading_timestamp IS NULL THEN 'FAIL' WHEN reading_value IS NULL THEN 'FAIL' ELSE 'PASS' END AS bronze_gate
 FROM readings""", "readings"))
def bronze_gate(spark: SparkSession, d: str) -> DataFrame:
    gate = flags.bronze_gate(["sensor_id", "reading_timestamp", "reading_value"])
    return base.staged_readings(spark, d).select("sensor_id", "reading_timestamp", gate.alias("bronze_gate"))


@query("prj_08_gold_gate", sql("""SELECT alert_sk, alert_severity, CASE alert_severity WHEN 'CRITICAL' THEN 'BLOCK'
 WHEN 'WARNING' THEN 'REVIEW' ELSE 'APPROVE' END AS gold_gate FROM alerts""", "alerts"))
def gold_gate(spark: SparkSession, d: str) -> DataFrame:
    return base.alerts(spark, d).select(
        "alert_sk", "alert_severity", flags.gold_gate("alert_severity").alias("gold_gate")
    )


@query("prj_09_risk_gate", sql("""SELECT event_id, rpn, CASE WHEN rpn > 100 THEN 'BLOCK' ELSE 'APPROVE' END AS risk_gate
 FROM (SELECT event_id, (k % 10 + 1) * (user_id % 10 + 1) * (event_id % 10 + 1) AS rpn
 FROM (SELECT CAST(event_id AS BIGINT) AS event_id, k, user_id FROM iot))""", "iot"))
def risk_gate(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    rpn = (k % 10 + 1) * (F.col("user_id") % 10 + 1) * (F.col("event_id") % 10 + 1)
    df = b.table(spark, d, "events").select("event_id", rpn.alias("rpn"))
    return df.withColumn("risk_gate", flags.risk_gate("rpn"))


@query("prj_13_surrogate_key", sql(f"SELECT {key('sensor_id', 'reading_value IS NULL', 'status')} AS sk, sensor_id FROM readings", "readings"))
def surrogate(spark: SparkSession, d: str) -> DataFrame:
    sk = surrogate_key("sensor_id", F.col("reading_value").isNull(), "status")
    return base.staged_readings(spark, d).select(sk.alias("sk"), "sensor_id")


@query("prj_14_row_hash", sql(f"""SELECT order_id, {sql_row_hash('equipment_id', 'order_date', 'priority', 'status')} AS row_hash
 FROM erp_orders""", "erp_orders"))
def order_row_hash(spark: SparkSession, d: str) -> DataFrame:
    tracked = ["equipment_id", "order_date", "priority", "status"]
    return base.staged_orders(spark, d).select("order_id", row_hash(tracked).alias("row_hash"))


@query("prj_16_null_if_invalid", sql("""SELECT sensor_id, reading_timestamp,
 CASE WHEN NOT (reading_value > 150) THEN reading_value END AS reading_value FROM readings""", "readings"))
def null_if_invalid(spark: SparkSession, d: str) -> DataFrame:
    df = silver.null_if_invalid(base.staged_readings(spark, d), {"reading_value": F.col("reading_value") > 150})
    return df.select("sensor_id", "reading_timestamp", "reading_value")


@query("prj_17_standard_units", """SELECT event_id, sensor_type, CASE sensor_type WHEN 'VIBRATION' THEN 'mm/s'
 WHEN 'TEMPERATURE' THEN 'C' WHEN 'PRESSURE' THEN 'bar' WHEN 'FLOW' THEN 'm3/h' END AS unit,
 CAST(round(CAST(CASE WHEN sensor_type = 'TEMPERATURE' THEN value * 9 / 5 + 32 END AS DECIMAL(28, 9)), 6) AS DOUBLE) AS value_fahrenheit
 FROM (SELECT event_id, value, CASE user_id % 4 WHEN 0 THEN 'VIBRATION' WHEN 1 THEN 'TEMPERATURE'
 WHEN 2 THEN 'PRESSURE' ELSE 'FLOW' END AS sensor_type FROM events)""")
def standard_units(spark: SparkSession, d: str) -> DataFrame:
    kind = flags.label_lookup(F.col("user_id") % 4, {0: "VIBRATION", 1: "TEMPERATURE", 2: "PRESSURE"}, F.lit("FLOW"))
    df = b.table(spark, d, "events").select("event_id", "value", kind.alias("sensor_type"))
    return rounded(silver.standardise_units(df, "sensor_type", "value"), ["value_fahrenheit"]).drop("value")


@query("prj_18_validation_status", sql("""SELECT sensor_id, reading_timestamp,
 CASE WHEN reading_value BETWEEN 5 AND 100 THEN 'VALID' ELSE 'INVALID' END AS validation_status FROM readings""", "readings"))
def validation(spark: SparkSession, d: str) -> DataFrame:
    status = flags.validation_status(F.col("reading_value").between(5, 100))
    return base.staged_readings(spark, d).select("sensor_id", "reading_timestamp", status.alias("validation_status"))


@query("prj_19_audit_columns", sql("""SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS _loaded_at, 'run-7' AS _run_id,
 'local' AS _target FROM readings""", "readings"))
def audit_columns(spark: SparkSession, d: str) -> DataFrame:
    return silver.with_audit(base.staged_readings(spark, d), "run-7", "local", b.AS_OF)


@query("prj_20_time_zone", "SELECT event_id, ts, ts + INTERVAL 7 HOUR AS ts_local FROM events")
def time_zone(spark: SparkSession, d: str) -> DataFrame:
    df = b.table(spark, d, "events").select("event_id", "ts")
    return silver.with_zone(df, "ts", "UTC", "Asia/Bangkok", "ts_local")


@query("prj_21_parse_logs", """SELECT event_id, event_id % 25 <> 0 AS parsed,
 CASE WHEN event_id % 25 <> 0 THEN date_trunc('second', ts) END AS logged_at,
 CASE WHEN event_id % 25 <> 0 THEN CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END END AS level,
 CASE WHEN event_id % 25 <> 0 THEN event_type END AS component,
 CASE WHEN event_id % 25 <> 0 THEN 'E' || lpad(json_extract_string(props, '$.k'), 4, '0') END AS error_code,
 CASE WHEN event_id % 25 <> 0 THEN user_id END AS user_id FROM events""")
def parse_logs(spark: SparkSession, d: str) -> DataFrame:
    return silver.parse_logs(b.log_lines(spark, d)).drop("line")


@query("prj_22_align_timestamps", """SELECT event_id, time_bucket(INTERVAL 15 MINUTE, ts) AS aligned_at
 FROM events WHERE value > 0""")
def align(spark: SparkSession, d: str) -> DataFrame:
    df = silver.drop_noise(b.table(spark, d, "events"), "value")
    return silver.align_timestamps(df, "ts", 900).select("event_id", "aligned_at")


@query("prj_23_select_except", "SELECT event_id, ts, user_id, event_type, value FROM events")
def select_except(spark: SparkSession, d: str) -> DataFrame:
    return silver.select_except(b.table(spark, d, "events"), ["props"])


@query("flt_01_status", sql("SELECT * FROM readings WHERE status IN ('ACTIVE', 'MAINTENANCE')", "readings"))
def status_filter(spark: SparkSession, d: str) -> DataFrame:
    return silver.keep_status(base.staged_readings(spark, d), ["ACTIVE", "MAINTENANCE"])


@query("flt_02_noise", sql("SELECT * FROM readings WHERE reading_value IS NOT NULL AND reading_value > 0", "readings"))
def noise_filter(spark: SparkSession, d: str) -> DataFrame:
    return silver.drop_noise(base.staged_readings(spark, d), "reading_value")


@query("flt_03_promotable", sql("SELECT sensor_reading_sk FROM silver WHERE quality_flag IN ('PASS', 'WARN') AND is_valid", "silver"))
def promotable(spark: SparkSession, d: str) -> DataFrame:
    return silver.promotable(base.silver_readings(spark, d)).select("sensor_reading_sk")


@query("flt_04_latest_slice", sql("""SELECT alert_sk, sensor_id, kpi_date, alert_severity FROM alerts
 WHERE kpi_date = (SELECT max(kpi_date) FROM alerts)""", "alerts"))
def latest_slice(spark: SparkSession, d: str) -> DataFrame:
    df = base.alerts(spark, d).select("alert_sk", "sensor_id", "kpi_date", "alert_severity")
    return silver.latest_slice(df, "kpi_date")


# --- aggregation ----------------------------------------------------------------------------


@query("agg_01_daily_sensor_kpi", sql(f"SELECT {_KPI_COLS} FROM kpi", "kpi"))
def daily_kpi(spark: SparkSession, d: str) -> DataFrame:
    return rounded(base.kpi(spark, d), KPI_DOUBLES)


@query("agg_03_equipment_daily_kpi", sql(f"""SELECT equipment_name, reading_date, count(*) AS total_readings,
 {stable('avg(reading_value)', 2)} AS avg_reading, {stable('min(reading_value)', 2)} AS min_reading,
 {stable('max(reading_value)', 2)} AS max_reading, {stable('stddev_samp(reading_value)', 2)} AS stddev_reading,
 string_agg(DISTINCT status, ',' ORDER BY status) AS statuses FROM (
  SELECT DISTINCT *, CAST(reading_timestamp AS DATE) AS reading_date FROM readings
  WHERE status IN ('ACTIVE', 'MAINTENANCE') AND reading_value BETWEEN 0 AND 200) GROUP BY 1, 2""", "readings"))
def equipment_kpi(spark: SparkSession, d: str) -> DataFrame:
    df = gold.equipment_daily_kpi(silver.lab_silver(base.staged_readings(spark, d), LAB_BAND))
    return df.withColumn("statuses", F.array_join("statuses", ","))


@query("agg_04_daily_kpi_with_warnings", sql(f"SELECT {_KPI_COLS} FROM kpi_all", "kpi_all"))
def daily_kpi_all(spark: SparkSession, d: str) -> DataFrame:
    return rounded(base.kpi(spark, d, require_valid=False), KPI_DOUBLES)


@query("agg_05_sensor_summary", sql("SELECT sensor_id, count(*) AS total_count FROM silver GROUP BY 1", "silver"))
def sensor_summary(spark: SparkSession, d: str) -> DataFrame:
    return gold.sensor_summary(base.silver_readings(spark, d))


@query("agg_06_conditional_counts", sql("""SELECT process_area, count(*) AS total_count,
 count(*) FILTER (WHERE quality_flag = 'PASS') AS pass_count, count(*) FILTER (WHERE quality_flag = 'WARN') AS warn_count,
 count(*) FILTER (WHERE quality_flag = 'FAIL') AS fail_count FROM silver GROUP BY 1""", "silver"))
def conditional_counts(spark: SparkSession, d: str) -> DataFrame:
    return gold.conditional_counts(base.silver_readings(spark, d), ["process_area"])


@query("agg_07_guarded", sql(f"""SELECT sensor_id, count(*) AS n_rows, {stable('avg(reading_value)', 8)} AS avg_value
 FROM readings GROUP BY 1 HAVING count(*) >= 70""", "readings"))
def guarded(spark: SparkSession, d: str) -> DataFrame:
    return rounded(gold.guarded_agg(base.staged_readings(spark, d), ["sensor_id"], "reading_value", 70), ["avg_value"], 8)


@query("agg_08_hourly", sql(f"""SELECT equipment_name, date_trunc('hour', reading_timestamp) AS hour_start,
 {stable('avg(reading_value)', 6)} AS avg_value, max(reading_value) AS max_value FROM readings GROUP BY 1, 2""", "readings"))
def hourly(spark: SparkSession, d: str) -> DataFrame:
    df = gold.hourly_agg(base.staged_readings(spark, d), ["equipment_name"], "reading_timestamp", "reading_value")
    return rounded(df, ["avg_value"])


@query("agg_09_reading_lists", sql("""SELECT sensor_id, slot_start,
 coalesce(array_to_string(list_transform(vals, lambda x: CAST(CAST(x AS DECIMAL(10, 2)) AS VARCHAR)), ','), '') AS all_readings,
 statuses AS unique_statuses, CAST(coalesce(len(vals), 0) AS INTEGER) AS reading_count FROM lists""", "lists"))
def reading_lists(spark: SparkSession, d: str) -> DataFrame:
    df = gold.reading_lists(base.staged_readings(spark, d), ["sensor_id"], "reading_timestamp")
    text = F.array_join(F.transform("all_readings", lambda v: v.cast("decimal(10,2)").cast("string")), ",")
    return df.withColumns({"all_readings": text, "unique_statuses": F.array_join("unique_statuses", ",")})


@query("agg_11_severity_daily", sql("""SELECT kpi_date, count(*) FILTER (WHERE alert_severity = 'CRITICAL') AS critical_count,
 count(*) FILTER (WHERE alert_severity = 'WARNING') AS warning_count,
 count(*) FILTER (WHERE alert_severity = 'OK') AS ok_count, count(*) AS total_count FROM alerts GROUP BY 1""", "alerts"))
def severity_daily(spark: SparkSession, d: str) -> DataFrame:
    return gold.severity_daily(base.alerts(spark, d))


@query("agg_11_severity_overall", sql("SELECT alert_severity, count(*) AS alert_count FROM alerts GROUP BY 1", "alerts"))
def severity_overall(spark: SparkSession, d: str) -> DataFrame:
    return gold.severity_overall(base.alerts(spark, d))


@query("agg_14_profile", f"""SELECT 'value' AS column_name, count(value) AS count, {stable('avg(value)', 6)} AS mean,
 {stable('stddev_samp(value)', 6)} AS stddev, min(value) AS min, max(value) AS max FROM events
 UNION ALL SELECT 'user_id', count(user_id), {stable('avg(user_id)', 6)}, {stable('stddev_samp(user_id)', 6)},
 CAST(min(user_id) AS DOUBLE), CAST(max(user_id) AS DOUBLE) FROM events""")
def profile(spark: SparkSession, d: str) -> DataFrame:
    return rounded(gold.profile(b.table(spark, d, "events"), ["value", "user_id"]), ["mean", "stddev"])


@query("agg_15_flag_distribution", sql("SELECT quality_flag, count(*) AS n_rows FROM silver GROUP BY 1", "silver"))
def flag_distribution(spark: SparkSession, d: str) -> DataFrame:
    return gold.flag_distribution(base.silver_readings(spark, d))


@query("agg_15_fail_pct", sql(f"""SELECT {stable("count(*) FILTER (WHERE quality_flag = 'FAIL') * 100.0 / count(*)", 6)} AS fail_pct
 FROM silver""", "silver"))
def fail_pct(spark: SparkSession, d: str) -> DataFrame:
    return gold.fail_pct(base.silver_readings(spark, d)).select(stable_round("fail_pct", 6).alias("fail_pct"))


_SUM_PARTS = ("sensor_id", "reading_timestamp", "status", "CAST(reading_value AS DECIMAL(10, 2))")


@query("agg_16_checksum", sql(f"""SELECT CAST(reading_timestamp AS DATE) AS slice, count(*) AS n_rows,
 CAST(sum(CAST('0x' || substr({sql_row_hash(*_SUM_PARTS)}, 1, 8) AS BIGINT)) AS BIGINT) AS content_sum
 FROM readings GROUP BY 1""", "readings"))
def checksum(spark: SparkSession, d: str) -> DataFrame:
    columns = ["sensor_id", "reading_timestamp", "status", F.col("reading_value").cast("decimal(10,2)")]
    return gold.checksum(base.staged_readings(spark, d), columns, [F.to_date("reading_timestamp").alias("slice")])


# --- windows and duplicates -----------------------------------------------------------------


@query("win_01_rank_readings", sql("""SELECT sensor_id, reading_timestamp, reading_value,
 row_number() OVER (PARTITION BY sensor_id ORDER BY reading_timestamp) AS row_num,
 rank() OVER (PARTITION BY sensor_id ORDER BY reading_value DESC NULLS LAST) AS value_rank,
 dense_rank() OVER (PARTITION BY sensor_id ORDER BY reading_value DESC NULLS LAST) AS value_dense_rank FROM readings""", "readings"))
def rank_readings(spark: SparkSession, d: str) -> DataFrame:
    df = base.staged_readings(spark, d).select("sensor_id", "reading_timestamp", "reading_value")
    return ordering.rank_readings(df, "sensor_id", "reading_timestamp", "reading_value")


@query("win_02_neighbours", sql("""SELECT sensor_id, reading_timestamp, reading_value,
 lag(reading_value) OVER w AS lag_value, lead(reading_value) OVER w AS lead_value FROM readings
 WINDOW w AS (PARTITION BY sensor_id ORDER BY reading_timestamp)""", "readings"))
def neighbours(spark: SparkSession, d: str) -> DataFrame:
    df = base.staged_readings(spark, d).select("sensor_id", "reading_timestamp", "reading_value")
    return ordering.neighbour_readings(df, "sensor_id", "reading_timestamp", "reading_value")


@query("win_03_running_avg_range", sql(f"""SELECT sensor_id, reading_timestamp, hour_start,
 {stable('avg(reading_value) OVER (PARTITION BY sensor_id ORDER BY hour_start)', 7)} AS running_avg
 FROM (SELECT *, date_trunc('hour', reading_timestamp) AS hour_start FROM readings)""", "readings"))
def running_range(spark: SparkSession, d: str) -> DataFrame:
    hour = F.date_trunc("hour", "reading_timestamp").cast("timestamp_ntz")
    df = base.staged_readings(spark, d).select(
        "sensor_id", "reading_timestamp", "reading_value", hour.alias("hour_start")
    )
    out = ordering.running_avg_range(df, "sensor_id", "hour_start", "reading_value")
    return rounded(out, ["running_avg"], 7).drop("reading_value")


@query("win_04_running_avg_rows", sql(f"""SELECT sensor_id, reading_timestamp, count(reading_value) OVER w AS running_count,
 {stable('avg(reading_value) OVER w', 7)} AS running_avg FROM readings WINDOW w AS (PARTITION BY sensor_id
 ORDER BY reading_timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", "readings"))
def running_rows(spark: SparkSession, d: str) -> DataFrame:
    df = base.staged_readings(spark, d).select("sensor_id", "reading_timestamp", "reading_value")
    out = ordering.running_avg_rows(df, "sensor_id", ["reading_timestamp"], "reading_timestamp", "reading_value")
    return rounded(out, ["running_avg"], 7).drop("reading_value")


@query("win_05_previous_day", sql(f"""SELECT kpi_sk, sensor_id, kpi_date, {rounds(['prev_stddev', 'prev_avg', 'prev_max'])}
 FROM with_prev""", "with_prev"))
def previous_day(spark: SparkSession, d: str) -> DataFrame:
    df = spc.with_previous_day(base.stats(spark, d))
    names = ["prev_stddev", "prev_avg", "prev_max"]
    return rounded(df.select("kpi_sk", "sensor_id", "kpi_date", *names), names)


@query("win_06_latest_per_key", sql("""SELECT procedure_name, log_id, status, executed_at, minutes_since_last_run FROM (
 SELECT *, date_diff('minute', lag(executed_at) OVER (PARTITION BY procedure_name ORDER BY executed_at), executed_at)
 AS minutes_since_last_run FROM run_log)
 QUALIFY row_number() OVER (PARTITION BY procedure_name ORDER BY executed_at DESC) = 1""", "run_log"))
def latest_run(spark: SparkSession, d: str) -> DataFrame:
    df = b.run_log(spark, d).select("procedure_name", "log_id", "status", "executed_at")
    return ordering.latest_per_key(df, "procedure_name", "executed_at")


@query("ddp_01_drop_dupes", sql("SELECT DISTINCT order_id, line_number FROM order_lines", "order_lines"))
def drop_dupes(spark: SparkSession, d: str) -> DataFrame:
    keys = ["order_id", "line_number"]
    return ordering.drop_dupes(b.order_lines(spark, d).select(*keys), keys)


@query("ddp_02_dedup_latest", sql("""SELECT * FROM order_lines QUALIFY row_number() OVER (PARTITION BY order_id, line_number
 ORDER BY loaded_at DESC, material_id, vendor_id, net_value, order_quantity) = 1""", "order_lines"))
def dedup_latest(spark: SparkSession, d: str) -> DataFrame:
    order = [F.col("loaded_at").desc(), *[F.col(c).asc() for c in ("material_id", "vendor_id", "net_value", "order_quantity")]]
    return ordering.dedup_latest(b.order_lines(spark, d), ["order_id", "line_number"], order)


@query("ddp_03_duplicate_stats", sql("""SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys,
 CAST(sum(n) - count(*) AS BIGINT) AS duplicates_removed, CAST(sum(n) - count(*) AS DOUBLE) / sum(n) AS duplicate_rate
 FROM (SELECT count(*) AS n FROM order_lines GROUP BY order_id, line_number)""", "order_lines"))
def duplicate_stats(spark: SparkSession, d: str) -> DataFrame:
    return ordering.duplicate_stats(b.order_lines(spark, d), ["order_id", "line_number"])


# --- order, limits, unions ------------------------------------------------------------------


@query("top_01_ordered", sql("SELECT kpi_date, sensor_id, alert_severity FROM alerts ORDER BY kpi_date, sensor_id", "alerts"))
def ordered(spark: SparkSession, d: str) -> DataFrame:
    return base.alerts(spark, d).select("kpi_date", "sensor_id", "alert_severity").orderBy("kpi_date", "sensor_id")


@query("top_02_recent_alerts", sql("""SELECT alert_sk, sensor_id, kpi_date, alert_severity FROM alerts
 WHERE alert_severity <> 'OK' ORDER BY kpi_date DESC, alert_sk LIMIT 20""", "alerts"))
def recent_alerts(spark: SparkSession, d: str) -> DataFrame:
    return gold.recent_alerts(base.alerts(spark, d)).select("alert_sk", "sensor_id", "kpi_date", "alert_severity")


@query("top_03_first_critical", sql("""SELECT process_area, sensor_id, kpi_date FROM alerts WHERE alert_severity = 'CRITICAL'
 QUALIFY row_number() OVER (PARTITION BY process_area ORDER BY kpi_date, sensor_id) = 1""", "alerts"))
def first_critical(spark: SparkSession, d: str) -> DataFrame:
    return gold.first_critical(base.alerts(spark, d), ["process_area"]).select("process_area", "sensor_id", "kpi_date")


@query("top_04_sample_rows", "SELECT event_id, ts, user_id, value FROM events ORDER BY ts, event_id LIMIT 100")
def sample_rows(spark: SparkSession, d: str) -> DataFrame:
    return b.table(spark, d, "events").select("event_id", "ts", "user_id", "value").orderBy("ts", "event_id").limit(100)


@query("set_02_distinct", sql("SELECT DISTINCT sensor_id, reading_timestamp, status FROM readings", "readings"))
def distinct_rows(spark: SparkSession, d: str) -> DataFrame:
    one = base.staged_readings(spark, d).select("sensor_id", "reading_timestamp", "status")
    return one.union(one).union(one).distinct()


# --- statistical process control --------------------------------------------------------------


def _alert_part(name: str, *columns: str, doubles: tuple[str, ...] = ()):
    listed = ", ".join(["alert_sk", *columns])
    extra = f", {rounds(list(doubles))}" if doubles else ""

    @query(name, sql(f"SELECT {listed}{extra} FROM alerts", "alerts"))
    def build(spark: SparkSession, d: str) -> DataFrame:
        return rounded(base.alerts(spark, d).select("alert_sk", *columns, *doubles), list(doubles))

    return build


_alert_part("spc_01_stability", "stability_level", doubles=("stddev_reading",))
_alert_part("spc_02_signal_quality", "signal_quality", "coefficient_of_variation")
_alert_part("spc_03_outlier", "has_outlier", doubles=("min_reading", "max_reading"))
_alert_part("spc_04_range", "range_violated", "expected_lower", "expected_upper")
_alert_part("spc_05_volatility", "volatility_trend", doubles=("stddev_reading", "prev_stddev"))
_alert_part("spc_06_spike", "spike_status", doubles=("max_reading", "prev_max"))
_alert_part("spc_07_severity", "alert_severity")


@query("spc_08_sensor_alerts", sql(f"SELECT {_ALERT_COLS} FROM alerts", "alerts"))
def sensor_alerts(spark: SparkSession, d: str) -> DataFrame:
    return rounded(base.alerts(spark, d), ALERT_DOUBLES)


@query("spc_09_configured_limits", sql("""SELECT kpi_sk AS alert_sk,
 CASE WHEN stddev_reading IS NULL THEN 'INSUFFICIENT_DATA' WHEN stddev_reading < 5 THEN 'STABLE'
  WHEN stddev_reading <= ua THEN 'NORMAL' ELSE 'UNSTABLE' END AS stability_level,
 CASE WHEN avg_reading = 0 OR avg_reading IS NULL THEN 'INVALID'
  WHEN stddev_reading / nullif(abs(avg_reading), 0) > 0.5 THEN 'VERY_NOISY'
  WHEN stddev_reading / nullif(abs(avg_reading), 0) > nc THEN 'NOISY' ELSE 'CLEAN' END AS signal_quality,
 CASE WHEN stddev_reading > ua AND stddev_reading / nullif(abs(avg_reading), 0) > nc THEN 'CRITICAL'
  WHEN stddev_reading > ua OR max_reading > avg_reading + 2 * stddev_reading
   OR (prev_stddev IS NOT NULL AND stddev_reading > prev_stddev * 1.5) THEN 'WARNING' ELSE 'OK' END AS alert_severity
 FROM (SELECT *, CASE CAST(sensor_id AS BIGINT) % 3 WHEN 0 THEN 40 ELSE 25 END AS ua,
 CASE CAST(sensor_id AS BIGINT) % 3 WHEN 1 THEN 0.4 ELSE 0.3 END AS nc FROM with_prev)""", "with_prev"))
def configured_limits(spark: SparkSession, d: str) -> DataFrame:
    group = F.col("user_id") % 3
    limits = b.table(spark, d, "events").select("user_id").distinct().select(
        F.col("user_id").cast("string").alias("sensor_id"),
        F.when(group == 0, F.lit(40.0)).alias("unstable_above"),
        F.when(group == 1, F.lit(0.4)).alias("noisy_cv"),
    )
    out = spc.sensor_alerts_with(base.stats(spark, d), limits)
    return out.select("alert_sk", "stability_level", "signal_quality", "alert_severity")


@query("spc_10_alarm_summary", sql("""SELECT *, CASE WHEN critical_count > 0 THEN 'CRITICAL' WHEN warning_count > 0
 THEN 'WARNING' ELSE 'OK' END AS alarm_level, CAST(CASE WHEN critical_count > 0 THEN 2 WHEN warning_count > 0 THEN 1
 ELSE 0 END AS INTEGER) AS exit_code FROM (SELECT max(kpi_date) AS kpi_date,
 count(*) FILTER (WHERE alert_severity = 'CRITICAL') AS critical_count,
 count(*) FILTER (WHERE alert_severity = 'WARNING') AS warning_count, count(DISTINCT sensor_id) AS sensor_count
 FROM alerts WHERE kpi_date = (SELECT max(kpi_date) FROM alerts))""", "alerts"))
def alarm_summary(spark: SparkSession, d: str) -> DataFrame:
    return spc.alarm_summary(base.alerts(spark, d))


@query("spc_11_route", sql("""SELECT alert_sk, alert_severity, CASE alert_severity WHEN 'CRITICAL' THEN 'PAGE'
 WHEN 'WARNING' THEN 'EMAIL' ELSE 'DASHBOARD' END AS route FROM alerts""", "alerts"))
def route(spark: SparkSession, d: str) -> DataFrame:
    return spc.route(base.alerts(spark, d)).select("alert_sk", "alert_severity", "route")


@query("spc_12_degrading_streaks", sql("""SELECT sensor_id, min(kpi_date) AS first_day, max(kpi_date) AS last_day,
 count(*) AS streak_days FROM (SELECT sensor_id, kpi_date, kpi_date - CAST(row_number() OVER
 (PARTITION BY sensor_id ORDER BY kpi_date) AS INTEGER) AS island FROM alerts WHERE volatility_trend = 'DEGRADING')
 GROUP BY sensor_id, island HAVING count(*) >= 2""", "alerts"))
def degrading_streaks(spark: SparkSession, d: str) -> DataFrame:
    return spc.degrading_streaks(base.alerts(spark, d), days=2)


@query("spc_13_repeat_spikes", sql("""SELECT * FROM (SELECT sensor_id, kpi_date, max_reading, prev_max, has_outlier,
 count(*) OVER (PARTITION BY sensor_id ORDER BY kpi_date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)
 AS spikes_in_window FROM alerts WHERE spike_status = 'SPIKE') WHERE spikes_in_window >= 2""", "alerts"))
def repeat_spikes(spark: SparkSession, d: str) -> DataFrame:
    return spc.repeat_spikes(base.alerts(spark, d))


@query("spc_14_correlated_degradation", sql("""SELECT a.equipment_name, a.kpi_date, a.sensor_id, a.alert_severity,
 n - 1 AS other_sensors FROM alerts a JOIN (SELECT equipment_name, kpi_date, count(DISTINCT sensor_id) AS n FROM alerts
 WHERE volatility_trend = 'DEGRADING' GROUP BY 1, 2 HAVING count(DISTINCT sensor_id) > 1) g
 USING (equipment_name, kpi_date) WHERE volatility_trend = 'DEGRADING'""", "alerts"))
def correlated(spark: SparkSession, d: str) -> DataFrame:
    return spc.correlated_degradation(base.alerts(spark, d))


@query("spc_15_anomaly_score", sql(f"""SELECT r.sensor_id, r.reading_timestamp,
 CASE WHEN stddev_reading IS NULL OR stddev_reading = 0 THEN 0
 ELSE {stable('abs((reading_value - avg_reading) / stddev_reading)', 4)} END AS anomaly_score
 FROM silver r JOIN kpi k ON r.sensor_id = k.sensor_id AND CAST(r.reading_timestamp AS DATE) = k.kpi_date""", "silver", "kpi"))
def anomaly(spark: SparkSession, d: str) -> DataFrame:
    df = spc.reading_scores(base.silver_readings(spark, d), base.stats(spark, d))
    return df.select("sensor_id", "reading_timestamp", "anomaly_score")


@query("spc_16_critical_with_context", sql("""SELECT alert_sk, a.equipment_name, sensor_id, kpi_date, equipment_id,
 equipment_type, location, lifecycle_stage FROM alerts a LEFT JOIN dim_equipment d USING (equipment_name)
 WHERE alert_severity = 'CRITICAL'""", "alerts", "dim_equipment"))
def critical_context(spark: SparkSession, d: str) -> DataFrame:
    df = spc.critical_with_context(base.alerts(spark, d), base.dim_equipment(spark, d))
    return df.select(
        "alert_sk", "equipment_name", "sensor_id", "kpi_date", "equipment_id", "equipment_type", "location",
        "lifecycle_stage",
    )
