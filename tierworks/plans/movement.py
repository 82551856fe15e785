"""Queries which write and stream: files, layouts, backups, micro-batches and the whole run.

Each one writes under the shared folder of the session, in a fresh place, and
returns what a reader of the written table sees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierworks import bindings as b
from tierworks.operators import quality
from tierworks.operators.ordering import sessions
from tierworks.plans import base
from tierworks.plans.medallion import RunConfig, read_gates, run_medallion
from tierworks.plans.oracle import rounds, sql, stable
from tierworks.plans.registry import query, rounded
from tierworks.schemas import EQUIPMENT, TABLES
from tierworks.session import work_dir
from tierworks.sources import files, ingest, sinks
from tierworks.streaming import runs, streams

EVENTS_FILE = "events.parquet"


# --- sources ---------------------------------------------------------------------------------------


@query("src_02_csv_table", sql("SELECT * EXCLUDE (loaded_at), loaded_at AS _loaded_at FROM equipment", "equipment"))
def csv_table(spark: SparkSession, d: str) -> DataFrame:
    out = work_dir(spark, "csv")
    b.equipment_master(spark, d).write.option("header", True).option("nullValue", "NULL").csv(out)
    return files.read_csv_table(spark, out, EQUIPMENT)


@query("src_02_csv_orders", sql("SELECT order_id, equipment_id, order_date, priority FROM erp_orders", "erp_orders"))
def csv_orders(spark: SparkSession, d: str) -> DataFrame:
    """NULL written as text comes back as NULL."""
    out = work_dir(spark, "csv")
    columns = ["order_id", "equipment_id", "order_date", "priority"]
    b.raw_orders(spark, d).select(*columns).write.option("header", True).option("nullValue", "null").csv(out)
    schema = T.StructType.fromDDL("order_id string, equipment_id string, order_date date, priority string")
    return files.read_csv_table(spark, out, schema)


@query("src_03_json_events", """SELECT event_id, event_type, CASE WHEN value > 150 THEN NULL ELSE value END AS value,
 value > 150 AS field_left_out FROM events""")
def json_events(spark: SparkSession, d: str) -> DataFrame:
    out = work_dir(spark, "json")
    record = b.table(spark, d, "events").select(
        "event_id", "event_type", F.when(F.col("value") <= 150, F.col("value")).alias("value")
    )
    record.write.option("ignoreNullFields", False).json(out)
    schema = T.StructType.fromDDL("event_id bigint, event_type string, value double")
    df = files.read_json_events(spark, out, schema)
    return df.select("event_id", "event_type", "value", (~F.contains("raw_payload", F.lit('"value"'))).alias("field_left_out"))


@query("src_04_ingest_stream", "SELECT *, 'events.parquet' AS _source_file FROM events")
def ingest_stream(spark: SparkSession, d: str) -> DataFrame:
    out = work_dir(spark, "ingest")
    for _ in range(2):  # the second run finds nothing new
        df = runs.ingest_files_stream(spark, d, f"{out}/table", f"{out}/checkpoint", TABLES["events"], EVENTS_FILE)
    return df


@query("src_05_copy_into", "SELECT * FROM events")
def copy_into(spark: SparkSession, d: str) -> DataFrame:
    out = work_dir(spark, "copy")
    for _ in range(2):  # loaded files are skipped
        ingest.copy_into(spark, d, out, TABLES["events"], EVENTS_FILE)
    return ingest.read_loaded(spark, out).drop("_source_file")


def _dirty_csv(spark: SparkSession, d: str) -> DataFrame:
    """Events as CSV, one folder per type; values of errors are not numbers."""
    out = work_dir(spark, "dirty")
    bad = F.col("event_type") == "error"
    text = F.when(bad, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    rows = b.table(spark, d, "events").select("event_id", text.alias("value"), F.col("event_type").alias("kind"))
    rows.write.option("header", True).partitionBy("kind").csv(out)
    return files.read_csv_checked(spark, f"{out}/*", T.StructType.fromDDL("event_id bigint, value double"))


@query("src_06_continue", "SELECT event_id, value FROM events WHERE event_type <> 'error'")
def policy_continue(spark: SparkSession, d: str) -> DataFrame:
    return files.load_with_policy(_dirty_csv(spark, d), "CONTINUE").select("event_id", "value")


@query("src_06_skip_file", "SELECT event_id, value FROM events WHERE event_type <> 'error'")
def policy_skip_file(spark: SparkSession, d: str) -> DataFrame:
    return files.load_with_policy(_dirty_csv(spark, d), "SKIP_FILE").select("event_id", "value")


@query("src_07_rejects", "SELECT event_id || ',n/a' AS rejected_record FROM events WHERE event_type = 'error'")
def rejects(spark: SparkSession, d: str) -> DataFrame:
    return files.load_rejects(_dirty_csv(spark, d)).select("rejected_record")


# --- sinks -------------------------------------------------------------------------------------------


@query("snk_01_publish", sql("SELECT * FROM readings", "readings"))
def publish(spark: SparkSession, d: str) -> DataFrame:
    """Overwrite with the first half, append the rest."""
    out = work_dir(spark, "publish")
    early = F.col("reading_timestamp") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    readings = base.staged_readings(spark, d)
    sinks.publish(readings.filter(early), out)
    sinks.publish(readings.filter(~early), out, mode="append")
    return spark.read.parquet(out)


@query("snk_02_overwrite_partitions", """SELECT event_id, value, CAST(ts AS DATE) AS day FROM events
 WHERE CAST(ts AS DATE) < DATE '2024-01-16' UNION ALL SELECT event_id, -value, CAST(ts AS DATE) FROM events
 WHERE CAST(ts AS DATE) >= DATE '2024-01-16'""")
def overwrite_partitions(spark: SparkSession, d: str) -> DataFrame:
    out = work_dir(spark, "partitions")
    events = b.table(spark, d, "events").select("event_id", "value", F.to_date("ts").alias("day"))
    sinks.publish(events, out, partition_by=["day"], spread=4)
    later = events.filter(F.col("day") >= F.lit("2024-01-16").cast("date"))
    sinks.overwrite_partitions(later.withColumn("value", -F.col("value")), out, ["day"])
    return spark.read.schema("event_id bigint, value double, day date").parquet(out)


@query("snk_03_bronze_layout", """SELECT event_id, CAST(ts + INTERVAL 5 MINUTE AS DATE) AS ingest_date, 'events' AS source
 FROM events""")
def bronze_layout(spark: SparkSession, d: str) -> DataFrame:
    out = work_dir(spark, "bronze")
    loaded = F.to_date(F.col("ts") + F.expr("INTERVAL 5 MINUTES"))
    events = b.table(spark, d, "events").select("event_id", loaded.alias("ingest_date"), F.lit("events").alias("source"))
    sinks.publish(events, out, partition_by=["ingest_date", "source"], spread=4)
    return spark.read.schema("event_id bigint, ingest_date date, source string").parquet(out)


@query("snk_04_clustered", "SELECT l_orderkey, l_partkey, l_quantity, l_shipdate FROM lineitem")
def clustered(spark: SparkSession, d: str) -> DataFrame:
    out = work_dir(spark, "clustered")
    lines = b.table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    sinks.publish_clustered(lines, out, ["l_orderkey", "l_partkey"], files=8)
    return spark.read.parquet(out)


@query("snk_05_compact", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def compact(spark: SparkSession, d: str) -> DataFrame:
    out = work_dir(spark, "compact")
    orders = b.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    sinks.publish(orders.repartition(16), f"{out}/small")
    sinks.compact(spark, f"{out}/small", f"{out}/large", 2)
    return spark.read.parquet(f"{out}/large")


@query("snk_06_table_detail", "SELECT CAST(CAST(max(ts) AS DATE) - CAST(min(ts) AS DATE) + 1 AS BIGINT) AS num_files, 'day' AS partition_columns FROM events")
def table_detail(spark: SparkSession, d: str) -> DataFrame:
    """One file per day is written, and the listing counts them."""
    out = work_dir(spark, "detail")
    events = b.table(spark, d, "events").select("event_id", F.to_date("ts").alias("day"))
    sinks.publish(events, out, partition_by=["day"], spread=1)
    return sinks.table_detail(spark, out, ["day"]).drop("size_bytes")


@query("dq_16_append_checked", sql("SELECT * FROM readings WHERE reading_value IS NOT NULL", "readings"))
def append_checked(spark: SparkSession, d: str) -> DataFrame:
    """The clean batch is appended; the batch with NULL readings is refused whole."""
    out = work_dir(spark, "checked")
    readings = base.staged_readings(spark, d)
    sinks.append_checked(readings.filter("reading_value IS NOT NULL"), out, "reading_value IS NOT NULL")
    try:
        sinks.append_checked(readings, out, "reading_value IS NOT NULL")
    except ValueError:
        pass
    return spark.read.parquet(out)


# --- backups ------------------------------------------------------------------------------------------


@query("chg_20_last_good", sql("SELECT vendor_number AS vendor_id, *, true AS _is_cached FROM vendors1", "vendors1"))
def last_good(spark: SparkSession, d: str) -> DataFrame:
    """A backup before the rebuild is read when the rebuilt table fails its gate."""
    out = work_dir(spark, "gold")
    sinks.publish(base.staged_vendors(spark, d), f"{out}/gold")
    sinks.backup(spark, f"{out}/gold", f"{out}/backup")
    sinks.publish(base.staged_vendors(spark, d, 2), f"{out}/gold")
    return sinks.read_last_good(spark, f"{out}/gold", f"{out}/backup", gate_passed=False)


# --- streams ---------------------------------------------------------------------------------------------


def _stream(spark: SparkSession, d: str) -> DataFrame:
    """Raw readings as a stream over the events file."""
    return b.readings_of(streams.file_stream(spark, d, TABLES["events"], EVENTS_FILE))


_FLAGGED = sql("SELECT sensor_id, reading_timestamp, reading_value, quality_flag, is_valid FROM silver", "silver")
_FLAG_COLUMNS = ["sensor_id", "reading_timestamp", "reading_value", "quality_flag", "is_valid"]


@query("str_01_flag_stream", _FLAGGED)
def flag_stream(spark: SparkSession, d: str) -> DataFrame:
    out = work_dir(spark, "flag")
    stream = streams.flag_stream(_stream(spark, d), b.TEST_BAND).select(*_FLAG_COLUMNS)
    runs.run_append(stream, f"{out}/table", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/table")


@query("str_02_micro_batches", _FLAGGED)
def micro_batches(spark: SparkSession, d: str) -> DataFrame:
    out = work_dir(spark, "micro")
    stream = streams.flag_stream(_stream(spark, d), b.TEST_BAND).select(*_FLAG_COLUMNS)
    runs.drain(runs.start_append(stream, f"{out}/table", f"{out}/checkpoint", interval="1 second"))
    return spark.read.parquet(f"{out}/table")


#: Partitions of merged tables, derived from their keys.
WINDOW_DAY = {"window_day": "to_date(window_start)"}
USER_PART = {"user_mod_16": "pmod(user_id, 16)"}

_HOURLY = """SELECT sensor_id, date_trunc('hour', reading_timestamp) AS window_start,
 date_trunc('hour', reading_timestamp) + INTERVAL 1 HOUR AS window_end, """ + stable("avg(reading_value)", 6) + """ AS avg_reading,
 count(*) AS n_readings FROM readings GROUP BY 1, 2, 3"""


def _halves(spark: SparkSession, d: str):
    events = b.table(spark, d, "events")
    early = F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    return events.filter(early), events.filter(~early)


def _landed(spark: SparkSession, parts, out: str) -> DataFrame:
    """The parts as files of a landing folder, streamed one file a batch in the order given."""
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(f"{out}/landing")
    return streams.file_stream(spark, f"{out}/landing", TABLES["events"], files_per_batch=1)


@query("str_03_hourly_complete", sql(_HOURLY, "readings"))
def hourly_complete(spark: SparkSession, d: str) -> DataFrame:
    """The whole result after every batch; the older half of the readings comes last and is not lost."""
    out = work_dir(spark, "hourly")
    early, late = _halves(spark, d)
    windows = streams.hourly_stream(b.readings_of(_landed(spark, [late, early], out)), "reading_timestamp")
    return rounded(runs.run_complete(windows, f"{out}/table", f"{out}/checkpoint"), ["avg_reading"])


@query("str_04_hourly_append", sql(f"""SELECT * FROM ({_HOURLY}) WHERE window_end <=
 (SELECT date_trunc('millisecond', max(reading_timestamp)) - INTERVAL 2 HOUR FROM readings)""", "readings"))
def hourly_append(spark: SparkSession, d: str) -> DataFrame:
    """Only windows the watermark has closed are written."""
    out = work_dir(spark, "closed")
    windows = streams.hourly_stream(_stream(spark, d), "reading_timestamp", "2 hours")
    runs.run_append(windows, f"{out}/table", f"{out}/checkpoint")
    return rounded(spark.read.parquet(f"{out}/table"), ["avg_reading"])


@query("str_05_hourly_update", sql(_HOURLY, "readings"))
def hourly_update(spark: SparkSession, d: str) -> DataFrame:
    out = work_dir(spark, "update")
    windows = streams.hourly_stream(_stream(spark, d), "reading_timestamp", "2 hours")
    keys = ["sensor_id", "window_start", "window_end"]
    return rounded(runs.run_update(windows, f"{out}/table", f"{out}/checkpoint", keys, WINDOW_DAY), ["avg_reading"])


@query("str_06_restart", "SELECT event_id, value FROM events")
def restart(spark: SparkSession, d: str) -> DataFrame:
    """A second run from the same checkpoint loads only the file which came in between."""
    out = work_dir(spark, "restart")
    for part in _halves(spark, d):
        part.write.mode("append").parquet(f"{out}/landing")
        stream = streams.file_stream(spark, f"{out}/landing", TABLES["events"]).select("event_id", "value")
        runs.run_append(stream, f"{out}/table", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/table")


@query("str_07_dedup_stream", "SELECT event_id, user_id, ts, value FROM events")
def dedup_stream(spark: SparkSession, d: str) -> DataFrame:
    """Every event arrives twice and is kept once."""
    out = work_dir(spark, "dedup")
    for _ in range(2):
        b.table(spark, d, "events").write.mode("append").parquet(f"{out}/landing")
    stream = streams.file_stream(spark, f"{out}/landing", TABLES["events"])
    once = streams.dedup_stream(stream, "ts", ["event_id"], "2 hours").select("event_id", "user_id", "ts", "value")
    runs.run_append(once, f"{out}/table", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/table")


_SESSION_SQL = """SELECT user_id, session_no, min(ts) AS session_start, max(ts) AS session_last, count(*) AS n_events FROM (
 SELECT *, CAST(sum(CASE WHEN prev IS NULL OR ts >= prev + INTERVAL 6 HOUR THEN 1 ELSE 0 END)
  OVER (PARTITION BY user_id ORDER BY ts) AS BIGINT) AS session_no FROM (
  SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events)) GROUP BY 1, 2"""


@query("str_08_sessions_batch", f"""SELECT *, n_events / (greatest(date_diff('second', session_start, session_last), 1) / 60.0) > 0.1 AS is_bot
 FROM ({_SESSION_SQL})""")
def sessions_batch(spark: SparkSession, d: str) -> DataFrame:
    return sessions(b.table(spark, d, "events"), "user_id", "ts", 6 * 3600, max_rate=0.1)


@query("str_08_sessions_stream", f"""SELECT user_id, session_start AS window_start, session_last + INTERVAL 6 HOUR AS window_end, n_events
 FROM ({_SESSION_SQL}) WHERE session_last + INTERVAL 6 HOUR <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 HOUR FROM events)""")
def sessions_stream(spark: SparkSession, d: str) -> DataFrame:
    """Sessions the watermark has closed; only open ones are held as state."""
    out = work_dir(spark, "sessions")
    stream = streams.file_stream(spark, d, TABLES["events"], EVENTS_FILE)
    windows = streams.session_stream(stream, "user_id", "ts", "6 hours", "2 hours")
    runs.run_append(windows, f"{out}/table", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/table")


@query("str_09_stream_upsert", """SELECT user_id, event_id, ts, value FROM events
 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The latest reading per sensor, merged from two micro-batches."""
    out = work_dir(spark, "upsert")
    for part in _halves(spark, d):
        part.write.mode("append").parquet(f"{out}/landing")
        stream = streams.file_stream(spark, f"{out}/landing", TABLES["events"]).select("user_id", "event_id", "ts", "value")
        df = runs.stream_upsert(stream, f"{out}/table", ["user_id"], ["ts", "event_id"], f"{out}/checkpoint", USER_PART)
    return df


@query("str_11_stream_expectations", sql("SELECT sensor_id, reading_timestamp, reading_value FROM readings WHERE reading_value IS NOT NULL", "readings"))
def stream_expectations(spark: SparkSession, d: str) -> DataFrame:
    out = work_dir(spark, "expect")
    checked = quality.expect_stream(
        _stream(spark, d),
        warn={"in_band": "reading_value BETWEEN 1 AND 150"},
        drop={"has_value": "reading_value IS NOT NULL"},
    )
    runs.run_append(checked.select("sensor_id", "reading_timestamp", "reading_value"), f"{out}/table", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/table")


_WINDOW_STATS = ["avg_reading", "stddev_reading", "max_reading"]


@query("str_13_stream_alerts", sql(f"""SELECT sensor_id, window_start, window_end, n_readings, stability_level, signal_quality,
 alert_severity, {rounds(_WINDOW_STATS)} FROM (SELECT *,
 CASE WHEN stddev_reading IS NULL THEN 'INSUFFICIENT_DATA' WHEN stddev_reading < 5 THEN 'STABLE' WHEN stddev_reading <= 25 THEN 'NORMAL'
  ELSE 'UNSTABLE' END AS stability_level,
 CASE WHEN avg_reading = 0 OR avg_reading IS NULL THEN 'INVALID' WHEN stddev_reading / nullif(abs(avg_reading), 0) > 0.5 THEN 'VERY_NOISY'
  WHEN stddev_reading / nullif(abs(avg_reading), 0) > 0.3 THEN 'NOISY' ELSE 'CLEAN' END AS signal_quality,
 CASE WHEN stddev_reading > 25 AND stddev_reading / nullif(abs(avg_reading), 0) > 0.3 THEN 'CRITICAL'
  WHEN stddev_reading > 25 OR max_reading > avg_reading + 2 * stddev_reading THEN 'WARNING' ELSE 'OK' END AS alert_severity
 FROM (SELECT sensor_id, date_trunc('day', reading_timestamp) AS window_start, date_trunc('day', reading_timestamp) + INTERVAL 1 DAY AS window_end,
 count(*) AS n_readings, avg(reading_value) AS avg_reading, stddev_samp(reading_value) AS stddev_reading, max(reading_value) AS max_reading
 FROM readings GROUP BY 1, 2, 3)) WHERE window_end <= (SELECT max(reading_timestamp) - INTERVAL 2 HOUR FROM readings)""", "readings"))
def stream_alerts(spark: SparkSession, d: str) -> DataFrame:
    out = work_dir(spark, "alerts")
    alerts = streams.stream_alerts(_stream(spark, d), "reading_timestamp")
    runs.run_append(alerts, f"{out}/table", f"{out}/checkpoint")
    return rounded(spark.read.parquet(f"{out}/table"), _WINDOW_STATS)


_TREND_STATS = ["avg_reading", "stddev_reading", "min_reading", "max_reading", "prev_stddev", "prev_max"]


@query("str_13_alarm_trends", sql(f"""SELECT sensor_id, CAST(kpi_date AS TIMESTAMP) AS window_start, total_readings AS n_readings,
 stability_level, signal_quality, has_outlier, range_violated, volatility_trend, spike_status, alert_severity, {rounds(_TREND_STATS)}
 FROM alerts WHERE CAST(kpi_date AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT date_trunc('millisecond', max(reading_timestamp)) - INTERVAL 1 DAY
 FROM silver WHERE quality_flag IN ('PASS', 'WARN') AND is_valid)""", "alerts"))
def alarm_trends(spark: SparkSession, d: str) -> DataFrame:
    """Alert classes with trend and spike on the stream: five files, in which readings come up to twelve hours out of order."""
    out = work_dir(spark, "trends")
    hours = F.timestamp_diff("HOUR", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")) + F.pmod("event_id", F.lit(12))
    events = b.table(spark, d, "events").withColumn("_part", F.floor(hours / 168))
    parts = [events.where(F.col("_part") <= 0), *(events.where(F.col("_part") == k) for k in (1, 2, 3)), events.where(F.col("_part") > 3)]
    stream = b.readings_of(_landed(spark, [p.drop("_part") for p in parts], out))
    good = streams.flag_stream(stream, b.TEST_BAND).where(F.col("quality_flag").isin("PASS", "WARN") & F.col("is_valid"))
    alerts = streams.alarm_stream(good, "reading_timestamp", watermark="1 day")
    runs.run_append(alerts, f"{out}/table", f"{out}/checkpoint", keyed_state=True)
    found = spark.read.parquet(f"{out}/table").drop("window_end", "prev_avg")
    return rounded(found, _TREND_STATS)


@query("str_11_batch_metrics", sql("""SELECT CAST(half AS BIGINT) AS batch_id, expectation, action, violations, n - CASE WHEN action = 'drop' THEN violations ELSE 0 END AS rows_kept
 FROM (SELECT half, e.expectation, e.action, count(*) AS n, count(*) FILTER (WHERE CASE e.expectation WHEN 'in_band'
  THEN reading_value IS NULL OR reading_value NOT BETWEEN 1 AND 150 ELSE reading_value IS NULL END) AS violations
  FROM (SELECT *, CASE WHEN reading_timestamp < TIMESTAMP '2024-01-16 00:00:00' THEN 0 ELSE 1 END AS half FROM readings),
  (VALUES ('in_band', 'warn'), ('has_value', 'drop')) AS e(expectation, action) GROUP BY ALL)""", "readings"))
def batch_metrics(spark: SparkSession, d: str) -> DataFrame:
    """The counts of each batch, kept as rows."""
    out = work_dir(spark, "metrics")
    readings = b.readings_of(_landed(spark, _halves(spark, d), out)).select("sensor_id", "reading_timestamp", "reading_value")
    rules = {"in_band": ("warn", "reading_value BETWEEN 1 AND 150"), "has_value": ("drop", "reading_value IS NOT NULL")}
    runs.run_checked(readings, f"{out}/table", f"{out}/metrics", f"{out}/checkpoint", rules)
    return spark.read.parquet(f"{out}/metrics").withColumn("batch_id", F.col("batch_id").cast("bigint"))


@query("join_09_stream_static", sql("""SELECT sensor_id, reading_timestamp, equipment_name, equipment_type, location FROM readings
 LEFT JOIN equipment USING (equipment_name)""", "readings", "equipment"))
def stream_static(spark: SparkSession, d: str) -> DataFrame:
    out = work_dir(spark, "enriched")
    units = base.staged_equipment(spark, d).select("equipment_name", "equipment_type", "location")
    signal = _stream(spark, d).select("sensor_id", "reading_timestamp", "equipment_name")
    runs.run_append(streams.enrich_stream(signal, units, "equipment_name"), f"{out}/table", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/table")


# --- the whole run -----------------------------------------------------------------------------------------


@query("ops_06_medallion_run", sql(f"""SELECT gate, CASE WHEN measure <= lim THEN 'PASS' ELSE 'FAIL' END AS decision,
 {stable('measure', 6)} AS measure FROM (SELECT 'bronze' AS gate,
 CAST(count(*) FILTER (WHERE sensor_id IS NULL OR reading_timestamp IS NULL) AS DOUBLE) AS measure, 0 AS lim FROM readings
 UNION ALL SELECT 'silver', count(*) FILTER (WHERE quality_flag = 'FAIL') * 100.0 / count(*), 20 FROM silver
 UNION ALL SELECT 'gold', count(*) FILTER (WHERE alert_severity = 'CRITICAL'), 0 FROM alerts
  WHERE kpi_date = (SELECT max(kpi_date) FROM alerts))""", "readings", "silver", "alerts"))
def medallion_run(spark: SparkSession, d: str) -> DataFrame:
    cfg = RunConfig(
        root=work_dir(spark, "run"), at=b.AS_OF, band=b.TEST_BAND, required=("sensor_id", "reading_timestamp")
    )
    run_medallion(b.sensor_readings(spark, d), cfg)
    return rounded(read_gates(spark, cfg), ["measure"])


@query("ops_06_bronze_gate_stops", sql("""SELECT 'bronze' AS gate, 'FAIL' AS decision, CAST(count(*) AS DOUBLE) AS measure FROM readings
 WHERE reading_value IS NULL UNION ALL SELECT 'silver', 'SKIP', 0 UNION ALL SELECT 'gold', 'SKIP', 0""", "readings"))
def bronze_gate_stops(spark: SparkSession, d: str) -> DataFrame:
    """With readings required, missing ones stop the run at the first gate."""
    cfg = RunConfig(root=work_dir(spark, "run"), at=b.AS_OF, band=b.TEST_BAND)
    run_medallion(b.sensor_readings(spark, d), cfg)
    return read_gates(spark, cfg)
