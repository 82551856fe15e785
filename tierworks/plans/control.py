"""Queries on data quality, gates, payloads, named functions, access rules and run logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierworks import bindings as b
from tierworks.functions import business, masking
from tierworks.functions.flags import label_lookup
from tierworks.operators import gold, merge, operations, quality, semi
from tierworks.operators.ordering import dedup_latest, late_rows
from tierworks.plans import base
from tierworks.plans.oracle import rounds, sql, stable
from tierworks.plans.registry import query, rounded
from tierworks.schemas import IOT_PAYLOAD, SENSOR_READINGS

# --- data tests ---------------------------------------------------------------------------------


@query("dq_01_not_null", sql("SELECT * FROM readings WHERE reading_value IS NULL", "readings"))
def not_null(spark: SparkSession, d: str) -> DataFrame:
    return quality.check_not_null(base.staged_readings(spark, d), "reading_value")


@query("dq_02_unique", sql("SELECT order_id, count(*) AS n_records FROM order_lines WHERE order_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1", "order_lines"))
def unique(spark: SparkSession, d: str) -> DataFrame:
    return quality.check_unique(b.order_lines(spark, d), "order_id")


@query("dq_03_accepted_values", sql("""SELECT status AS value_field, count(*) AS n_records FROM readings
 WHERE status NOT IN ('ACTIVE', 'MAINTENANCE') GROUP BY 1""", "readings"))
def accepted(spark: SparkSession, d: str) -> DataFrame:
    return quality.check_accepted(base.staged_readings(spark, d), "status", ["ACTIVE", "MAINTENANCE"])


@query("dq_04_relationships", sql("""SELECT order_id, equipment_id FROM erp_orders WHERE equipment_id IS NOT NULL
 AND equipment_id NOT IN (SELECT equipment_id FROM equipment)""", "erp_orders", "equipment"))
def relationships(spark: SparkSession, d: str) -> DataFrame:
    orders, units = base.staged_orders(spark, d), base.staged_equipment(spark, d)
    return quality.check_relationship(orders, units, "equipment_id", "equipment_id").select("order_id", "equipment_id")


@query("dq_05_between", sql("SELECT * FROM readings WHERE reading_value < 1 OR reading_value > 150", "readings"))
def between(spark: SparkSession, d: str) -> DataFrame:
    return quality.check_between(base.staged_readings(spark, d), "reading_value", 1, 150)


@query("dq_05_one_sided", sql("SELECT kpi_sk, total_readings FROM kpi WHERE total_readings < 2", "kpi"))
def one_sided(spark: SparkSession, d: str) -> DataFrame:
    return quality.check_between(base.stats(spark, d), "total_readings", lo=2).select("kpi_sk", "total_readings")


@query("dq_06_custom_test", sql("""SELECT 'max_below_min' AS test_name, 'warn' AS severity, count(*) FILTER (WHERE max_reading < avg_reading
 OR min_reading > avg_reading) AS failures, CASE WHEN count(*) FILTER (WHERE max_reading < avg_reading OR min_reading > avg_reading) = 0
 THEN 'PASS' ELSE 'WARN' END AS verdict FROM (SELECT max_reading + 1e-9 AS max_reading, min_reading - 1e-9 AS min_reading,
 avg_reading FROM kpi) UNION ALL SELECT 'cancelled_orders', 'error', count(*) FILTER (WHERE status = 'CANCELLED'),
 CASE WHEN count(*) FILTER (WHERE status = 'CANCELLED') = 0 THEN 'PASS' ELSE 'ERROR' END FROM erp_orders""", "kpi", "erp_orders"))
def custom_test(spark: SparkSession, d: str) -> DataFrame:
    one = quality.check_sql(
        base.stats(spark, d), "max_below_min",
        "max_reading + 1e-9 < avg_reading OR min_reading - 1e-9 > avg_reading", "warn",
    )
    return one.unionByName(quality.check_sql(base.staged_orders(spark, d), "cancelled_orders", "status = 'CANCELLED'"))


@query("dq_07_grain", sql("""SELECT order_id, line_number, count(*) AS n_records FROM order_lines GROUP BY 1, 2 HAVING count(*) > 1""", "order_lines"))
def grain(spark: SparkSession, d: str) -> DataFrame:
    return quality.check_grain(b.order_lines(spark, d), ["order_id", "line_number"])


@query("dq_08_suite", sql("""SELECT *, observed >= required AS success FROM (
 SELECT 'column_set' AS expectation, CAST(1 AS DOUBLE) AS observed, CAST(1 AS DOUBLE) AS required
 UNION ALL SELECT 'not_null:sensor_id', count(sensor_id) / count(*), 1 FROM readings
 UNION ALL SELECT 'not_null:reading_timestamp', count(reading_timestamp) / count(*), 1 FROM readings
 UNION ALL SELECT 'between:reading_value', count(*) FILTER (WHERE reading_value BETWEEN -9999 AND 99999) / count(reading_value), 0.95 FROM readings
 UNION ALL SELECT 'in_set:status', count(*) FILTER (WHERE status IN ('ACTIVE', 'INACTIVE', 'MAINTENANCE', 'ERROR')) / count(status), 0.99 FROM readings
 UNION ALL SELECT 'row_count', CASE WHEN count(*) BETWEEN 1 AND 10000000 THEN 1 ELSE 0 END, 1 FROM readings)""", "readings"))
def suite(spark: SparkSession, d: str) -> DataFrame:
    return quality.run_suite(b.sensor_readings(spark, d), quality.SENSOR_SUITE)


@query("dq_08_suite_violated", sql(f"""SELECT expectation, {stable('observed', 6)} AS observed, required, observed >= required AS success FROM (
 SELECT 'not_null:reading_value' AS expectation, count(reading_value) / count(*) AS observed, CAST(1 AS DOUBLE) AS required FROM readings
 UNION ALL SELECT 'between:reading_value', count(*) FILTER (WHERE reading_value BETWEEN 1 AND 150) / count(reading_value), 0.95 FROM readings
 UNION ALL SELECT 'in_set:status', count(*) FILTER (WHERE status IN ('ACTIVE', 'INACTIVE')) / count(status), 0.9 FROM readings)""", "readings"))
def suite_violated(spark: SparkSession, d: str) -> DataFrame:
    rules = [
        quality.Expectation("not_null", "reading_value"),
        quality.Expectation("between", "reading_value", 1, 150, mostly=0.95),
        quality.Expectation("in_set", "status", values=("ACTIVE", "INACTIVE"), mostly=0.9),
    ]
    return rounded(quality.run_suite(b.sensor_readings(spark, d), rules), ["observed"])


_RULES = {
    "has_value": ("drop", "reading_value IS NOT NULL"),
    "in_band": ("warn", "reading_value BETWEEN 1 AND 150"),
    "has_sensor": ("fail", "sensor_id IS NOT NULL"),
}


@query("dq_09_expect_rows", sql("SELECT * FROM readings WHERE reading_value IS NOT NULL", "readings"))
def expect_rows(spark: SparkSession, d: str) -> DataFrame:
    rules = {action: {n: p for n, (a, p) in _RULES.items() if a == action} for action in ("warn", "drop", "fail")}
    return quality.expect(base.staged_readings(spark, d), **rules).rows


@query("dq_09_expect_counts", sql("""SELECT 'has_value' AS expectation, 'drop' AS action,
 count(*) FILTER (WHERE reading_value IS NULL) AS violations, count(reading_value) AS rows_kept FROM readings
 UNION ALL SELECT 'in_band', 'warn', count(*) FILTER (WHERE NOT coalesce(reading_value BETWEEN 1 AND 150, false)), count(*) FROM readings
 UNION ALL SELECT 'has_sensor', 'fail', count(*) FILTER (WHERE sensor_id IS NULL), count(*) FROM readings""", "readings"))
def expect_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.expectation_counts(base.staged_readings(spark, d), _RULES)


_METRICS = """SELECT 'null_rate' AS metric, count(*) FILTER (WHERE reading_value IS NULL) / count(*) AS value FROM silver
 UNION ALL SELECT 'completeness', count(reading_value) / count(*) FROM silver
 UNION ALL SELECT 'quality_score', count(*) FILTER (WHERE quality_flag = 'PASS') / count(*) FROM silver
 UNION ALL SELECT 'duplicate_rate', (count(*) - count(DISTINCT (sensor_id, reading_timestamp))) / count(*) FROM silver
 UNION ALL SELECT 'schema_match', 1"""
_GOLD_METRICS = """SELECT 'stability_stddev' AS metric, max(stddev_reading) AS value FROM latest
 UNION ALL SELECT 'signal_cv', max(coefficient_of_variation) FROM latest
 UNION ALL SELECT 'alert_severity_critical', CAST(count(*) FILTER (WHERE alert_severity = 'CRITICAL') AS DOUBLE) FROM latest"""
_LATEST = "(SELECT * FROM alerts WHERE kpi_date = (SELECT max(kpi_date) FROM alerts)) AS latest"


def _sensor_metrics(spark: SparkSession, d: str) -> DataFrame:
    df = base.silver_readings(spark, d).withColumn("_loaded_at", F.col("loaded_at"))
    return quality.quality_metrics(
        df, ["sensor_id", "reading_timestamp", "reading_value"], ["sensor_id", "reading_timestamp"],
        SENSOR_READINGS, "quality_flag",
    )


@query("dq_10_threshold_gate", sql(f"""SELECT gate_name, m.metric, {stable('value', 6)} AS value, threshold_min, threshold_max, severity,
 CASE WHEN value BETWEEN threshold_min AND threshold_max THEN 'PASS' ELSE severity END AS verdict FROM (
 {_METRICS} UNION ALL ({_GOLD_METRICS.replace("FROM latest", "FROM " + _LATEST)})) m JOIN (VALUES
 ('bronze_gate', 'null_rate', 0.0::DOUBLE, 0.05::DOUBLE, 'FAIL'), ('bronze_gate', 'schema_match', 1.0, 1.0, 'FAIL'),
 ('silver_gate', 'quality_score', 0.95, 1.0, 'WARN'), ('silver_gate', 'duplicate_rate', 0, 0.01, 'FAIL'),
 ('gold_gate', 'stability_stddev', 0, 25, 'WARN'), ('gold_gate', 'signal_cv', 0, 0.3, 'WARN'),
 ('gold_gate', 'alert_severity_critical', 0, 0, 'BLOCK'), ('gold_gate', 'completeness', 0.99, 1.0, 'WARN'))
 t(gate_name, metric, threshold_min, threshold_max, severity) ON m.metric = t.metric""", "silver", "alerts"))
def threshold_gate(spark: SparkSession, d: str) -> DataFrame:
    metrics = _sensor_metrics(spark, d).unionByName(quality.gold_metrics(base.alerts(spark, d)))
    return rounded(quality.evaluate_gate(metrics, quality.thresholds(spark)), ["value"])


@query("dq_11_gate_decisions", sql(f"""SELECT gate, {stable('measure', 6)} AS measure, CASE WHEN measure <= lim THEN 'PASS' ELSE 'FAIL' END AS decision FROM (
 SELECT 'bronze' AS gate, CAST(count(*) FILTER (WHERE reading_value IS NULL) AS DOUBLE) AS measure, 0 AS lim FROM readings
 UNION ALL SELECT 'silver', count(*) FILTER (WHERE quality_flag = 'FAIL') * 100.0 / count(*), 20 FROM silver
 UNION ALL SELECT 'gold', count(*) FILTER (WHERE alert_severity = 'CRITICAL'), 0 FROM alerts
  WHERE kpi_date = (SELECT max(kpi_date) FROM alerts))""", "readings", "silver", "alerts"))
def gate_decisions(spark: SparkSession, d: str) -> DataFrame:
    out = quality.gate_decisions(base.staged_readings(spark, d), base.silver_readings(spark, d), base.alerts(spark, d))
    return rounded(out, ["measure"])


def _lines_split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lines, their deduplicated good rows, and quarantined rows (of several copies the latest decides)."""
    lines = b.order_lines(spark, d)
    order = [F.col("loaded_at").desc(), *[F.col(c).asc() for c in ("material_id", "vendor_id", "net_value", "order_quantity")]]
    one = dedup_latest(lines, ["order_id", "line_number"], order)
    flagged = one.withColumn("quality_flag", F.when(F.col("net_value") > 90000, "FAIL").otherwise("PASS"))
    good, bad = merge.split_by_flag(flagged, {"value too high": F.col("net_value") > 90000})
    return lines, good, bad


_LINES_ONE = """(SELECT *, CASE WHEN net_value > 90000 THEN 'FAIL' ELSE 'PASS' END AS quality_flag FROM order_lines
 QUALIFY row_number() OVER (PARTITION BY order_id, line_number ORDER BY loaded_at DESC, material_id, vendor_id, net_value, order_quantity) = 1)"""


@query("dq_12_reconcile", sql(f"""SELECT *, source_rows = bronze_rows AS source_matches,
 bronze_rows = silver_rows + quarantined_rows + duplicate_rows AS rows_explained,
 CASE WHEN source_rows = bronze_rows AND bronze_rows = silver_rows + quarantined_rows + duplicate_rows THEN 'PASS' ELSE 'FAIL' END AS verdict
 FROM (SELECT (SELECT count(*) FROM lineitem) AS source_rows, (SELECT count(*) FROM order_lines) AS bronze_rows,
 (SELECT count(*) FROM {_LINES_ONE} WHERE quality_flag = 'PASS') AS silver_rows,
 (SELECT count(*) FROM {_LINES_ONE} WHERE quality_flag = 'FAIL') AS quarantined_rows,
 (SELECT count(*) - count(DISTINCT (order_id, line_number)) FROM order_lines) AS duplicate_rows)""", "order_lines"))
def reconcile(spark: SparkSession, d: str) -> DataFrame:
    lines, good, bad = _lines_split(spark, d)
    return quality.reconcile(b.table(spark, d, "lineitem"), lines, good, bad, ["order_id", "line_number"])


@query("join_10_scalar_counts", sql("""SELECT (SELECT count(*) FROM events) AS source_rows, (SELECT count(*) FROM silver) AS silver_rows,
 (SELECT count(*) FROM kpi) AS kpi_rows""", "silver", "kpi"))
def scalar_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.side_by_side(
        source_rows=b.table(spark, d, "events"), silver_rows=base.silver_readings(spark, d), kpi_rows=base.stats(spark, d)
    )


@query("dq_13_quarantined", sql("""SELECT sensor_reading_sk, quality_flag, CASE WHEN reading_value IS NULL THEN 'missing value'
 ELSE 'other' END AS quarantine_reason FROM silver WHERE quality_flag = 'FAIL'""", "silver"))
def quarantined(spark: SparkSession, d: str) -> DataFrame:
    _, bad = merge.split_by_flag(base.silver_readings(spark, d), {"missing value": F.col("reading_value").isNull()})
    return bad.select("sensor_reading_sk", "quality_flag", "quarantine_reason")


@query("dq_13_promoted", sql("SELECT sensor_reading_sk, quality_flag FROM silver WHERE quality_flag <> 'FAIL'", "silver"))
def promoted(spark: SparkSession, d: str) -> DataFrame:
    good, _ = merge.split_by_flag(base.silver_readings(spark, d), {"missing value": F.col("reading_value").isNull()})
    return good.select("sensor_reading_sk", "quality_flag")


@query("dq_14_freshness", sql("""SELECT max(loaded_at) AS max_loaded_at, CASE WHEN max(loaded_at) < TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 48 HOUR
 THEN 'error' WHEN max(loaded_at) < TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 24 HOUR THEN 'warn' ELSE 'pass' END AS freshness FROM readings""", "readings"))
def freshness(spark: SparkSession, d: str) -> DataFrame:
    return quality.freshness(base.staged_readings(spark, d), "loaded_at", b.AS_OF)


@query("dq_15_quality_metrics", sql(f"SELECT metric, {stable('value', 6)} AS value FROM ({_METRICS})", "silver"))
def quality_metrics(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_sensor_metrics(spark, d), ["value"])


_MERGED = """(SELECT count(*) FROM keyed WHERE reading_timestamp < TIMESTAMP '2024-01-20 00:00:00')
 + (SELECT count(*) FROM (SELECT DISTINCT k, reading_timestamp FROM keyed WHERE reading_timestamp >= TIMESTAMP '2024-01-20 00:00:00'))"""


@query("dq_17_idempotent", sql(f"""SELECT {_MERGED} AS once_rows, {_MERGED} AS twice_rows, CAST(0 AS BIGINT) AS differing_rows
 FROM (SELECT 1)""".replace("keyed", """(SELECT CASE WHEN CAST(sensor_id AS INTEGER) % 10 <> 0 THEN sensor_id END AS k,
 reading_timestamp FROM readings)"""), "readings"))
def idempotent(spark: SparkSession, d: str) -> DataFrame:
    """Merging the same batch, with NULL and repeated keys, once and twice gives the same table."""
    keys = ["sensor_id", "reading_timestamp"]
    known = F.when(F.col("sensor_id").cast("int") % 10 != 0, F.col("sensor_id"))
    readings = base.staged_readings(spark, d).withColumn("sensor_id", known)
    start = readings.filter(F.col("reading_timestamp") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    once = merge.merge_insert_new(start, readings, keys)
    twice = merge.merge_insert_new(once, readings, keys)
    n = F.count(F.lit(1))
    differing = quality.same_content(once, twice).agg(n).scalar()
    return once.agg(n.alias("once_rows")).select("once_rows", twice.agg(n).scalar().alias("twice_rows"), differing.alias("differing_rows"))


@query("dq_18_late_rows", sql("""SELECT sensor_id, reading_timestamp FROM readings
 WHERE reading_timestamp < (SELECT max(reading_timestamp) - INTERVAL 72 HOUR FROM readings)""", "readings"))
def late(spark: SparkSession, d: str) -> DataFrame:
    return late_rows(base.staged_readings(spark, d), "reading_timestamp", "72 HOURS").select("sensor_id", "reading_timestamp")


# --- payloads -----------------------------------------------------------------------------------------


@query("sem_01_json_paths", sql("""SELECT event_id, sensor_id, status, value AS first_reading, location,
 '["' || upper(event_type) || '","K' || (k % 3) || '"]' AS tags FROM iot""", "iot"))
def json_paths(spark: SparkSession, d: str) -> DataFrame:
    return semi.json_paths(b.iot_events(spark, d))


@query("sem_02_flatten_array", sql("""SELECT event_id, event_timestamp, sensor_id, CAST(0 AS INTEGER) AS reading_index,
 value AS reading_value, 'C' AS unit, quality FROM iot UNION ALL SELECT event_id, event_timestamp, sensor_id, 1,
 CAST(k AS DOUBLE), 'bar', NULL FROM iot""", "iot"))
def flatten_array(spark: SparkSession, d: str) -> DataFrame:
    return semi.flatten_array(b.iot_events(spark, d))


@query("sem_03_flatten_object", sql("""SELECT event_id, 'location' AS attribute_name, location AS attribute_value FROM iot
 UNION ALL SELECT event_id, 'rig', rig FROM iot""", "iot"))
def flatten_object(spark: SparkSession, d: str) -> DataFrame:
    return semi.flatten_object(b.iot_events(spark, d), "$.metadata")


@query("sem_04_construct", sql("""SELECT event_id, '{"sensor_id":"' || sensor_id || '","location":"' || location || '"}' AS object,
 'PASS,WARN,FAIL' AS flags, sensor_id AS parsed_sensor FROM iot""", "iot"))
def construct(spark: SparkSession, d: str) -> DataFrame:
    v = F.parse_json("raw_payload")
    fields = [F.variant_get(v, f"$.{p}", "string").alias(n) for n, p in (("sensor_id", "sensor_id"), ("location", "metadata.location"))]
    return b.iot_events(spark, d).select(
        "event_id",
        semi.object_construct(*fields).alias("object"),
        F.array_join(semi.array_construct("PASS", "WARN", "FAIL"), ",").alias("flags"),
        F.variant_get(v, "$.sensor_id", "string").alias("parsed_sensor"),
    )


@query("sem_05_array_checks", sql("SELECT event_id, CAST(2 AS INTEGER) AS num_readings, event_type = 'error' AS has_tag FROM iot", "iot"))
def array_checks(spark: SparkSession, d: str) -> DataFrame:
    return semi.array_checks(b.iot_events(spark, d), "ERROR")


@query("sem_06_json_types", sql("""SELECT event_id, 'OBJECT' AS payload_type, 'ARRAY' AS readings_type, 'INTEGER' AS value_type,
 k % 10 = 0 AS note_is_json_null, k % 10 <> 0 AS note_is_missing FROM iot""", "iot"))
def json_types(spark: SparkSession, d: str) -> DataFrame:
    out = semi.json_types(b.iot_events(spark, d))
    return out.withColumn("note_is_json_null", F.coalesce("note_is_json_null", F.lit(False)))


@query("sem_07_normalise_json", sql("""SELECT event_id, sensor_id, status, value AS first_value, location, rig FROM iot""", "iot"))
def normalise(spark: SparkSession, d: str) -> DataFrame:
    out = semi.normalise_json(b.iot_events(spark, d), IOT_PAYLOAD, ["event_id"])
    return out.select(
        "event_id", "sensor_id", "status", F.col("readings")[0]["value"].alias("first_value"),
        "metadata.location", "metadata.rig",
    )


@query("sem_08_struct", sql("SELECT sensor_id AS info_id, sensor_name AS info_name, equipment_name AS info_unit, reading_timestamp FROM readings", "readings"))
def struct(spark: SparkSession, d: str) -> DataFrame:
    info = semi.sensor_info(base.staged_readings(spark, d))
    return info.select(
        F.col("sensor_info.sensor_id").alias("info_id"), F.col("sensor_info.sensor_name").alias("info_name"),
        F.col("sensor_info.equipment_name").alias("info_unit"), "reading_timestamp",
    )


def _lists(spark: SparkSession, d: str) -> DataFrame:
    df = gold.reading_lists(base.staged_readings(spark, d), ["sensor_id"], "reading_timestamp")
    return df.select("sensor_id", "slot_start", "all_readings")


def _joined(column: str):
    return F.array_join(F.transform(column, lambda v: v.cast("decimal(10,1)").cast("string")), ",").alias(column)


@query("sem_09_explode", sql("""SELECT sensor_id, slot_start, CAST(unnest(generate_series(0, len(vals) - 1)) AS INTEGER) AS position,
 unnest(vals) AS single_reading FROM lists WHERE len(vals) > 0""", "lists"))
def explode(spark: SparkSession, d: str) -> DataFrame:
    return semi.explode_readings(_lists(spark, d), ["sensor_id", "slot_start"])


@query("sem_10_transform", sql("""SELECT sensor_id, slot_start,
 array_to_string(list_transform(coalesce(vals, []), lambda x: CAST(CAST(round(x) AS DECIMAL(10, 1)) AS VARCHAR)), ',') AS rounded_readings FROM lists""", "lists"))
def transform(spark: SparkSession, d: str) -> DataFrame:
    return semi.hof_transform(_lists(spark, d), 0).select("sensor_id", "slot_start", _joined("rounded_readings"))


@query("sem_11_filter", sql("""SELECT sensor_id, slot_start, CAST(coalesce(len(list_filter(vals, lambda x: x > 50)), 0) AS INTEGER) AS n_high,
 list_max(list_filter(vals, lambda x: x > 50)) AS highest FROM lists""", "lists"))
def hof_filter(spark: SparkSession, d: str) -> DataFrame:
    out = semi.hof_filter(_lists(spark, d), 50)
    return out.select(
        "sensor_id", "slot_start", F.size("high_readings").alias("n_high"), F.array_max("high_readings").alias("highest")
    )


@query("sem_12_reduce", sql(f"""SELECT sensor_id, slot_start, {stable('coalesce(list_sum(vals), 0)', 6)} AS total_reading FROM lists""", "lists"))
def hof_reduce(spark: SparkSession, d: str) -> DataFrame:
    out = semi.hof_reduce(_lists(spark, d)).select("sensor_id", "slot_start", "total_reading")
    return rounded(out, ["total_reading"])


@query("sem_13_exists", sql("SELECT sensor_id, slot_start, coalesce(list_max(vals) > 100, false) AS has_high_reading FROM lists", "lists"))
def hof_exists(spark: SparkSession, d: str) -> DataFrame:
    return semi.hof_exists(_lists(spark, d), 100).drop("all_readings")


@query("sem_14_array_distinct", sql("""SELECT event_id, 'C,' || CASE WHEN upper(event_type) < 'K' THEN upper(event_type) || ',K' || (k % 3)
 ELSE 'K' || (k % 3) || ',' || upper(event_type) END || ',bar' AS distinct_values, CAST(4 AS INTEGER) AS n_values FROM iot""", "iot"))
def array_distinct(spark: SparkSession, d: str) -> DataFrame:
    return semi.distinct_statuses(b.iot_events(spark, d))


# --- named functions -----------------------------------------------------------------------------------


@query("agg_10_summary_json", sql(f"""SELECT sensor_id, {stable('avg(reading_value)', 6)} AS mean, count(*) AS n
 FROM readings GROUP BY 1""", "readings"))
def summary_json(spark: SparkSession, d: str) -> DataFrame:
    """The object is read back, as the text of doubles differs between engines."""
    out = gold.summary_json(base.staged_readings(spark, d), "sensor_id", "reading_value")
    mean = F.get_json_object("summary_json", "$.avg_reading").cast("double")
    return out.select(
        F.get_json_object("summary_json", "$.sensor_id").alias("sensor_id"),
        business.stable_round(mean, 6).alias("mean"),
        F.get_json_object("summary_json", "$.count").cast("bigint").alias("n"),
    )


_SCORES = """SELECT sensor_id, count(*) FILTER (WHERE quality_flag = 'PASS') AS passed, count(*) AS total FROM silver GROUP BY 1"""


@query("udf_01_quality_score", sql(f"""SELECT sensor_id, CASE WHEN total = 0 THEN 0
 ELSE {stable('CAST(passed AS DOUBLE) / total * 100', 2)} END AS score FROM ({_SCORES})""", "silver"))
def quality_score(spark: SparkSession, d: str) -> DataFrame:
    counts = gold.conditional_counts(base.silver_readings(spark, d), ["sensor_id"])
    return counts.select("sensor_id", business.quality_score("pass_count", "total_count").alias("score"))


@query("udf_01_quality_score_sql", sql(f"""SELECT sensor_id, CASE WHEN total = 0 THEN 0
 ELSE {stable('CAST(passed AS DOUBLE) / total * 100', 2)} END AS score FROM ({_SCORES})""", "silver"))
def quality_score_sql(spark: SparkSession, d: str) -> DataFrame:
    business.register(spark)
    counts = gold.conditional_counts(base.silver_readings(spark, d), ["sensor_id"])
    return counts.select("sensor_id", F.expr("quality_score(pass_count, total_count)").alias("score"))


@query("udf_02_parse_status", sql("""SELECT event_id, CASE WHEN raw IS NULL OR raw = '' THEN 'UNKNOWN' ELSE
 CASE trim(upper(raw)) WHEN 'A' THEN 'ACTIVE' WHEN 'I' THEN 'INACTIVE' WHEN 'M' THEN 'MAINTENANCE' WHEN 'E' THEN 'ERROR'
 ELSE trim(upper(raw)) END END AS state FROM (SELECT event_id, CASE k % 5 WHEN 0 THEN '' WHEN 1 THEN ' ' || lower(substr(status, 1, 1))
 WHEN 2 THEN NULL WHEN 3 THEN event_type ELSE substr(status, 1, 1) END AS raw FROM iot)""", "iot"))
def parse_status(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int") % 5
    letter = F.substring(label_lookup(F.col("event_type"), b.STATUS_OF_EVENT), 1, 1)
    raw = (
        F.when(k == 0, "").when(k == 1, F.concat(F.lit(" "), F.lower(letter))).when(k == 2, F.lit(None))
        .when(k == 3, F.col("event_type")).otherwise(letter)
    )
    df = b.table(spark, d, "events").select(F.col("event_id").cast("string").alias("event_id"), raw.alias("raw"))
    return df.select("event_id", business.parse_status("raw").alias("state"))


@query("udf_03_anomaly_score_sql", sql(f"""SELECT r.sensor_id, r.reading_timestamp, CASE WHEN stddev_reading IS NULL OR stddev_reading = 0
 THEN 0 ELSE {stable('abs((reading_value - avg_reading) / stddev_reading)', 4)} END AS score
 FROM silver r JOIN kpi k ON r.sensor_id = k.sensor_id AND CAST(r.reading_timestamp AS DATE) = k.kpi_date""", "silver", "kpi"))
def anomaly_score_sql(spark: SparkSession, d: str) -> DataFrame:
    business.register(spark)
    dated = base.silver_readings(spark, d).withColumn("kpi_date", F.to_date("reading_timestamp"))
    stats = base.stats(spark, d).select("sensor_id", "kpi_date", "avg_reading", "stddev_reading")
    return dated.join(stats, ["sensor_id", "kpi_date"]).select(
        "sensor_id", "reading_timestamp",
        F.expr("anomaly_score(reading_value, avg_reading, stddev_reading)").alias("score"),
    )


@query("udf_04_date_range", sql("""SELECT sensor_id, CAST(unnest(generate_series(min(CAST(reading_timestamp AS DATE)),
 max(CAST(reading_timestamp AS DATE)), INTERVAL 1 DAY)) AS DATE) AS dt FROM readings GROUP BY 1""", "readings"))
def date_range(spark: SparkSession, d: str) -> DataFrame:
    """Every day between the first and the last reading of each sensor, by the table function."""
    business.register(spark)
    day = F.to_date("reading_timestamp")
    spans = base.staged_readings(spark, d).groupBy("sensor_id").agg(F.min(day).alias("a"), F.max(day).alias("z"))
    return spark.sql("SELECT s.sensor_id, r.dt FROM {spans} s, LATERAL generate_date_range(s.a, s.z) r", spans=spans)


@query("udf_05_revenue_tier", sql("""SELECT revenue_sk, CASE WHEN total_revenue >= 1000000 THEN 'PLATINUM' WHEN total_revenue >= 500000
 THEN 'GOLD' WHEN total_revenue >= 100000 THEN 'SILVER' ELSE 'BRONZE' END AS tier FROM revenue""", "revenue"))
def revenue_tier(spark: SparkSession, d: str) -> DataFrame:
    return base.revenue(spark, d).select("revenue_sk", business.revenue_tier("total_revenue").alias("tier"))


# --- access rules and run logs ---------------------------------------------------------------------------


@query("gov_01_mask_email", """SELECT c_custkey, email AS for_engineer, regexp_replace(email, '.+@', '****@') AS for_analyst,
 '**REDACTED**' AS for_viewer FROM (SELECT c_custkey, lower(c_name) || '@plant.example' AS email FROM customer)""")
def mask_email(spark: SparkSession, d: str) -> DataFrame:
    email = F.concat(F.lower("c_name"), F.lit("@plant.example"))
    roles = {"for_engineer": "ENGINEER", "for_analyst": "ANALYST", "for_viewer": "VIEWER"}
    df = b.table(spark, d, "customer").select("c_custkey", email.alias("email"))
    return df.select("c_custkey", *[masking.mask_email("email", role).alias(n) for n, role in roles.items()])


@query("gov_02_row_filter", sql("""SELECT 'ADMIN' AS role, equipment_id FROM equipment
 UNION ALL SELECT 'ANALYST', equipment_id FROM equipment WHERE manufacturer = 'ASIA'""", "equipment"))
def row_filter(spark: SparkSession, d: str) -> DataFrame:
    units = base.staged_equipment(spark, d)
    parts = [
        masking.row_filter(units, "manufacturer", role, "ASIA").select(F.lit(role).alias("role"), "equipment_id")
        for role in ("ADMIN", "ANALYST", "VIEWER")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("gov_03_partner_kpi", sql(f"""SELECT kpi_date, sensor_name, total_readings, {rounds(['avg_reading', 'p95_reading'])} FROM kpi
 WHERE kpi_date >= DATE '2024-04-10' - INTERVAL 90 DAY""", "kpi"))
def partner_kpi(spark: SparkSession, d: str) -> DataFrame:
    return rounded(operations.partner_kpi(base.kpi(spark, d), "2024-04-10"), ["avg_reading", "p95_reading"])


@query("ops_01_audit_row", sql("""SELECT CAST(1 AS BIGINT) AS log_id, 'MERGE_SENSOR_KPI' AS procedure_name, 'SUCCESS' AS status,
 count(*) AS row_count, TIMESTAMP '2024-02-01 00:00:00' AS executed_at, CAST(NULL AS VARCHAR) AS error_message FROM kpi""", "kpi"))
def audit_row(spark: SparkSession, d: str) -> DataFrame:
    return operations.audit_row(base.stats(spark, d), "MERGE_SENSOR_KPI", "SUCCESS", b.AS_OF, log_id=1)


@query("ops_02_run_alerts", sql("""SELECT procedure_name, status, error_message, executed_at, minutes_since_last_run,
 CASE WHEN status = 'FAILURE' THEN 'CRITICAL' WHEN date_diff('hour', executed_at, TIMESTAMP '2024-02-01 00:00:00') > 24 THEN 'WARNING'
 ELSE 'OK' END AS alert_level FROM (SELECT *, date_diff('minute', lag(executed_at) OVER w, executed_at) AS minutes_since_last_run
 FROM run_log WINDOW w AS (PARTITION BY procedure_name ORDER BY executed_at))
 QUALIFY row_number() OVER (PARTITION BY procedure_name ORDER BY executed_at DESC) = 1""", "run_log"))
def run_alerts(spark: SparkSession, d: str) -> DataFrame:
    return operations.run_alerts(b.run_log(spark, d), b.AS_OF)



@query("ops_03_health_checks", sql(f"""SELECT 'BACKUP_EXISTS' AS check_name, CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'WARN' END AS status,
 'backups found: ' || count(*) AS details FROM events WHERE event_type = 'signup'
 UNION ALL SELECT 'AUDIT_LOG_RECENT', CASE WHEN max(executed_at) > TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 24 HOUR THEN 'PASS'
 ELSE 'WARN' END, 'last audit entry: ' || coalesce(strftime(max(executed_at), '%Y-%m-%d %H:%M:%S'), 'NONE') FROM run_log""", "run_log"))
def health_checks(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "signup", "BACKUP").otherwise("WRITE")
    history = b.table(spark, d, "events").select(kind.alias("operation"))
    return operations.health_checks(history, b.run_log(spark, d), b.AS_OF)


def _runs(spark: SparkSession, d: str) -> DataFrame:
    return operations.run_scorecard(operations.daily_runs(base.silver_readings(spark, d), base.alerts(spark, d)))


@query("ops_04_run_scorecard", sql("SELECT * FROM scorecard", "scorecard"))
def run_scorecard(spark: SparkSession, d: str) -> DataFrame:
    return _runs(spark, d)


@query("ops_05_volume_check", """SELECT load_date, n_rows, CASE WHEN n_rows < 300 THEN 'ALARM' WHEN n_rows BETWEEN 320 AND 345 THEN 'HEALTHY'
 ELSE 'WATCH' END AS volume_status FROM (SELECT CAST(ts AS DATE) AS load_date, count(*) AS n_rows FROM events GROUP BY 1)""")
def volume_check(spark: SparkSession, d: str) -> DataFrame:
    return gold.volume_check(b.table(spark, d, "events"), "ts", alarm_below=300, lo=320, hi=345)


_RATES = ["bronze_pass_rate", "silver_pass_rate", "gold_pass_rate", "success_rate", "avg_duration_min"]


@query("agg_12_scorecard", sql(f"""SELECT total_records, total_quarantined, {rounds(_RATES, 4)} FROM (SELECT
 avg(CAST(bronze_gate = 'PASS' AS INTEGER)) * 100 AS bronze_pass_rate, avg(CAST(silver_gate = 'PASS' AS INTEGER)) * 100 AS silver_pass_rate,
 avg(CAST(gold_gate = 'PASS' AS INTEGER)) * 100 AS gold_pass_rate, avg(CAST(status = 'SUCCESS' AS INTEGER)) * 100 AS success_rate,
 avg(duration_min) AS avg_duration_min, CAST(sum(records_processed) AS BIGINT) AS total_records,
 CAST(sum(quarantined) AS BIGINT) AS total_quarantined FROM scorecard)""", "scorecard"))
def scorecard(spark: SparkSession, d: str) -> DataFrame:
    return rounded(gold.runs_scorecard(_runs(spark, d)), _RATES, 4)


@query("set_01_union_checks", sql("""SELECT 'sensor_id' AS checked, count(*) FILTER (WHERE sensor_id IS NULL) AS failures FROM readings
 UNION ALL SELECT 'reading_value', count(*) FILTER (WHERE reading_value IS NULL) FROM readings
 UNION ALL SELECT 'status', count(*) FILTER (WHERE status IS NULL) FROM readings""", "readings"))
def union_checks(spark: SparkSession, d: str) -> DataFrame:
    readings = base.staged_readings(spark, d)
    parts = [
        quality.check_sql(readings, c, f"{c} IS NULL").select(F.col("test_name").alias("checked"), "failures")
        for c in ("sensor_id", "reading_value", "status")
    ]
    return operations.union_checks(*parts)
