"""Queries on orders, equipment, materials and vendors: joins, revenue, history, merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierworks import bindings as b
from tierworks.functions import flags
from tierworks.functions.business import stable_round
from tierworks.operators import changes, gold, joins, merge, scd, silver, summaries
from tierworks.operators.sequences import first_rows
from tierworks.operators.skew import same_keys
from tierworks.plans import base
from tierworks.plans.base import VENDOR_TRACKED
from tierworks.plans.oracle import key, row_hash, rounds, sql, stable
from tierworks.plans.registry import query, rounded
from tierworks.schemas import MATERIALS, ORDERS
from tierworks.session import work_dir
from tierworks.sources import ingest, sinks, staging

_T = "TIMESTAMP"


# --- staging, column alignment ---------------------------------------------------------------


@query("src_08_evolve_union", sql("""SELECT material_id, material_type, CAST(NULL AS VARCHAR) AS plant_code FROM materials
 UNION ALL SELECT material_id, material_type, plant_code FROM materials""", "materials"))
def evolve(spark: SparkSession, d: str) -> DataFrame:
    staged = staging.stage_materials(b.materials(spark, d))
    return ingest.evolve_union(
        staged.select("material_id", "material_type"), staged.select("material_id", "material_type", "plant_code")
    )


@query("src_09_rescue", sql("""SELECT material_id, unit_of_measure, CASE WHEN plant_code = 'PLT-3'
 THEN '{"plant_code":"PLT-3","material_name":"' || material_name || '"}'
 ELSE '{"material_name":"' || material_name || '"}' END AS _rescued_data,
 CASE WHEN plant_code <> 'PLT-3' THEN CAST(substr(plant_code, 5) AS INTEGER) END AS plant_code FROM materials""", "materials"))
def rescue(spark: SparkSession, d: str) -> DataFrame:
    plant = F.col("plant_code")
    raw = b.materials(spark, d).select(
        "material_id", "material_name", "unit_of_measure",
        F.when(plant == "PLT-3", plant).otherwise(F.substring(plant, 5, 10)).alias("plant_code"),
    )
    schema = T.StructType.fromDDL("material_id string, unit_of_measure string, plant_code int")
    return ingest.rescue_columns(raw, schema)


@query("src_10_ingest_meta", f"""SELECT event_id, {_T} '2024-02-01 00:00:00' AS _loaded_at, 'events.parquet' AS _source_file,
 'batch-1' AS _batch_id, 'IOT' AS _source_system FROM events""")
def ingest_meta(spark: SparkSession, d: str) -> DataFrame:
    scan = b.table(spark, d, "events")
    return ingest.with_ingest_meta(scan, b.AS_OF, "batch-1", "IOT").select(
        "event_id", "_loaded_at", "_source_file", "_batch_id", "_source_system"
    )


@query("src_11_match_by_name", sql("""SELECT material_id, material_name, material_type, CAST(NULL AS VARCHAR) AS unit_of_measure,
 plant_code, loaded_at AS _loaded_at FROM materials""", "materials"))
def match_by_name(spark: SparkSession, d: str) -> DataFrame:
    raw = b.materials(spark, d).drop("unit_of_measure")
    shouting = raw.select(*[F.col(c).alias(c.upper()) for c in raw.columns], F.lit(1).alias("EXTRA"))
    return ingest.match_by_name(shouting, MATERIALS)


@query("src_12_stage_orders", sql("SELECT * FROM erp_orders", "erp_orders"))
def stage_orders(spark: SparkSession, d: str) -> DataFrame:
    return base.staged_orders(spark, d)


@query("src_12_stage_materials", sql("SELECT * FROM materials", "materials"))
def stage_materials(spark: SparkSession, d: str) -> DataFrame:
    return staging.stage_materials(b.materials(spark, d))


@query("src_12_stage_vendors", sql("SELECT vendor_number AS vendor_id, * FROM vendors1", "vendors1"))
def stage_vendors(spark: SparkSession, d: str) -> DataFrame:
    return base.staged_vendors(spark, d)


@query("src_12_stage_equipment", sql("SELECT * FROM equipment", "equipment"))
def stage_equipment(spark: SparkSession, d: str) -> DataFrame:
    return base.staged_equipment(spark, d)


# --- projections ------------------------------------------------------------------------------


@query("prj_01_enforce_types", sql("""SELECT order_id, order_type, equipment_id, material_id, order_date, order_quantity,
 net_value, status, priority, created_by, loaded_at AS _loaded_at FROM erp_orders""", "erp_orders"))
def enforce_types(spark: SparkSession, d: str) -> DataFrame:
    raw = b.raw_orders(spark, d)
    as_text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    return silver.enforce_types(as_text, ORDERS)


@query("prj_02_safe_cast", sql("""SELECT event_id, CASE WHEN k % 20 = 0 THEN NULL ELSE value END AS reading_value,
 CASE WHEN k % 20 = 0 THEN 'FAIL' ELSE 'PASS' END AS cast_flag FROM iot""", "iot"))
def safe_cast(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    text = F.when(k % 20 == 0, F.lit("INVALID_READING")).otherwise(F.col("value").cast("string"))
    raw = b.table(spark, d, "events").select(F.col("event_id").cast("string").alias("event_id"), text.alias("raw_value"))
    return silver.safe_cast(raw, "raw_value", "double", "reading_value").drop("raw_value")


@query("prj_10_orders_flag", sql("SELECT order_id, quality_flag FROM validated", "validated"))
def orders_flag(spark: SparkSession, d: str) -> DataFrame:
    return base.validated_orders(spark, d).select("order_id", "quality_flag")


@query("prj_11_quantity_flag", sql("""SELECT order_id, CASE WHEN order_quantity <= 0 THEN 'FAIL' WHEN net_value IS NULL
 THEN 'WARN' ELSE 'PASS' END AS quantity_flag FROM (SELECT order_id, order_quantity - 40 AS order_quantity,
 CASE WHEN status <> 'RELEASED' THEN net_value END AS net_value FROM erp_orders)""", "erp_orders"))
def quantity_flag(spark: SparkSession, d: str) -> DataFrame:
    orders = base.staged_orders(spark, d).select(
        "order_id",
        (F.col("order_quantity") - 40).alias("order_quantity"),
        F.when(F.col("status") != "RELEASED", F.col("net_value")).alias("net_value"),
    )
    return orders.select("order_id", flags.quantity_flag().alias("quantity_flag"))


@query("prj_12_lifecycle", sql("SELECT equipment_id, lifecycle_stage FROM dim_equipment", "dim_equipment"))
def lifecycle(spark: SparkSession, d: str) -> DataFrame:
    return base.dim_equipment(spark, d).select("equipment_id", "lifecycle_stage")


@query("prj_12_lifecycle_status_first", sql("""SELECT equipment_id, CASE WHEN status = 'DECOMMISSIONED' THEN 'RETIRED'
 WHEN date_diff('year', install_date, DATE '2024-02-01') > 10 THEN 'AGING' ELSE 'ACTIVE' END AS lifecycle_stage
 FROM equipment""", "equipment"))
def lifecycle_status_first(spark: SparkSession, d: str) -> DataFrame:
    out = silver.equipment_enriched(base.staged_equipment(spark, d), b.AS_OF, status_first=True)
    return out.select("equipment_id", "lifecycle_stage")


@query("prj_15_order_line_items", sql(f"""SELECT order_id, material_id, order_quantity, net_value,
 {stable('net_value / nullif(order_quantity, 0)', 2)} AS unit_price, CASE WHEN net_value > 10000 THEN 'HIGH_VALUE'
 WHEN net_value > 1000 THEN 'MEDIUM_VALUE' ELSE 'LOW_VALUE' END AS order_tier FROM erp_orders WHERE order_quantity > 0""", "erp_orders"))
def line_items(spark: SparkSession, d: str) -> DataFrame:
    return silver.order_line_items(base.staged_orders(spark, d))


@query("flt_05_multi_version_keys", sql("""SELECT vendor_number, version_sk, valid_from,
 valid_from = max(valid_from) OVER (PARTITION BY vendor_number) AS is_latest FROM history2
 WHERE vendor_number IN (SELECT vendor_number FROM history2 GROUP BY 1 HAVING count(*) > 1)""", "history2"))
def multi_version(spark: SparkSession, d: str) -> DataFrame:
    df = base.vendor_history2(spark, d).select("vendor_number", "version_sk", "valid_from")
    return silver.multi_version_keys(df, "vendor_number", "valid_from")


# --- joins --------------------------------------------------------------------------------------


@query("join_01_validated_orders", sql("SELECT * FROM validated", "validated"))
def validated(spark: SparkSession, d: str) -> DataFrame:
    return base.validated_orders(spark, d)


@query("join_02_enrich_and_check", sql("""SELECT event_id, equipment_name, equipment_type, pressure, max_pressure,
 CASE WHEN pressure > max_pressure THEN 'CRITICAL' ELSE 'OK' END AS pressure_status
 FROM (SELECT event_id, rig AS equipment_name, value AS pressure FROM iot) JOIN
 (SELECT equipment_name, equipment_type, CAST(20 + CAST(equipment_id AS BIGINT) % 80 AS DOUBLE) AS max_pressure
 FROM equipment) USING (equipment_name)""", "iot", "equipment"))
def enrich_and_check(spark: SparkSession, d: str) -> DataFrame:
    signal = b.table(spark, d, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(F.lit("EQ-"), (F.col("user_id") % 20).cast("string")).alias("equipment_name"),
        F.col("value").alias("pressure"),
    )
    limit = (F.lit(20) + F.col("equipment_id").cast("bigint") % 80).cast("double")
    master = base.staged_equipment(spark, d).select("equipment_name", "equipment_type", limit.alias("max_pressure"))
    return joins.enrich_and_check(signal, master, "equipment_name", "pressure", "max_pressure")


@query("join_03_semi", sql("""SELECT order_id FROM erp_orders WHERE equipment_id IN (SELECT equipment_id FROM equipment)""", "erp_orders", "equipment"))
def semi(spark: SparkSession, d: str) -> DataFrame:
    return joins.semi(base.staged_orders(spark, d), base.staged_equipment(spark, d), "equipment_id").select("order_id")


@query("join_04_orphans", sql("""SELECT order_id, equipment_id FROM erp_orders o WHERE equipment_id IS NOT NULL
 AND NOT EXISTS (SELECT 1 FROM equipment e WHERE e.equipment_id = o.equipment_id)""", "erp_orders", "equipment"))
def orphan_orders(spark: SparkSession, d: str) -> DataFrame:
    orders, units = base.staged_orders(spark, d), base.staged_equipment(spark, d)
    return joins.orphans(orders, units, "equipment_id", "equipment_id").select("order_id", "equipment_id")


@query("join_05_missing_keys", sql("""SELECT DISTINCT equipment_name FROM readings WHERE equipment_name NOT IN
 (SELECT equipment_name FROM equipment)""", "readings", "equipment"))
def missing(spark: SparkSession, d: str) -> DataFrame:
    return joins.missing_keys(base.staged_readings(spark, d), base.staged_equipment(spark, d), "equipment_name")


@query("join_06_full_outer", sql("""SELECT coalesce(a.equipment_id, e.equipment_id) AS equipment_id, n_orders, equipment_name
 FROM (SELECT equipment_id, count(*) AS n_orders FROM erp_orders WHERE equipment_id IS NOT NULL GROUP BY 1) a
 FULL JOIN equipment e ON a.equipment_id = e.equipment_id""", "erp_orders", "equipment"))
def full_outer(spark: SparkSession, d: str) -> DataFrame:
    return joins.outer_pairs(_orders_per_unit(spark, d), _unit_names(spark, d), "equipment_id", "full")


@query("join_06_right_outer", sql("""SELECT e.equipment_id, n_orders, equipment_name
 FROM (SELECT equipment_id, count(*) AS n_orders FROM erp_orders WHERE equipment_id IS NOT NULL GROUP BY 1) a
 RIGHT JOIN equipment e ON a.equipment_id = e.equipment_id""", "erp_orders", "equipment"))
def right_outer(spark: SparkSession, d: str) -> DataFrame:
    return joins.outer_pairs(_orders_per_unit(spark, d), _unit_names(spark, d), "equipment_id", "right")


def _orders_per_unit(spark: SparkSession, d: str) -> DataFrame:
    orders = base.staged_orders(spark, d).filter(F.col("equipment_id").isNotNull())
    return orders.groupBy("equipment_id").agg(F.count(F.lit(1)).alias("n_orders"))


def _unit_names(spark: SparkSession, d: str) -> DataFrame:
    return base.staged_equipment(spark, d).select("equipment_id", "equipment_name")


@query("join_07_detect_changes", sql(f"""SELECT s.vendor_number, CASE WHEN h.vendor_number IS NULL THEN 'New'
 WHEN h.row_hash <> {row_hash('s.vendor_name', 's.country', 's.payment_terms')} THEN 'Changed' ELSE 'Unchanged' END AS change
 FROM vendors2 s LEFT JOIN history1 h ON s.vendor_number = h.vendor_number""", "vendors2", "history1"))
def detect_changes(spark: SparkSession, d: str) -> DataFrame:
    out = scd.detect_changes(
        base.staged_vendors(spark, d, 2), base.vendor_history(spark, d), "vendor_number", VENDOR_TRACKED
    )
    return out.select("vendor_number", "change")


# Order lines are dated 1995 to 2001; the second vendor load takes effect in the middle of them.
_FACT_SHIFT = "INTERVAL 9131 DAY"


@query("join_08_as_of", sql(f"""SELECT order_id, line_number, material_id, vendor_id, order_time, payment_terms FROM
 (SELECT order_id, line_number, material_id, vendor_id, loaded_at + {_FACT_SHIFT} AS order_time FROM order_lines) f
 LEFT JOIN history2 h ON f.vendor_id = h.vendor_number AND f.order_time >= h.valid_from AND f.order_time < h.valid_to""", "order_lines", "history2"))
def as_of(spark: SparkSession, d: str) -> DataFrame:
    at = (F.col("loaded_at") + F.expr(f"{_FACT_SHIFT}S")).alias("order_time")
    facts = b.order_lines(spark, d).select("order_id", "line_number", "material_id", "vendor_id", at)
    history = base.vendor_history2(spark, d).select(
        F.col("vendor_number").alias("vendor_id"), "payment_terms", "valid_from", "valid_to"
    )
    out = joins.as_of_join(facts, history, "vendor_id", "order_time")
    return out.select("order_id", "line_number", "material_id", "vendor_id", "order_time", "payment_terms")


# --- revenue -------------------------------------------------------------------------------------

_REVENUE = ["total_revenue", "avg_order_value"]


@query("agg_02_daily_revenue", sql(f"""SELECT revenue_sk, revenue_date, equipment_type, equipment_location, order_count,
 total_quantity, warn_count, total_records, {rounds(_REVENUE, 2)} FROM revenue""", "revenue"))
def revenue(spark: SparkSession, d: str) -> DataFrame:
    return rounded(base.revenue(spark, d), _REVENUE, 2)


@query("agg_13_metrics", sql(f"""SELECT 'daily_avg_sensor_reading' AS metric, {stable('avg(avg_reading)', 4)} AS value FROM kpi
 UNION ALL SELECT 'total_daily_revenue', {stable('sum(total_revenue)', 2)} FROM revenue
 UNION ALL SELECT 'quality_score_pct', {stable("count(*) FILTER (WHERE quality_flag IN ('PASS', 'WARN')) * 100.0 / count(*)", 4)}
 FROM silver""", "kpi", "revenue", "silver"))
def metrics(spark: SparkSession, d: str) -> DataFrame:
    out = gold.named_metrics(base.stats(spark, d), base.revenue(spark, d), base.silver_readings(spark, d))
    places = F.when(F.col("metric") == "total_daily_revenue", 2).otherwise(4)
    return out.withColumn(
        "value", F.when(places == 2, stable_round("value", 2)).otherwise(stable_round("value", 4))
    )


# --- history -------------------------------------------------------------------------------------


@query("chg_06_scd2_merge", sql("SELECT * FROM history2", "history2"))
def scd2_merge(spark: SparkSession, d: str) -> DataFrame:
    return base.vendor_history2(spark, d)


@query("chg_06_merge_partitions", sql("SELECT * FROM history2", "history2"))
def merge_stored_history(spark: SparkSession, d: str) -> DataFrame:
    """The second load merged into the stored history, of which only partitions with changes are touched."""
    path, history = work_dir(spark, "history"), base.vendor_history(spark, d)
    sinks.publish_history(history, path, "vendor_number")
    source = base.staged_vendors(spark, d, 2).select("vendor_number", *VENDOR_TRACKED)
    sinks.merge_history(source, path, "vendor_number", VENDOR_TRACKED, b.V2_TIME)
    return spark.read.parquet(path).select(*history.columns)


@query("chg_07_scd2_build", sql(f"""SELECT {key('vendor_number', 'row_hash', 'valid_from')} AS version_sk, vendor_number,
 vendor_name, country, payment_terms, row_hash, next_from IS NULL AS is_current, valid_from,
 coalesce(next_from, {_T} '9999-12-31 00:00:00') AS valid_to FROM (
  SELECT *, lead(valid_from) OVER (PARTITION BY vendor_number ORDER BY valid_from, row_hash) AS next_from FROM (
   SELECT *, loaded_at AS valid_from, lag(row_hash) OVER (PARTITION BY vendor_number ORDER BY loaded_at, row_hash) AS before
   FROM (SELECT DISTINCT *, {row_hash('vendor_name', 'country', 'payment_terms')} AS row_hash FROM (
     SELECT vendor_number, vendor_name, country, payment_terms, loaded_at FROM vendors1
     UNION ALL SELECT vendor_number, vendor_name, country, payment_terms, {_T} '2024-02-01 00:00:00' FROM vendors2)))
  WHERE before IS DISTINCT FROM row_hash)""", "vendors1", "vendors2"))
def scd2_build(spark: SparkSession, d: str) -> DataFrame:
    first = base.staged_vendors(spark, d)
    second = base.staged_vendors(spark, d, 2).withColumn("loaded_at", F.lit(b.V2_TIME).cast("timestamp_ntz"))
    return scd.scd2_build(first.unionByName(second), "vendor_number", VENDOR_TRACKED, "loaded_at")


_SNAP = "vendor_number, vendor_name, country, payment_terms, loaded_at"


@query("chg_08_snapshot_timestamp", sql(f"""SELECT h.vendor_number, h.vendor_name, h.country, h.payment_terms, h.loaded_at,
 h.loaded_at AS valid_from, CASE WHEN s.vendor_number IS NULL THEN {_T} '2024-02-01 00:00:00'
 WHEN s.loaded_at > h.loaded_at THEN s.loaded_at END AS valid_to
 FROM vendors1 h LEFT JOIN vendors2 s ON h.vendor_number = s.vendor_number
 UNION ALL SELECT s.vendor_number, s.vendor_name, s.country, s.payment_terms, s.loaded_at, s.loaded_at, NULL
 FROM vendors2 s LEFT JOIN vendors1 h ON h.vendor_number = s.vendor_number
 WHERE h.vendor_number IS NULL OR s.loaded_at > h.loaded_at""", "vendors1", "vendors2"))
def snapshot_timestamp(spark: SparkSession, d: str) -> DataFrame:
    columns = [c.strip() for c in _SNAP.split(",")]
    start = scd.snapshot_start(base.staged_vendors(spark, d), columns, "loaded_at")
    source = base.staged_vendors(spark, d, 2).select(*columns)
    return scd.snapshot_timestamp(start, source, "vendor_number", "loaded_at", b.V2_TIME)


@query("chg_09_snapshot_check", sql(f"""SELECT h.equipment_id, h.equipment_name, h.equipment_type, h.location, h.status,
 h.install_date, {_T} '2024-01-01 00:00:00' AS valid_from,
 CASE WHEN s.location <> h.location THEN {_T} '2024-02-01 00:00:00' END AS valid_to
 FROM equipment h LEFT JOIN equipment2 s ON h.equipment_id = s.equipment_id
 UNION ALL SELECT s.equipment_id, s.equipment_name, s.equipment_type, s.location, s.status, s.install_date,
 {_T} '2024-02-01 00:00:00', NULL FROM equipment2 s JOIN equipment h ON h.equipment_id = s.equipment_id
 WHERE s.location <> h.location""", "equipment", "equipment2"))
def snapshot_check(spark: SparkSession, d: str) -> DataFrame:
    columns = ["equipment_id", "equipment_name", "equipment_type", "location", "status", "install_date"]
    start = scd.snapshot_start(base.staged_equipment(spark, d), columns, "loaded_at")
    source = staging.stage_equipment(b.equipment_master_v2(spark, d)).select(*columns)
    watched = ["equipment_name", "equipment_type", "location", "status"]
    return scd.snapshot_check(start, source, "equipment_id", watched, b.V2_TIME)


@query("chg_10_dim_vendor_current", sql("SELECT * FROM history2 WHERE is_current", "history2"))
def dim_vendor(spark: SparkSession, d: str) -> DataFrame:
    return scd.dim_vendor(base.vendor_history2(spark, d))


@query("chg_10_dim_vendor_history", sql("SELECT * FROM history2", "history2"))
def dim_vendor_history(spark: SparkSession, d: str) -> DataFrame:
    return scd.dim_vendor(base.vendor_history2(spark, d), current_only=False)


@query("chg_11_dim_equipment", sql("SELECT * FROM dim_equipment", "dim_equipment"))
def dim_equipment(spark: SparkSession, d: str) -> DataFrame:
    return base.dim_equipment(spark, d)


# --- merges and changes ------------------------------------------------------------------------------

_V = "vendor_number, vendor_name, vendor_type, country, payment_terms, loaded_at"


def _vendors(spark: SparkSession, d: str, load: int) -> DataFrame:
    return base.staged_vendors(spark, d, load).drop("vendor_id")


@query("chg_01_merge_upsert", sql(f"""SELECT {_V} FROM vendors2 UNION ALL SELECT {_V} FROM vendors1
 WHERE vendor_number NOT IN (SELECT vendor_number FROM vendors2)""", "vendors1", "vendors2"))
def merge_upsert(spark: SparkSession, d: str) -> DataFrame:
    return merge.merge_upsert(_vendors(spark, d, 1), _vendors(spark, d, 2), ["vendor_number"])


@query("chg_02_merge_when", sql("""SELECT coalesce(t.vendor_number, s.vendor_number) AS vendor_number,
 coalesce(t.vendor_name, s.vendor_name) AS vendor_name, coalesce(t.loaded_at, s.loaded_at) AS loaded_at,
 CASE WHEN s.vendor_number IS NOT NULL THEN s.payment_terms ELSE t.payment_terms END AS payment_terms
 FROM vendors1 t FULL JOIN vendors2 s ON t.vendor_number = s.vendor_number""", "vendors1", "vendors2"))
def merge_when(spark: SparkSession, d: str) -> DataFrame:
    columns = ["vendor_number", "vendor_name", "payment_terms", "loaded_at"]
    target, source = _vendors(spark, d, 1).select(*columns), _vendors(spark, d, 2).select(*columns)
    return merge.merge_when(target, source, ["vendor_number"], ["payment_terms"])


@query("chg_03_merge_insert_new", sql("""SELECT * FROM readings""", "readings"))
def insert_new(spark: SparkSession, d: str) -> DataFrame:
    readings = base.staged_readings(spark, d)
    loaded = readings.filter(F.col("reading_timestamp") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    arriving = readings.filter(F.col("reading_timestamp") >= F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"))
    return merge.merge_insert_new(loaded, arriving, ["sensor_id", "reading_timestamp"])


_KPI_NUMBERS = ["avg_reading", "min_reading", "max_reading", "stddev_reading", "median_reading", "p95_reading"]


@query("chg_04_merge_kpi", sql(f"""SELECT kpi_sk, sensor_id, sensor_name, equipment_name, process_area, kpi_date,
 total_readings, warn_count, {rounds(_KPI_NUMBERS)} FROM kpi""", "kpi"))
def merge_kpi(spark: SparkSession, d: str) -> DataFrame:
    """KPIs of the days before the 20th, then a merge of everything from the 15th on."""
    silver_rows = base.silver_readings(spark, d)
    day = F.col("reading_timestamp")
    target = gold.daily_sensor_kpi(silver_rows.filter(day < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")))
    fresh = silver_rows.filter(day >= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    return rounded(merge.merge_kpi(target, fresh), _KPI_NUMBERS)


_SUMMED = ["avg_reading", "min_reading", "max_reading", "stddev_reading"]


@query("chg_04_merge_summaries", sql(f"""SELECT kpi_sk, sensor_id, sensor_name, equipment_name, process_area, kpi_date,
 total_readings, warn_count, total_readings AS sketched, {rounds(_SUMMED)} FROM kpi""", "kpi"))
def merge_summaries(spark: SparkSession, d: str) -> DataFrame:
    """Readings before noon stored as summaries, those of the afternoons merged into them; the sketches saw all values."""
    silver_rows, path = base.silver_readings(spark, d), work_dir(spark, "summaries")
    morning = F.hour("reading_timestamp") < 12
    for number, rows in enumerate([silver_rows.filter(morning), silver_rows.filter(~morning)]):
        summaries.merge_stored_summaries(summaries.kpi_summaries(rows, number), path)
    stored = spark.read.parquet(path)
    seen = stored.select(*gold.KPI_KEYS, F.kll_sketch_get_n_double("sketch").alias("sketched"))
    kpi = summaries.kpi_of_summaries(stored).drop("median_reading", "p95_reading")
    both = kpi.alias("k").join(seen.alias("s"), same_keys("k", "s", gold.KPI_KEYS)).select("k.*", "s.sketched")
    return rounded(both, _SUMMED)


@query("chg_05_merge_delete", sql(f"""SELECT {_V} FROM vendors2 WHERE payment_terms <> 'NET15'
 UNION ALL SELECT {_V} FROM vendors1 WHERE vendor_number NOT IN (SELECT vendor_number FROM vendors2)""", "vendors1", "vendors2"))
def merge_delete(spark: SparkSession, d: str) -> DataFrame:
    gone = F.col("payment_terms") == "NET15"
    return merge.merge_upsert(_vendors(spark, d, 1), _vendors(spark, d, 2), ["vendor_number"], delete_when=gone)


@query("chg_12_incremental_new", sql(f"""SELECT * FROM readings WHERE loaded_at >
 (SELECT max(loaded_at) - INTERVAL 2 HOUR FROM readings WHERE reading_timestamp < {_T} '2024-01-20 00:00:00')""", "readings"))
def incremental_new(spark: SparkSession, d: str) -> DataFrame:
    readings = base.staged_readings(spark, d)
    target = readings.filter(F.col("reading_timestamp") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    return merge.incremental_new(readings, target, "loaded_at", lookback="2 HOURS")


def _feed_sql() -> str:
    differs = "o.payment_terms IS DISTINCT FROM n.payment_terms OR o.loaded_at IS DISTINCT FROM n.loaded_at"

    def side(alias: str) -> str:
        return ", ".join(f"{alias}.{c}" for c in ("vendor_number", "vendor_name", "country", "payment_terms", "loaded_at"))

    return f"""SELECT {side('n')}, 'insert' AS _change_type FROM vendors2 n ANTI JOIN vendors1 o ON o.vendor_number = n.vendor_number
 UNION ALL SELECT {side('o')}, 'delete' FROM vendors1 o ANTI JOIN vendors2 n ON o.vendor_number = n.vendor_number
 UNION ALL SELECT {side('o')}, 'update_preimage' FROM vendors1 o JOIN vendors2 n ON o.vendor_number = n.vendor_number WHERE {differs}
 UNION ALL SELECT {side('n')}, 'update_postimage' FROM vendors1 o JOIN vendors2 n ON o.vendor_number = n.vendor_number WHERE {differs}"""


_FEED = ["vendor_number", "vendor_name", "country", "payment_terms", "loaded_at"]


@query("chg_13_change_feed", sql(_feed_sql(), "vendors1", "vendors2"))
def change_feed(spark: SparkSession, d: str) -> DataFrame:
    return changes.change_feed(
        _vendors(spark, d, 1).select(*_FEED), _vendors(spark, d, 2).select(*_FEED), ["vendor_number"]
    )


@query("chg_14_change_rows", sql(f"""SELECT vendor_number, payment_terms, CASE WHEN _change_type IN ('insert', 'update_postimage')
 THEN 'INSERT' ELSE 'DELETE' END AS change_action, _change_type LIKE 'update%' AS change_is_update FROM ({_feed_sql()})""", "vendors1", "vendors2"))
def change_rows(spark: SparkSession, d: str) -> DataFrame:
    out = changes.change_rows(
        _vendors(spark, d, 1).select(*_FEED), _vendors(spark, d, 2).select(*_FEED), ["vendor_number"]
    )
    return out.select("vendor_number", "payment_terms", "change_action", "change_is_update")


@query("chg_14_change_rows_append_only", sql("""SELECT vendor_number, payment_terms, 'INSERT' AS change_action,
 false AS change_is_update FROM vendors2 WHERE vendor_number NOT IN (SELECT vendor_number FROM vendors1)""", "vendors1", "vendors2"))
def change_rows_append_only(spark: SparkSession, d: str) -> DataFrame:
    out = changes.change_rows(
        _vendors(spark, d, 1).select(*_FEED), _vendors(spark, d, 2).select(*_FEED), ["vendor_number"], append_only=True
    )
    return out.select("vendor_number", "payment_terms", "change_action", "change_is_update")


@query("chg_15_changes_of_view", sql("""SELECT n.vendor_number, n.payment_terms, 'insert' AS _change_type FROM vendors2 n
 WHERE n.payment_terms = 'NET30' AND n.vendor_number NOT IN (SELECT vendor_number FROM vendors1 WHERE payment_terms = 'NET30')
 UNION ALL SELECT o.vendor_number, o.payment_terms, 'delete' FROM vendors1 o
 WHERE o.payment_terms = 'NET30' AND o.vendor_number NOT IN (SELECT vendor_number FROM vendors2 WHERE payment_terms = 'NET30')""", "vendors1", "vendors2"))
def changes_of_view(spark: SparkSession, d: str) -> DataFrame:
    view = F.col("payment_terms") == "NET30"
    columns = ["vendor_number", "payment_terms"]
    old, new = (_vendors(spark, d, load).filter(view).select(*columns) for load in (1, 2))
    return changes.change_feed(old, new, ["vendor_number"])


_CHANGES = """(SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS line_number,
 CAST(l_partkey AS VARCHAR) AS material_id, CAST(l_quantity AS INTEGER) AS order_quantity, l_returnflag AS flag,
 strftime(l_shipdate, '%Y%m%d') || lpad(CAST(l_partkey AS VARCHAR), 9, '0') || lpad(CAST(l_suppkey AS VARCHAR), 9, '0')
 || lpad(CAST(CAST(l_extendedprice * 100 AS BIGINT) AS VARCHAR), 12, '0') AS seq FROM lineitem)"""


@query("chg_16_cdc_apply", f"""WITH c AS {_CHANGES},
 t AS (SELECT * FROM c WHERE flag = 'A' QUALIFY row_number() OVER (PARTITION BY order_id, line_number ORDER BY seq DESC) = 1),
 s AS (SELECT * FROM c WHERE flag <> 'A' QUALIFY row_number() OVER (PARTITION BY order_id, line_number ORDER BY seq DESC) = 1)
 SELECT order_id, line_number, material_id, order_quantity FROM s WHERE flag <> 'R'
 UNION ALL SELECT order_id, line_number, material_id, order_quantity FROM t ANTI JOIN s USING (order_id, line_number)""")
def cdc_apply(spark: SparkSession, d: str) -> DataFrame:
    """Accepted lines are the table; other lines are changes, of which a returned one deletes."""
    seq = F.concat(
        F.date_format("l_shipdate", "yyyyMMdd"),
        F.lpad(F.col("l_partkey").cast("string"), 9, "0"),
        F.lpad(F.col("l_suppkey").cast("string"), 9, "0"),
        F.lpad(F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string"), 12, "0"),
    )
    lines = b.table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").cast("string").alias("material_id"),
        F.col("l_quantity").cast("int").alias("order_quantity"),
        seq.alias("seq"),
        F.col("l_returnflag").alias("flag"),
    )
    keys = ["order_id", "line_number"]
    accepted = first_rows(lines.filter("flag = 'A'"), keys, [F.col("seq").desc()])
    events = lines.filter("flag <> 'A'").withColumn("op", F.when(F.col("flag") == "R", "D").otherwise("U"))
    return merge.cdc_apply(accepted.drop("seq", "flag"), events, keys, "seq")


@query("str_10_has_changes", sql(f"SELECT count(*) > 0 AS has_changes FROM ({_feed_sql()})", "vendors1", "vendors2"))
def has_changes(spark: SparkSession, d: str) -> DataFrame:
    return changes.has_changes(
        _vendors(spark, d, 1).select(*_FEED), _vendors(spark, d, 2).select(*_FEED), ["vendor_number"]
    )
