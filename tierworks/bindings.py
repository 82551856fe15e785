"""Bronze views of the plant's tables over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierworks.functions.flags import first_match, label_lookup
from tierworks.schemas import TABLES, Band

# The test events have values between 0 and about 560; this band splits them into all flags.
TEST_BAND = Band(1.0, 150.0)
AS_OF = "2024-02-01 00:00:00"
V1_TIME = "2024-01-01 00:00:00"
V2_TIME = "2024-02-01 00:00:00"

STATUS_OF_EVENT = {
    "click": "ACTIVE", "view": "ACTIVE", "purchase": "MAINTENANCE",
    "signup": "INACTIVE", "error": "ERROR",
}
STATUS_OF_ORDER = {"F": "COMPLETED", "O": "RELEASED", "P": "CANCELLED"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(c: str):
    return F.col(c).cast("string")


def readings_of(events: DataFrame) -> DataFrame:
    """Raw sensor readings; each event is one reading of the sensor ``user_id``."""
    faulty = (F.col("event_type") == "error") & (F.col("value") > 100)
    return events.select(
        _text("user_id").alias("sensor_id"),
        F.concat(F.lit("S-"), _text("user_id")).alias("sensor_name"),
        F.concat(F.lit("EQ-"), (F.col("user_id") % 20).cast("string")).alias("equipment_name"),
        F.when(~faulty, F.col("value")).alias("reading_value"),
        F.col("ts").alias("reading_timestamp"),
        label_lookup(F.col("event_type"), STATUS_OF_EVENT).alias("status"),
        F.concat(F.lit("AREA-"), (F.col("user_id") % 5).cast("string")).alias("process_area"),
        (F.col("ts") + F.expr("INTERVAL 5 MINUTES")).alias("_loaded_at"),
    )


def sensor_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_of(table(spark, sf_dir, "events"))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum("l_quantity").cast("int").alias("order_quantity"))
    )
    key = F.col("o_orderkey")
    return (
        table(spark, sf_dir, "orders")
        .join(lines, "o_orderkey", "left")
        .select(
            key.cast("string").alias("order_id"),
            F.concat(F.lit("T"), (key % 4).cast("string")).alias("order_type"),
            F.when(key % 50 != 0, _text("o_custkey")).alias("equipment_id"),
            (key % 200).cast("string").alias("material_id"),
            F.when(key % 97 != 0, F.col("o_orderdate").cast("date")).alias("order_date"),
            "order_quantity",
            F.col("o_totalprice").alias("net_value"),
            label_lookup(F.col("o_orderstatus"), STATUS_OF_ORDER).alias("status"),
            F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("priority"),
            F.concat(F.lit("USER-"), (key % 50).cast("string")).alias("created_by"),
            (F.col("o_orderdate") + F.expr("INTERVAL 6 HOURS")).alias("_loaded_at"),
        )
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        _text("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        _text("l_partkey").alias("material_id"),
        _text("l_suppkey").alias("vendor_id"),
        F.col("l_quantity").cast("int").alias("order_quantity"),
        F.col("l_extendedprice").alias("net_value"),
        F.col("l_shipdate").alias("loaded_at"),
    )


def equipment_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every twentieth customer is missing, which leaves orphan orders."""
    key = F.col("c_custkey")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "customer")
        .filter(key % 20 != 0)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            key.cast("string").alias("equipment_id"),
            F.concat(F.lit("EQ-"), key.cast("string")).alias("equipment_name"),
            F.col("c_mktsegment").alias("equipment_type"),
            F.col("n_name").alias("location"),
            F.date_add(F.lit("2005-01-01").cast("date"), (key % 7000).cast("int")).alias("install_date"),
            F.col("r_name").alias("manufacturer"),
            F.when(F.col("c_acctbal") < 0, "DECOMMISSIONED").otherwise("ACTIVE").alias("status"),
            F.lit(V1_TIME).cast("timestamp_ntz").alias("_loaded_at"),
        )
    )


def equipment_master_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later load: some units moved, some were removed."""
    key = F.col("equipment_id").cast("bigint")
    return (
        equipment_master(spark, sf_dir)
        .filter(key % 11 != 0)
        .withColumn("location", F.when(key % 6 == 1, "RELOCATED").otherwise(F.col("location")))
        .withColumn("_loaded_at", F.lit(V2_TIME).cast("timestamp_ntz"))
    )


def _vendor(key, terms, loaded):
    return [
        key.cast("string").alias("vendor_id"),
        F.col("s_name").alias("vendor_name"),
        F.concat(F.lit("TYPE-"), (F.col("s_suppkey") % 3).cast("string")).alias("vendor_type"),
        F.col("n_name").alias("country"),
        terms.alias("payment_terms"),
        loaded.cast("timestamp_ntz").alias("_loaded_at"),
    ]


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))


def _terms():
    return first_match([(F.col("s_acctbal") < 0, "NET15"), (F.col("s_acctbal") < 5000, "NET30")], "NET60")


def vendors_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _suppliers(spark, sf_dir).select(*_vendor(F.col("s_suppkey"), _terms(), F.lit(V1_TIME)))


def vendors_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second load: a third changed its terms, a seventh disappeared, a tenth is new."""
    base = _suppliers(spark, sf_dir)
    key = F.col("s_suppkey")
    changed = key % 3 == 0
    kept = base.filter(key % 7 != 0).select(
        *_vendor(
            key,
            F.when(changed, "NET90").otherwise(_terms()),
            F.when(changed, F.lit(V2_TIME)).otherwise(F.lit(V1_TIME)),
        )
    )
    added = base.filter(key % 10 == 0).select(*_vendor(key + 1000000, _terms(), F.lit(V2_TIME)))
    return kept.unionByName(added)


def materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.cast("string").alias("material_id"),
        F.col("p_name").alias("material_name"),
        F.col("p_type").alias("material_type"),
        F.when(key % 2 == 0, "EA").otherwise("KG").alias("unit_of_measure"),
        F.concat(F.lit("PLT-"), (key % 5).cast("string")).alias("plant_code"),
        F.lit(V1_TIME).cast("timestamp_ntz").alias("_loaded_at"),
    )


def _k():
    """The number inside the event's properties."""
    return F.get_json_object("props", "$.k").cast("int")


def iot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON payload per event, with two readings, nested metadata and tags.

    ``note`` is a JSON null in every tenth payload and missing in the others.
    """
    events = table(spark, sf_dir, "events").withColumn("k", _k())
    quality = F.when(F.col("value") > 150, "WARN").otherwise("PASS")
    payload = F.concat(
        F.lit('{"sensor_id":"'), _text("user_id"),
        F.lit('","status":"'), label_lookup(F.col("event_type"), STATUS_OF_EVENT),
        F.lit('","readings":[{"value":'), _text("value"), F.lit(',"unit":"C","quality":"'), quality,
        F.lit('"},{"value":'), _text("k"), F.lit(',"unit":"bar"}],"metadata":{"location":"AREA-'),
        (F.col("user_id") % 5).cast("string"), F.lit('","rig":"EQ-'), (F.col("user_id") % 20).cast("string"),
        F.lit('"},"tags":["'), F.upper("event_type"), F.lit('","K'), (F.col("k") % 3).cast("string"), F.lit('"]'),
        F.when(F.col("k") % 10 == 0, F.lit(',"note":null}')).otherwise(F.lit("}")),
    )
    return events.select(
        _text("event_id").alias("event_id"),
        F.col("ts").alias("event_timestamp"),
        payload.alias("raw_payload"),
        (F.col("ts") + F.expr("INTERVAL 5 MINUTES")).alias("_loaded_at"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.col("value") > 150
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("log_id"),
        F.col("event_type").alias("procedure_name"),
        F.when(failed, "FAILURE").otherwise("SUCCESS").alias("status"),
        _k().cast("bigint").alias("row_count"),
        F.col("ts").alias("executed_at"),
        F.when(failed, "value out of range").alias("error_message"),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines as an application would write them; every 25th one is not parseable."""
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    good = F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" "), level, F.lit(" ["), F.col("event_type"),
        F.lit("] code=E"), F.lpad(_k().cast("string"), 4, "0"), F.lit(" user="), _text("user_id"),
    )
    line = F.when(F.col("event_id") % 25 == 0, F.concat(F.lit("garbled "), _text("event_id"))).otherwise(good)
    return table(spark, sf_dir, "events").select("event_id", line.alias("line"))
