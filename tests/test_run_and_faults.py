"""Faulted inputs and the gate that stops each of them."""

import uuid

import pytest
from pyspark.sql import functions as F

from tests import golden
from tierworks.operators import ordering, quality, silver
from tierworks.plans.medallion import RunConfig, read_gates, read_gold, run_medallion
from tierworks.schemas import SENSOR_READINGS, Band
from tierworks.session import work_dir
from tierworks.sources import ingest

AT = "2024-01-17 00:00:00"


@pytest.fixture
def good(spark):
    """A calm plant: no missing, impossible or spiking value."""
    calm = golden.readings(spark).filter("reading_value IS NOT NULL AND reading_value > 0")
    return calm.filter("reading_value <> 300.0")


def config(spark, **changes):
    return RunConfig(root=work_dir(spark, f"test-{uuid.uuid4().hex}"), at=AT, band=Band(0.0, 600.0), **changes)


def run(spark, bronze, **changes):
    cfg = config(spark, **changes)
    result = run_medallion(bronze, cfg)
    return cfg, result, [d for _, d, _ in result.gates]


def test_good_run_passes_every_gate(spark, good):
    cfg, result, decisions = run(spark, good)
    assert decisions == ["PASS", "PASS", "PASS"] and result.status == "SUCCESS"
    assert {(r.gate, r.decision) for r in read_gates(spark, cfg).collect()} == {(g, "PASS") for g in ("bronze", "silver", "gold")}
    assert read_gold(spark, cfg, result).filter("_is_cached").isEmpty()
    assert spark.read.parquet(f"{cfg.root}/run_log").first().status == "SUCCESS"


def test_missing_column(spark, good):
    matched = ingest.match_by_name(good.drop("status"), SENSOR_READINGS)
    _, _, decisions = run(spark, matched, required=("sensor_id", "reading_value", "status"))
    assert decisions == ["FAIL", "SKIP", "SKIP"]
    suite = {r.expectation: r.success for r in quality.run_suite(good.drop("status"), quality.SENSOR_SUITE).collect()}
    assert suite["column_set"] is False and suite["in_set:status"] is False


def test_text_in_numeric_column(spark, good):
    text = F.when(F.col("status") == "ACTIVE", F.lit("INVALID_READING"))
    broken = good.withColumn("reading_value", text)
    typed = silver.safe_cast(broken, "reading_value", "double")
    assert typed.filter("cast_flag = 'PASS'").isEmpty()
    assert run(spark, typed.drop("cast_flag"))[2] == ["FAIL", "SKIP", "SKIP"]


def test_all_values_missing(spark, good):
    empty = good.withColumns({"reading_value": F.lit(None).cast("double"), "sensor_id": F.lit(None).cast("string")})
    cfg, _, decisions = run(spark, empty)
    assert decisions == ["FAIL", "SKIP", "SKIP"]
    assert spark.read.parquet(f"{cfg.root}/quarantine/bronze").count() == good.count()


def test_empty_input(spark, good):
    assert run(spark, good.limit(0))[2] == ["FAIL", "SKIP", "SKIP"]


def test_every_row_three_times(spark, good):
    tripled = good.union(good).union(good)
    keys = ["sensor_id", "reading_timestamp"]
    stats = ordering.duplicate_stats(tripled, keys).first()
    assert stats.duplicates_removed == 2 * good.count()
    metrics = quality.quality_metrics(
        tripled.withColumn("quality_flag", F.lit("PASS")), ["sensor_id"], keys, SENSOR_READINGS, "quality_flag"
    )
    verdicts = {r.metric: r.verdict for r in quality.evaluate_gate(metrics, quality.thresholds(spark)).collect()}
    assert verdicts["duplicate_rate"] == "FAIL"
    cfg, _, decisions = run(spark, tripled)
    assert decisions == ["PASS", "PASS", "PASS"]
    cleaned = spark.read.parquet(f"{cfg.root}/silver")
    assert cleaned.count() == good.count()
    bronze = spark.read.parquet(f"{cfg.root}/bronze")
    assert quality.reconcile(tripled, bronze, cleaned, cleaned.limit(0), keys).first().verdict == "PASS"


def test_late_rows(spark, good):
    old = good.withColumns({c: F.col(c) - F.expr("INTERVAL 3 DAYS") for c in ("reading_timestamp", "_loaded_at")})
    assert ordering.late_rows(good.union(old), "reading_timestamp", "48 HOURS").count() == old.count()
    verdict = quality.freshness(old, "_loaded_at", AT).first().freshness
    assert (verdict, quality.freshness(good, "_loaded_at", AT).first().freshness) == ("error", "pass")


def test_extreme_values_stop_at_the_gold_gate(spark, good):
    last = F.col("reading_timestamp") == F.lit("2024-01-16 11:00:00").cast("timestamp_ntz")
    spiked = good.withColumn("reading_value", F.when(last, 5000.0).otherwise(F.col("reading_value")))
    cfg = RunConfig(root=work_dir(spark, "extreme"), at=AT, band=Band(0.0, 60000.0))
    run_medallion(good, cfg)
    result = run_medallion(spiked, cfg)
    assert [d for _, d, _ in result.gates] == ["PASS", "PASS", "FAIL"]
    served = read_gold(spark, cfg, result)  # the last good alerts, marked
    assert served.filter("NOT _is_cached").isEmpty() and served.filter("alert_severity = 'CRITICAL'").isEmpty()


def test_negative_values_need_a_physical_band(spark, good):
    negative = good.withColumn("reading_value", -F.col("reading_value"))
    wide = silver.clean_sensors(negative, Band(-999, 9999)).filter("quality_flag <> 'PASS'")
    assert wide.isEmpty()
    physical = silver.clean_sensors(negative, Band(0, 600, fail_lo=0, fail_hi=600))
    share = F.count_if(F.col("quality_flag") == "FAIL") / F.count("*")
    assert physical.agg(share).first()[0] == 1.0
    cfg = RunConfig(root=work_dir(spark, "negative"), at=AT, band=Band(0, 600, fail_lo=0, fail_hi=600))
    assert [d for _, d, _ in run_medallion(negative, cfg).gates] == ["PASS", "FAIL", "SKIP"]


def test_expectation_actions(spark):
    df = golden.readings(spark)
    kept = quality.expect(df, warn={"band": "reading_value > 0"}, drop={"value": "reading_value IS NOT NULL"})
    assert kept.rows.count() == 31
    assert kept.counts.get == {"n_rows": 32, "band": 6, "value": 1}
    with pytest.raises(Exception, match="expectation failed: value"):
        quality.expect(df, fail={"value": "reading_value IS NOT NULL"}).rows.collect()


def test_second_run_gives_the_same_tables(spark, good):
    first, _, _ = run(spark, good)
    second, _, _ = run(spark, good)
    for table in ("silver", "kpi", "alerts"):
        a, b = (spark.read.parquet(f"{cfg.root}/{table}") for cfg in (first, second))
        assert a.count() > 0 and quality.same_content(a, b).isEmpty()
