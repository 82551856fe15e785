"""Hand-checked results on a small plant."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests import golden
from tierworks.functions import business, flags, masking
from tierworks.operators import gold, quality, silver, spc
from tierworks.schemas import DEFAULT_BAND, AlertLimits, Band
from tierworks.sources import staging


@pytest.fixture(scope="module")
def cleaned(spark):
    return silver.clean_sensors(staging.stage_sensor(golden.readings(spark)), DEFAULT_BAND).cache()


def test_flags(cleaned):
    assert Counter(r.quality_flag for r in cleaned.collect()) == {"PASS": 30, "WARN": 1, "FAIL": 1}


def test_kpi_and_alerts(spark, cleaned):
    kpi = gold.daily_sensor_kpi(cleaned)
    stats = {(r.sensor_id, r.kpi_date.day): r for r in kpi.collect()}
    alerts = {(r.sensor_id, r.kpi_date.day): r for r in spc.sensor_alerts(kpi).collect()}
    assert stats.keys() == alerts.keys() == golden.ALERTS.keys()
    for key, (n, mean, sd, median, p95, *classes) in golden.ALERTS.items():
        s, a = stats[key], alerts[key]
        assert s.total_readings == n and s.warn_count == 0
        assert (s.avg_reading, s.median_reading, s.p95_reading) == pytest.approx((mean, median, p95), abs=1e-9)
        assert s.stddev_reading == pytest.approx(sd, abs=6e-4)
        got = [a.stability_level, a.signal_quality, a.volatility_trend, a.spike_status, a.alert_severity]
        assert got == classes
        assert a.range_violated == (key in golden.OUTSIDE) and not a.has_outlier


def test_warn_rows_count_only_without_the_validity_rule(cleaned):
    strict = gold.daily_sensor_kpi(cleaned).agg(F.sum("warn_count"), F.sum("total_readings")).first()
    loose = gold.daily_sensor_kpi(cleaned, require_valid=False).agg(F.sum("warn_count"), F.sum("total_readings")).first()
    assert tuple(strict) == (0, 30) and tuple(loose) == (1, 31)


def test_stats_equal_kpi_without_quantiles(cleaned):
    names = ["kpi_sk", "total_readings", "avg_reading", "stddev_reading", "warn_count"]
    a = {r.kpi_sk: tuple(r) for r in gold.daily_sensor_stats(cleaned).select(*names).collect()}
    assert a == {r.kpi_sk: tuple(r) for r in gold.daily_sensor_kpi(cleaned).select(*names).collect()}


def test_orders_and_revenue(spark):
    validated = silver.validate_orders(
        staging.stage_orders(golden.orders(spark)), staging.stage_equipment(golden.equipment(spark)), "2024-02-01"
    )
    flagged = {r.order_id: r.quality_flag for r in validated.collect()}
    assert Counter(flagged.values()) == {"PASS": 3, "WARN": 1, "FAIL": 3}
    assert flagged["O7"] == "WARN"
    assert {k for k, v in flagged.items() if v == "FAIL"} == {"O4", "O5", "O6"}
    total = gold.daily_revenue(validated).agg(
        F.count("*"), F.sum("order_count"), F.sum("total_revenue"), F.sum("total_quantity"), F.sum("warn_count")
    ).first()
    assert tuple(total) == (4, 4, 19100.0, 10, 1)
    tiers = Counter(r.order_tier for r in silver.order_line_items(golden.orders(spark)).collect())
    assert tiers == {"HIGH_VALUE": 1, "MEDIUM_VALUE": 2, "LOW_VALUE": 4}


def test_old_unit_is_aging_before_retired(spark):
    staged = staging.stage_equipment(golden.equipment(spark))
    as_written = {r.equipment_id: r.lifecycle_stage for r in silver.equipment_enriched(staged, "2024-02-01").collect()}
    swapped = {r.equipment_id: r.lifecycle_stage
               for r in silver.equipment_enriched(staged, "2024-02-01", status_first=True).collect()}
    assert (as_written["U3"], swapped["U3"]) == ("AGING", "RETIRED")
    assert as_written["U1"] == "AGING" and as_written["U2"] == "ACTIVE"


def test_gate_decisions(spark, cleaned):
    bronze = staging.stage_sensor(golden.readings(spark))
    alerts = spc.sensor_alerts(gold.daily_sensor_kpi(cleaned))
    got = {r.gate: (r.decision, r.measure) for r in quality.gate_decisions(bronze, cleaned, alerts).collect()}
    assert got == {"bronze": ("FAIL", 1.0), "silver": ("PASS", 3.125), "gold": ("FAIL", 1.0)}
    summary = spc.alarm_summary(alerts).first()
    assert (summary.alarm_level, summary.exit_code, summary.critical_count) == ("CRITICAL", 2, 1)


def _classify(spark, sd, mean, low, high, psd, pmean, pmax):
    schema = "avg_reading double, stddev_reading double, min_reading double, max_reading double, " \
             "prev_stddev double, prev_avg double, prev_max double"
    df = spark.createDataFrame([(mean, sd, low, high, psd, pmean, pmax)], schema)
    lim = spc.limit_columns(AlertLimits())
    return df.select(
        spc.stability_level(lim), spc.signal_quality(lim), spc.has_outlier(lim), spc.range_violated(lim),
        spc.volatility_trend(lim), spc.spike_status(lim), spc.alert_severity(lim),
    ).first()


@pytest.mark.parametrize(
    "row, want",
    [
        # boundaries: 5 and 25 are NORMAL; a zero mean is INVALID and never CRITICAL
        ((5.0, 0.0, -1.0, 1.0, None, None, None), ("NORMAL", "INVALID", False, False, "NO_HISTORY", "NO_HISTORY", "OK")),
        ((25.0, 100.0, 90.0, 110.0, 25.0, 100.0, 110.0), ("NORMAL", "CLEAN", False, False, "STEADY", "NORMAL", "OK")),
        # one reading: no deviation
        ((None, 10.0, 10.0, 10.0, 1.0, 10.0, 12.0), ("INSUFFICIENT_DATA", "CLEAN", False, False, "STEADY", "SPIKE", "OK")),
        # outlier on the low side only: marked, but severity looks at the high side
        ((2.0, 10.0, 5.0, 11.0, 2.0, 10.0, 11.0), ("STABLE", "CLEAN", True, True, "STEADY", "NORMAL", "OK")),
        ((2.0, 10.0, 9.0, 15.0, 2.0, 10.0, 14.0), ("STABLE", "CLEAN", True, True, "STEADY", "NORMAL", "WARNING")),
        # trend and shift; ratio limits are exclusive
        ((3.0, 100.0, 99.0, 101.0, 2.0, 100.0, 101.0), ("STABLE", "CLEAN", False, False, "INCREASING", "NORMAL", "OK")),
        ((3.1, 100.0, 99.0, 101.0, 2.0, 90.0, 101.0), ("STABLE", "CLEAN", False, False, "DEGRADING", "SHIFT", "WARNING")),
        ((1.0, 100.0, 99.5, 100.5, 2.0, 100.0, 101.0), ("STABLE", "CLEAN", False, False, "IMPROVING", "NORMAL", "OK")),
        ((30.0, 60.0, 40.0, 80.0, 30.0, 60.0, 80.0), ("UNSTABLE", "NOISY", False, False, "STEADY", "NORMAL", "CRITICAL")),
        ((30.0, 300.0, 280.0, 320.0, 30.0, 300.0, 320.0), ("UNSTABLE", "CLEAN", False, False, "STEADY", "NORMAL", "WARNING")),
    ],
)
def test_alert_boundaries(spark, row, want):
    assert tuple(_classify(spark, *row)) == want


def test_named_functions(spark):
    business.register(spark)
    df = spark.createDataFrame([(148500, 150000), (0, 0)], "p bigint, t bigint")
    native = [r[0] for r in df.select(business.quality_score("p", "t")).collect()]
    assert native == [99.0, 0.0] == [r[0] for r in df.selectExpr("quality_score(p, t)").collect()]
    states = spark.createDataFrame([("a",), (" M ",), ("",), (None,), ("broken",)], "s string")
    want = ["ACTIVE", "MAINTENANCE", "UNKNOWN", "UNKNOWN", "BROKEN"]
    assert [r[0] for r in states.select(business.parse_status("s")).collect()] == want
    assert [r[0] for r in states.selectExpr("sensor_state(s)").collect()] == want
    z = spark.createDataFrame([(12.0, 10.0, 3.0), (12.0, 10.0, 0.0), (12.0, 10.0, None)], "r double, m double, s double")
    assert [r[0] for r in z.select(business.anomaly_score("r", "m", "s")).collect()] == [0.6667, 0.0, 0.0]
    money = spark.createDataFrame([(1e6,), (5e5,), (1e5,), (99999.99,)], "v double")
    tiers = ["PLATINUM", "GOLD", "SILVER", "BRONZE"]
    assert [r[0] for r in money.select(business.revenue_tier("v")).collect()] == tiers
    assert [r[0] for r in money.selectExpr("revenue_tier(v)").collect()] == tiers
    days = business.date_range(spark, "2025-01-30", "2025-02-02").collect()
    assert [r.dt.day for r in days] == [30, 31, 1, 2]
    assert spark.sql("SELECT * FROM generate_date_range(DATE'2025-01-30', DATE'2025-02-02')").count() == 4


def test_masking(spark):
    df = spark.createDataFrame([("who@site.example",)], "e string")
    seen = {role: df.select(masking.mask_email("e", role)).first()[0] for role in ("ADMIN", "ANALYST", "OTHER")}
    assert seen == {"ADMIN": "who@site.example", "ANALYST": "****@site.example", "OTHER": "**REDACTED**"}


def test_fail_band_comes_before_warn_band(spark):
    df = spark.createDataFrame([(None,), (-5000.0,), (-1000.0,), (0.0,), (9999.0,)], "v double")
    band = Band(-999, 9999, -2000, 20000)
    assert [r[0] for r in df.select(flags.quality_flag("v", band)).collect()] == ["FAIL", "FAIL", "WARN", "PASS", "PASS"]


def test_rounding_keeps_every_value(spark):
    values = [1e20, -3e25, math.nan, math.inf, None, 2.345]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(business.stable_round("v", 2)).collect()]
    assert math.isnan(got[2]) and got[:2] + got[3:] == [1e20, -3e25, math.inf, None, 2.35]
    business.register(spark)
    scores = df.withColumn("m", F.lit(0.0)).withColumn("s", F.lit(1.0)).selectExpr("anomaly_score(v, m, s)").collect()
    assert scores[0][0] == 1e20 and scores[3][0] == math.inf
