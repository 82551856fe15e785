"""Stored KPI summaries, merged batch by batch, against KPIs of all readings at once."""

import bisect
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tierworks.operators import gold
from tierworks.operators.summaries import kpi_of_summaries, kpi_summaries, merge_stored_summaries, merge_summaries

SCHEMA = """sensor_id string, sensor_name string, equipment_name string, process_area string, reading_timestamp timestamp_ntz,
 reading_value double, quality_flag string, is_valid boolean, extra string"""
EXACT = ["total_readings", "avg_reading", "min_reading", "max_reading", "stddev_reading", "warn_count"]


def silver(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def readings(seed, n=4000):
    draw = random.Random(seed)
    rows = []
    for k in range(n):
        sensor = None if draw.random() < 0.05 else f"s{int(draw.random() ** 4 * 5)}"  # one sensor has most of them
        time = datetime(2024, 1, 1) + timedelta(hours=draw.randrange(72), seconds=k % 3600)
        flag = draw.choices(["PASS", "WARN", "FAIL"], [8, 1, 1])[0]
        rows.append((sensor, "name", None, "area", time, draw.choice([draw.gauss(1e6, 1), 5.0, draw.random()]), flag, True, "x"))
    return rows


def by_key(df):
    return {(r.sensor_id, r.kpi_date): r for r in df.collect()}


def assert_same(got, want):
    assert got.keys() == want.keys()
    for key, row in want.items():
        for name in EXACT:
            assert got[key][name] == (None if row[name] is None else pytest.approx(row[name], rel=1e-9, abs=1e-6)), (key, name)


def test_batches_merged_into_a_stored_table_equal_one_pass(spark, tmp_path):
    rows, path = readings(1), str(tmp_path / "summaries")
    for number in range(4):
        batch = kpi_summaries(silver(spark, rows[number::4]), number)
        merge_stored_summaries(batch, path)
        if number == 2:  # a repeated batch changes nothing
            merge_stored_summaries(batch, path)
    stored = spark.read.parquet(path)
    assert_same(by_key(kpi_of_summaries(stored)), by_key(gold.daily_sensor_kpi(silver(spark, rows))))
    assert kpi_of_summaries(stored).columns == gold.daily_sensor_kpi(silver(spark, rows)).columns


def test_quantiles_of_merged_sketches_are_within_their_rank_error(spark):
    rows = [("s", "n", "e", "a", datetime(2024, 1, 1), float(k * 7919 % 40009), "PASS", True, "") for k in range(40009)]
    parts = [kpi_summaries(silver(spark, rows[k::3]), k) for k in range(3)]
    (row,) = kpi_of_summaries(merge_summaries(merge_summaries(parts[0], parts[1]), parts[2])).collect()
    ordered = sorted(r[5] for r in rows)
    for got, rank in ((row.median_reading, 0.5), (row.p95_reading, 0.95)):
        assert abs(bisect.bisect_left(ordered, got) / len(ordered) - rank) < 0.005


def test_only_days_of_the_batch_are_replaced(spark, tmp_path):
    rows, path = readings(2, 600), str(tmp_path / "summaries")
    merge_stored_summaries(kpi_summaries(silver(spark, rows), 0), path)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "summaries").glob("kpi_date=*/*.parquet")}
    late = silver(spark, [(*rows[0][:4], datetime(2024, 1, 2, 5), 7.0, "PASS", True, "x")])
    merge_stored_summaries(kpi_summaries(late, 1), path)
    now = {p: p.stat().st_mtime_ns for p in (tmp_path / "summaries").glob("kpi_date=*/*.parquet")}
    assert {p.parent.name for p in files.keys() - now.keys()} == {"kpi_date=2024-01-02"}
    assert all(now[p] == files[p] for p in files.keys() & now.keys())
    total = spark.read.parquet(path).agg(F.sum("total_readings").alias("n")).first().n
    assert total == sum(r[6] != "FAIL" for r in rows) + 1


def test_empty_batches_missing_values_and_single_readings(spark):
    none, one = silver(spark, []), silver(spark, [("s", "n", "e", "a", datetime(2024, 1, 1), 4.0, "PASS", True, "")])
    blank = silver(spark, [("s", "n", "e", "a", datetime(2024, 1, 1), None, "WARN", None, "")])
    assert kpi_of_summaries(merge_summaries(kpi_summaries(none), kpi_summaries(none))).count() == 0
    for a, b in ((none, one), (one, none)):
        (row,) = kpi_of_summaries(merge_summaries(kpi_summaries(a, 0), kpi_summaries(b, 1))).collect()
        assert (row.total_readings, row.avg_reading, row.stddev_reading, row.median_reading) == (1, 4.0, None, 4.0)
    for a, b in ((blank, one), (one, blank)):
        merged = merge_summaries(kpi_summaries(a, 0, require_valid=False), kpi_summaries(b, 1, require_valid=False))
        (row,) = kpi_of_summaries(merged).collect()
        assert (row.total_readings, row.warn_count, row.avg_reading, row.median_reading) == (2, 1, 4.0, 4.0)
    (row,) = kpi_of_summaries(kpi_summaries(blank, require_valid=False)).collect()
    assert (row.total_readings, row.avg_reading, row.median_reading) == (1, None, None)
