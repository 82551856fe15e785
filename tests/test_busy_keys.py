"""One key owns a third of the rows and times repeat: results equal plain windows, and no job runs while planning."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierworks.operators import gold, ordering, quality

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def readings(spark):
    r = random.Random(5)
    rows = []
    for sensor, n in (("hot", 200), ("a", 200), ("b", 180), (None, 12)):
        for i in range(n):
            at = START + timedelta(minutes=r.randrange(40 if sensor == "hot" else 3000))
            rows.append((sensor, at, i, None if r.random() < 0.1 else r.random(), r.choice("AB")))
    return spark.createDataFrame(rows, "sensor_id string, at timestamp_ntz, n int, reading_value double, status string").cache()






def _by_time():
    return W.partitionBy("sensor_id").orderBy("at", "n")


def test_ranks(readings):
    got = ordering.rank_readings(readings, "sensor_id", "at", "reading_value", tie_break=["n"])
    by_value = W.partitionBy("sensor_id").orderBy(F.col("reading_value").desc())
    want = readings.withColumns({
        "row_num": F.row_number().over(_by_time()).cast("bigint"), "value_rank": F.rank().over(by_value).cast("bigint"),
        "value_dense_rank": F.dense_rank().over(by_value).cast("bigint"),
    })
    assert quality.same_content(got, want.select(*got.columns)).isEmpty()


def test_neighbours(readings):
    got = ordering.neighbour_readings(readings, "sensor_id", "at", "reading_value", tie_break=["n"])
    want = readings.withColumns({"lag_value": F.lag("reading_value").over(_by_time()), "lead_value": F.lead("reading_value").over(_by_time())})
    assert quality.same_content(got, want.select(*got.columns)).isEmpty()


def test_lists_hold_every_reading_in_order(readings):
    got = gold.reading_lists(readings, ["sensor_id"], "at", "day")
    assert got.groupBy("sensor_id", "slot_start").count().filter("count > 1").isEmpty()
    total = readings.filter("reading_value IS NOT NULL").count()
    assert got.agg(F.sum("reading_count")).first()[0] == total


def test_no_job_runs_while_the_plan_is_built(spark, readings):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    ordering.rank_readings(readings, "sensor_id", "at", "reading_value")
    ordering.sessions(readings, "sensor_id", "at", 1200)
    gold.reading_lists(readings, ["sensor_id"], "at")
    jobs = tracker.getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs
