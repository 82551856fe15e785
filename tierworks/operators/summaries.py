"""Mergeable summaries of daily KPIs: new readings enter without the old ones being read again.

A summary is a row per sensor and day: counts, mean and sum of squared deviations, extremes, and a quantile sketch (KLL)
as a column. Two summaries of different readings give the summary of both. Counts and extremes are exact, mean and
deviation exact up to rounding of doubles; median and p95 of more values than the sketch holds are within its rank error
(about 2.3 / k^0.9, a quarter of a percent as set), where ``gold.daily_sensor_kpi`` is exact and reads everything.

``last_batch`` makes merges safe to repeat: batches have rising numbers, and a row takes only those above its own.

Behaviour: NULL keys equal each other. Readings without a value count, but have no part in the measures. An empty batch
changes nothing; an empty target takes the batch as it is. Summaries must be unique in their keys, as grouping makes them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierworks.functions.keys import surrogate_key
from tierworks.operators.gold import KPI_KEYS, count_where, kpi_rows
from tierworks.operators.skew import same_keys
from tierworks.sources import sinks

SKETCH_SIZE = 2048


def kpi_summaries(silver: DataFrame, batch: int = 0, require_valid: bool = True, size: int = SKETCH_SIZE) -> DataFrame:
    """The summary of the Silver rows given, from one pass that is combined before its shuffle."""
    value = F.col("reading_value").cast("double")
    return kpi_rows(silver, require_valid).groupBy(*KPI_KEYS).agg(
        F.count(F.lit(1)).alias("total_readings"),
        count_where(F.col("quality_flag") == "WARN").alias("warn_count"),
        F.count(value).alias("n_values"),
        F.avg(value).alias("mean"),
        (F.var_pop(value) * F.count(value)).alias("squares"),
        F.min(value).alias("min_reading"),
        F.max(value).alias("max_reading"),
        F.kll_sketch_agg_double(value, size).alias("sketch"),
        F.lit(batch).cast("bigint").alias("last_batch"),
    )


def _either(t: Column, s: Column, both: Column) -> Column:
    """``both`` where both sides have a value, else the one that has."""
    return F.when(t.isNull(), s).when(s.isNull(), t).otherwise(both)


def merge_summaries(target: DataFrame, fresh: DataFrame) -> DataFrame:
    """One summary of both; rows of ``target`` that have seen the batch of ``fresh`` stay as they are."""
    joined = target.withColumn("_here", F.lit(True)).alias("t").join(fresh.alias("s"), same_keys("t", "s", KPI_KEYS), "full")
    here = F.col("t._here").isNotNull()
    seen = F.coalesce(here & (F.col("s.last_batch") <= F.col("t.last_batch")), F.lit(False))

    def of(name: str) -> tuple[Column, Column]:
        return F.col(f"t.{name}"), F.when(~seen, F.col(f"s.{name}"))

    n, m = (F.coalesce(x, F.lit(0)) for x in of("n_values"))
    (mean, other), (squares, more) = of("mean"), of("squares")
    total = F.nullif(n + m, F.lit(0))
    merged = {
        "mean": _either(mean, other, mean + (other - mean) * m / total),
        "squares": _either(squares, more, squares + more + (other - mean) * (other - mean) * n * m / total),
        "min_reading": F.least(*of("min_reading")),
        "max_reading": F.greatest(*of("max_reading")),
        "sketch": _either(*of("sketch"), F.kll_sketch_merge_double(*of("sketch"))),
        "last_batch": F.greatest(*of("last_batch")),
    }
    for name in ("total_readings", "warn_count", "n_values"):
        t, s = of(name)
        merged[name] = F.coalesce(t, F.lit(0)) + F.coalesce(s, F.lit(0))
    keys = [F.when(here, F.col(f"t.{k}")).otherwise(F.col(f"s.{k}")).alias(k) for k in KPI_KEYS]
    return joined.select(*keys, *[merged[c].alias(c) for c in target.columns if c not in KPI_KEYS])


def merge_stored_summaries(fresh: DataFrame, path: str) -> None:
    """``merge_summaries`` into a table laid out by day, of which only the days of the batch are read and replaced.

    The merged days are staged beside the table and then replace the old ones. A merge that was broken off is repeated
    with the same batch: days which it had replaced already have seen it. Batches come one after the other.
    """
    spark = fresh.sparkSession
    table = sinks.read_or_none(spark, path)
    if table is not None:
        touched = fresh.select("kpi_date").distinct()
        current = table.select(*fresh.columns).alias("l").join(touched.alias("r"), same_keys("l", "r", ["kpi_date"]), "left_semi")
        fresh = merge_summaries(current, fresh)
    staged = f"{path}_staged-{uuid.uuid4().hex}"
    sinks.publish(fresh, staged)
    sinks.overwrite_partitions(spark.read.schema(fresh.schema).parquet(staged), path, ["kpi_date"])


def kpi_of_summaries(summaries: DataFrame) -> DataFrame:
    """The daily KPIs that a table of summaries stands for; columns as those of ``gold.daily_sensor_kpi``."""
    n = F.col("n_values")

    def quantile(rank: float) -> Column:
        return F.when(n > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(rank)))

    return summaries.select(
        surrogate_key("sensor_id", "kpi_date").alias("kpi_sk"), *KPI_KEYS, "total_readings",
        F.col("mean").alias("avg_reading"), "min_reading", "max_reading",
        F.when(n > 1, F.sqrt(F.col("squares") / (n - 1))).alias("stddev_reading"),
        quantile(0.5).alias("median_reading"), quantile(0.95).alias("p95_reading"), "warn_count",
    )
