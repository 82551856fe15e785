"""Ranking, neighbours, running averages and duplicate removal on readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierworks.functions.timeparts import boundary_diff
from tierworks.operators import sequences as seq


def rank_readings(
    df: DataFrame, key: str, ts: str, value: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Position by time (then ``tie_break``) and rank by falling value of each reading of a sensor."""
    numbered = seq.with_row_number(df, [key], [ts, *tie_break], seq.by_time(ts), "row_num")
    falling = seq.by_value(value, descending=True)
    return seq.with_ranks(numbered, [key], value, falling, "value_rank", "value_dense_rank")


def neighbour_readings(df: DataFrame, key: str, ts: str, value: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """Values before and after each reading by time, then ``tie_break``."""
    order = [ts, *tie_break]
    return seq.with_neighbours(df, [key], order, seq.by_time(ts), {"lag_value": value}, {"lead_value": value})


def running_avg_range(df: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """Average up to this time; readings of the same time share it."""
    return seq.with_running(df, [key], [ts], seq.by_time(ts), value, avg="running_avg", share_ties=True)


def running_avg_rows(
    df: DataFrame, key: str, order: Sequence[str], ts: str, value: str
) -> DataFrame:
    """Average up to this row in the given unique order."""
    return seq.with_running(df, [key], order, seq.by_time(ts), value, avg="running_avg", count="running_count")


def latest_per_key(df: DataFrame, key: str, ts: str, tie_break: Sequence[Column] = ()) -> DataFrame:
    """Latest row per key with minutes since the row before it.

    Two rows per key are enough, so at most two leave each task.
    """
    order = [F.col(ts).desc(), *tie_break]
    top = seq.first_rows(df, [key], order, n=2, rank="_rn")
    w = W.partitionBy(key).orderBy("_rn")
    return (
        top.withColumn("_previous", F.lead(ts).over(w))
        .filter(F.col("_rn") == 1)
        .withColumn("minutes_since_last_run", boundary_diff("minute", "_previous", ts))
        .drop("_rn", "_previous")
    )


def drop_dupes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, whichever Spark meets first."""
    return df.dropDuplicates(list(keys))


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in ``order``, e.g. latest load time first."""
    return seq.first_rows(df, keys, order)


def duplicate_stats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys, removed rows and duplicate rate."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total, distinct = F.sum("_n"), F.count(F.lit(1))
    return per_key.agg(total.alias("total_rows"), distinct.alias("distinct_keys")).withColumns(
        {
            "duplicates_removed": F.col("total_rows") - F.col("distinct_keys"),
            "duplicate_rate": (F.col("total_rows") - F.col("distinct_keys"))
            / F.nullif(F.col("total_rows"), F.lit(0)),
        }
    )


def late_rows(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Rows older than the newest event time minus ``delay``."""
    newest = df.agg(F.max(ts) - F.expr(f"INTERVAL {delay}")).scalar()
    return df.filter(F.col(ts) < newest)


def sessions(
    df: DataFrame, key: str, ts: str, gap_seconds: int, max_rate: float | None = None
) -> DataFrame:
    """Sessions per key: a new one starts after a gap of at least ``gap_seconds``.

    ``max_rate`` marks sessions above that many events per minute as bots.
    """
    gap = F.col(ts) >= F.col("_prev") + F.expr(f"INTERVAL {gap_seconds} SECONDS")
    steps = seq.Ordered.of(df.select(key, ts), [key], [ts], seq.by_time(ts)).neighbours({"_prev": ts}, {})
    marked = steps.with_columns({"_start": F.when(F.col("_prev").isNull() | gap, 1).otherwise(0)})
    numbered = marked.running("_start", total="session_no").frame()
    out = numbered.groupBy(key, F.col("session_no").cast("bigint").alias("session_no")).agg(
        F.min(ts).alias("session_start"), F.max(ts).alias("session_last"), F.count(F.lit(1)).alias("n_events")
    )
    if max_rate is None:
        return out
    minutes = F.greatest(boundary_diff("second", "session_start", "session_last"), F.lit(1)) / 60.0
    return out.withColumn("is_bot", F.col("n_events") / minutes > max_rate)
