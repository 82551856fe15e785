"""Streaming transformations; each one works on any DataFrame with the named columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tierworks.functions import flags
from tierworks.operators.spc import (
    alert_severity, has_outlier, limit_columns, range_violated, signal_quality, spike_status, stability_level, variation,
    volatility_trend,
)
from tierworks.schemas import AlertLimits, Band

EVENT_TIME = "event_time"


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def with_event_time(stream: DataFrame, ts: str, delay: str | None = None) -> DataFrame:
    """Zoned copy of a zone-less time, as watermarks need, with an optional lateness bound."""
    timed = stream.withColumn(EVENT_TIME, F.col(ts).cast("timestamp"))
    return timed.withWatermark(EVENT_TIME, delay) if delay else timed


def flag_stream(stream: DataFrame, band: Band) -> DataFrame:
    return stream.withColumns(
        {"quality_flag": flags.quality_flag("reading_value", band), "is_valid": flags.is_valid("reading_value", band)}
    )


def _window_bounds(df: DataFrame) -> DataFrame:
    bounds = {
        "window_start": F.col("window.start").cast("timestamp_ntz"),
        "window_end": F.col("window.end").cast("timestamp_ntz"),
    }
    return df.withColumns(bounds).drop("window")


def hourly_stream(stream: DataFrame, ts: str, watermark: str | None = None, width: str = "1 hour") -> DataFrame:
    """Average and count per sensor and tumbling window; the watermark bounds the state."""
    timed = with_event_time(stream, ts, watermark)
    windows = timed.groupBy("sensor_id", F.window(EVENT_TIME, width)).agg(
        F.avg("reading_value").alias("avg_reading"), F.count(F.lit(1)).alias("n_readings")
    )
    return _window_bounds(windows)


def dedup_stream(stream: DataFrame, ts: str, keys: Sequence[str], delay: str) -> DataFrame:
    """First row per key; keys are forgotten once the watermark passes."""
    return with_event_time(stream, ts, delay).dropDuplicatesWithinWatermark(list(keys)).drop(EVENT_TIME)


def session_stream(stream: DataFrame, key: str, ts: str, gap: str, watermark: str | None = None) -> DataFrame:
    """Sessions per key closed by a gap."""
    timed = with_event_time(stream, ts, watermark)
    sessions = timed.groupBy(key, F.session_window(EVENT_TIME, gap).alias("window")).agg(
        F.count(F.lit(1)).alias("n_events")
    )
    return _window_bounds(sessions)


def stream_alerts(stream: DataFrame, ts: str, limits: AlertLimits = AlertLimits(), width: str = "1 day", watermark: str = "2 hours") -> DataFrame:
    """Stability, signal quality and severity per closed window, from deviation and variation."""
    lim = limit_columns(limits)
    timed = with_event_time(stream, ts, watermark)
    stats = timed.groupBy("sensor_id", F.window(EVENT_TIME, width)).agg(
        F.avg("reading_value").alias("avg_reading"),
        F.stddev("reading_value").alias("stddev_reading"),
        F.max("reading_value").alias("max_reading"),
        F.count(F.lit(1)).alias("n_readings"),
    )
    unstable = F.col("stddev_reading") > lim["unstable_above"]
    outlier = F.col("max_reading") > F.col("avg_reading") + lim["outlier_sigmas"] * F.col("stddev_reading")
    severity = flags.first_match(
        [(unstable & (variation() > lim["noisy_cv"]), "CRITICAL"), (unstable | outlier, "WARNING")], "OK"
    )
    return _window_bounds(
        stats.withColumns(
            {"stability_level": stability_level(lim), "signal_quality": signal_quality(lim), "alert_severity": severity}
        )
    )


class PreviousWindow(StatefulProcessor):
    """Per sensor: each closed window with the figures of the one closed before it, which are all that is kept."""

    FIGURES = ("avg_reading", "stddev_reading", "max_reading")

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", "avg_reading double, stddev_reading double, max_reading double")

    def handleInputRows(self, key, rows, timer_values):
        before = self.last.get() or (None, None, None)
        for row in sorted(rows, key=lambda r: r.window_start):
            yield Row(**row.asDict(), prev_avg=before[0], prev_stddev=before[1], prev_max=before[2])
            before = tuple(row[c] for c in self.FIGURES)
        self.last.update(before)

    def close(self) -> None:
        pass


_CLOSED = (
    "sensor_id string, window_start timestamp_ntz, window_end timestamp_ntz, avg_reading double, stddev_reading double, "
    "min_reading double, max_reading double, n_readings bigint"
)


def alarm_stream(
    stream: DataFrame, ts: str, limits: AlertLimits = AlertLimits(), width: str = "1 day", watermark: str = "2 hours"
) -> DataFrame:
    """The alert classes of ``spc.sensor_alerts`` for every window the watermark has closed, trend and spike included.

    Windows are aggregated by Spark; the state behind them sees one row per sensor and closed window and keeps the last
    one. Windows of a sensor close in order of time, also when their readings came out of order. Start it with
    ``runs.run_append(..., keyed_state=True)``.
    """
    timed = with_event_time(stream, ts, watermark)
    stats = timed.groupBy("sensor_id", F.window(EVENT_TIME, width)).agg(
        F.avg("reading_value").alias("avg_reading"), F.stddev("reading_value").alias("stddev_reading"),
        F.min("reading_value").alias("min_reading"), F.max("reading_value").alias("max_reading"),
        F.count(F.lit(1)).alias("n_readings"),
    )
    closed = _window_bounds(stats).select(*T.StructType.fromDDL(_CLOSED).names)
    with_previous = closed.groupBy("sensor_id").transformWithState(
        PreviousWindow(), f"{_CLOSED}, prev_avg double, prev_stddev double, prev_max double", "Append", "None"
    )
    lim = limit_columns(limits)
    return with_previous.withColumns({
        "stability_level": stability_level(lim), "signal_quality": signal_quality(lim), "has_outlier": has_outlier(lim),
        "range_violated": range_violated(lim), "volatility_trend": volatility_trend(lim),
        "spike_status": spike_status(lim), "alert_severity": alert_severity(lim),
    })


def enrich_stream(stream: DataFrame, static: DataFrame, on: str) -> DataFrame:
    """Stream joined to a static table on one key; unknown keys are kept."""
    return stream.join(static, on, "left")
