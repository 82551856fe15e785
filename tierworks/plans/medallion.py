"""The end-to-end run: Bronze, Silver and Gold with a gate after each layer."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierworks.operators import gold, merge, operations, silver, spc
from tierworks.operators.sequences import first_rows
from tierworks.operators.silver import latest_slice
from tierworks.schemas import DEFAULT_BAND, AlertLimits, Band
from tierworks.sources import sinks, staging


@dataclass(frozen=True)
class RunConfig:
    root: str
    at: str
    band: Band = DEFAULT_BAND
    limits: AlertLimits = AlertLimits()
    required: Sequence[str] = ("sensor_id", "reading_timestamp", "reading_value")
    max_fail_pct: float = 20.0
    max_critical: int = 0
    duplicate_keys: Sequence[str] = ("sensor_id", "reading_timestamp")


@dataclass
class RunResult:
    """Gate decisions of a run and where its tables are."""

    gates: list[tuple[str, str, float]] = field(default_factory=list)

    @property
    def status(self) -> str:
        return "SUCCESS" if all(d == "PASS" for _, d, _ in self.gates) else "PARTIAL"


def _measure(df: DataFrame, value) -> float:
    """One number of a table; the only thing a gate brings to the driver."""
    return float(df.agg(value.cast("double")).first()[0] or 0.0)


def run_medallion(bronze: DataFrame, cfg: RunConfig) -> RunResult:
    """Publish each layer once, decide its gate on what was published, stop at a failed gate.

    Rows the gates reject go to ``quarantine``.  Gold is backed up before it is
    replaced; when its gate fails, readers use the backup (``read_gold``).
    """
    spark, result = bronze.sparkSession, RunResult()
    path = {name: f"{cfg.root}/{name}" for name in ("bronze", "silver", "kpi", "alerts", "alerts_backup")}
    quarantine, log = f"{cfg.root}/quarantine", f"{cfg.root}/run_log"

    def decide(gate: str, measure: float, limit: float) -> bool:
        passed = measure <= limit
        result.gates.append((gate, "PASS" if passed else "FAIL", measure))
        return passed

    def finish(table: DataFrame) -> RunResult:
        gates = [F.struct(F.lit(g).alias("gate"), F.lit(d).alias("decision"), F.lit(m).alias("measure")) for g, d, m in result.gates]
        rows = spark.range(1).select(F.inline(F.array(*gates)))
        sinks.publish(rows.withColumn("run_at", F.lit(cfg.at).cast("timestamp_ntz")).coalesce(1), f"{cfg.root}/gates", mode="append")
        status = "SUCCESS" if result.status == "SUCCESS" else "FAILURE"
        row = operations.audit_row(table, "MEDALLION_RUN", status, cfg.at)
        sinks.publish(row.coalesce(1), log, mode="append")
        return result

    def skip(*gates: str) -> None:
        result.gates.extend((gate, "SKIP", 0.0) for gate in gates)

    sinks.publish(bronze, path["bronze"])
    raw = spark.read.parquet(path["bronze"])
    incomplete = F.lit(False)
    for column in cfg.required:
        incomplete = incomplete | F.col(column).isNull()
    empty = raw.isEmpty()
    if not decide("bronze", float("inf") if empty else _measure(raw, F.count_if(incomplete)), 0.0):
        bad = raw.filter(incomplete).withColumn("quarantine_reason", F.lit("required column missing"))
        sinks.publish(bad, f"{quarantine}/bronze")
        skip("silver", "gold")
        return finish(raw)

    cleaned = silver.clean_sensors(staging.stage_sensor(raw), cfg.band)
    newest = [F.col("loaded_at").desc_nulls_last(), F.col("reading_value").desc_nulls_last(), F.col("status").asc()]
    sinks.publish(first_rows(cleaned, list(cfg.duplicate_keys), newest), path["silver"])
    clean = spark.read.parquet(path["silver"])
    good, bad = merge.split_by_flag(clean, {"missing value": F.col("reading_value").isNull()})
    sinks.publish(bad, f"{quarantine}/silver")
    share = F.count_if(F.col("quality_flag") == "FAIL") * 100.0 / F.nullif(F.count(F.lit(1)), F.lit(0))
    if not decide("silver", _measure(clean, share), cfg.max_fail_pct):
        skip("gold")
        return finish(clean)

    if sinks.read_or_none(spark, path["alerts"]) is not None:
        sinks.backup(spark, path["alerts"], path["alerts_backup"])
    sinks.publish(gold.daily_sensor_kpi(good), path["kpi"])
    sinks.publish(spc.sensor_alerts(spark.read.parquet(path["kpi"]), cfg.limits), path["alerts"])
    published = spark.read.parquet(path["alerts"])
    critical = F.count_if(F.col("alert_severity") == "CRITICAL")
    decide("gold", _measure(latest_slice(published, "kpi_date"), critical), cfg.max_critical)
    return finish(published)


def read_gates(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """The gate decisions of the run at ``cfg.at``, from the run table."""
    rows = spark.read.parquet(f"{cfg.root}/gates").filter(F.col("run_at") == F.lit(cfg.at).cast("timestamp_ntz"))
    return rows.select("gate", "decision", "measure")


def read_gold(spark: SparkSession, cfg: RunConfig, result: RunResult) -> DataFrame:
    """Alerts of this run, or the last good ones marked ``_is_cached``."""
    return sinks.read_last_good(
        spark, f"{cfg.root}/alerts", f"{cfg.root}/alerts_backup", result.status == "SUCCESS"
    )
