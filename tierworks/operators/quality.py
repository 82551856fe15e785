"""Data tests, expectation suites, gates and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierworks.operators.joins import orphans
from tierworks.operators.silver import latest_slice
from tierworks.schemas import GATE_THRESHOLDS, THRESHOLDS


# --- tests that return the failing rows -------------------------------------------------


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def check_grain(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column combinations which occur more than once; combinations with a NULL do not count."""
    return (
        df.dropna(subset=list(columns))
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def check_unique(df: DataFrame, column: str) -> DataFrame:
    return check_grain(df, [column])


def check_accepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list with their counts; NULL is not judged."""
    return (
        df.filter(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def check_relationship(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    return orphans(child, parent, fk, pk)


def check_between(df: DataFrame, column: str, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Rows outside the bounds; either bound may be open, NULL is not judged."""
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (F.col(column) < lo)
    if hi is not None:
        bad = bad | (F.col(column) > hi)
    return df.filter(bad)


def check_sql(df: DataFrame, name: str, predicate: str, severity: str = "error") -> DataFrame:
    """Verdict row of a custom test: rows matching the predicate are failures."""
    failures = F.count_if(F.expr(predicate))
    return df.agg(failures.alias("failures")).select(
        F.lit(name).alias("test_name"),
        F.lit(severity).alias("severity"),
        "failures",
        F.when(F.col("failures") == 0, "PASS").otherwise(severity.upper()).alias("verdict"),
    )


# --- expectation suites -----------------------------------------------------------------


@dataclass(frozen=True)
class Expectation:
    """One expectation; ``kind`` is column_set, not_null, between, in_set or row_count."""

    kind: str
    column: str | None = None
    lo: float | None = None
    hi: float | None = None
    values: tuple = ()
    mostly: float = 1.0

    def name(self) -> str:
        return self.kind if self.column is None else f"{self.kind}:{self.column}"


# The Bronze suite of raw sensor readings.
SENSOR_SUITE = [
    Expectation(
        "column_set",
        values=(
            "sensor_id", "sensor_name", "equipment_name", "reading_value",
            "reading_timestamp", "status", "process_area", "_loaded_at",
        ),
    ),
    Expectation("not_null", "sensor_id"),
    Expectation("not_null", "reading_timestamp"),
    Expectation("between", "reading_value", -9999.0, 99999.0, mostly=0.95),
    Expectation("in_set", "status", values=("ACTIVE", "INACTIVE", "MAINTENANCE", "ERROR"), mostly=0.99),
    Expectation("row_count", lo=1, hi=10000000),
]


def run_suite(df: DataFrame, suite: Sequence[Expectation]) -> DataFrame:
    """One result row per expectation, all from a single pass over the data.

    Value expectations judge non-null values and need a share of at least ``mostly``.
    """
    rows = []
    n = F.count(F.lit(1))
    for e in suite:
        if e.kind == "column_set":
            observed = F.lit(float(len(set(e.values) & set(df.columns))) / max(len(e.values), 1))
        elif e.column is not None and e.column not in df.columns:
            observed = F.lit(0.0)
        elif e.kind == "not_null":
            observed = F.coalesce(F.count(e.column) / F.nullif(n, F.lit(0)), F.lit(1.0))
        elif e.kind == "row_count":
            observed = F.when(n.between(int(e.lo), int(e.hi)), 1.0).otherwise(0.0)
        else:
            good = F.col(e.column).between(e.lo, e.hi) if e.kind == "between" else F.col(e.column).isin(*e.values)
            judged = F.nullif(F.count(e.column), F.lit(0))
            observed = F.coalesce(F.count_if(good) / judged, F.lit(1.0))
        rows.append(
            F.struct(
                F.lit(e.name()).alias("expectation"),
                observed.cast("double").alias("observed"),
                F.lit(float(e.mostly)).alias("required"),
            )
        )
    results = df.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")
    return results.withColumn("success", F.col("observed") >= F.col("required"))


@dataclass
class Expected:
    """Result of ``expect``: the kept rows and, after an action on them, the counts."""

    rows: DataFrame
    counts: Observation = field(repr=False)


def _expected(
    df: DataFrame, observer: Observation | str, warn: Mapping[str, str], drop: Mapping[str, str], fail: Mapping[str, str]
) -> DataFrame:
    def holds(predicate: str) -> Column:
        return F.coalesce(F.expr(predicate), F.lit(False))

    seen = df.observe(
        observer,
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(~holds(p)).alias(n) for n, p in {**warn, **drop, **fail}.items()],
    )
    for n, p in fail.items():
        stop = F.raise_error(F.lit(f"expectation failed: {n}")).cast("boolean")
        seen = seen.filter(F.when(holds(p), F.lit(True)).otherwise(stop))
    for p in drop.values():
        seen = seen.filter(holds(p))
    return seen


def expect(
    df: DataFrame,
    warn: Mapping[str, str] | None = None,
    drop: Mapping[str, str] | None = None,
    fail: Mapping[str, str] | None = None,
) -> Expected:
    """Row expectations by SQL predicate with three actions.

    ``warn`` keeps violating rows, ``drop`` removes them, ``fail`` stops the query.
    Violations are counted while the rows pass by, without a second scan.
    """
    counts = Observation()
    return Expected(_expected(df, counts, dict(warn or {}), dict(drop or {}), dict(fail or {})), counts)


def expect_stream(
    stream: DataFrame, warn: Mapping[str, str] | None = None, drop: Mapping[str, str] | None = None,
    fail: Mapping[str, str] | None = None, name: str = "expectations",
) -> DataFrame:
    """The same on a stream; the counts of each batch are in the query's progress under ``name``."""
    return _expected(stream, name, dict(warn or {}), dict(drop or {}), dict(fail or {}))


def expectation_counts(df: DataFrame, rules: Mapping[str, tuple[str, str]]) -> DataFrame:
    """(expectation, action, violations, rows kept if dropped) as a table; rules map name to (action, predicate)."""
    n = F.count(F.lit(1))
    rows = []
    for name, (action, predicate) in rules.items():
        bad = F.count_if(~F.coalesce(F.expr(predicate), F.lit(False)))
        kept = n - bad if action == "drop" else n
        rows.append(
            F.struct(
                F.lit(name).alias("expectation"), F.lit(action).alias("action"),
                bad.alias("violations"), kept.alias("rows_kept"),
            )
        )
    return df.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")


# --- gates -------------------------------------------------------------------------------


def thresholds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(GATE_THRESHOLDS, THRESHOLDS)


def quality_metrics(df: DataFrame, required: Sequence[str], key: Sequence[str], schema: T.StructType, flag: str) -> DataFrame:
    """Null rate, completeness, quality score, duplicate rate and schema match as (metric, value)."""
    n = F.nullif(F.count(F.lit(1)), F.lit(0))
    any_null = F.lit(False)
    for c in required:
        any_null = any_null | F.col(c).isNull()
    main = df.agg(
        (F.count_if(any_null) / n).alias("null_rate"),
        (F.count_if(~any_null) / n).alias("completeness"),
        (F.count_if(F.col(flag) == "PASS") / n).alias("quality_score"),
    )
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    dupes = per_key.agg(((F.sum("_n") - F.count(F.lit(1))) / F.nullif(F.sum("_n"), F.lit(0))).alias("value"))
    match = float(set(schema.fieldNames()) <= set(df.columns))
    long = main.unpivot([], ["null_rate", "completeness", "quality_score"], "metric", "value")
    return long.unionByName(
        dupes.select(F.lit("duplicate_rate").alias("metric"), "value")
    ).unionByName(df.sparkSession.range(1).select(F.lit("schema_match").alias("metric"), F.lit(match).alias("value")))


def gold_metrics(alerts: DataFrame) -> DataFrame:
    """Highest deviation and variation of the latest day, and its CRITICAL count."""
    latest = latest_slice(alerts, "kpi_date")
    wide = latest.agg(
        F.max("stddev_reading").alias("stability_stddev"),
        F.max("coefficient_of_variation").alias("signal_cv"),
        F.count_if(F.col("alert_severity") == "CRITICAL").cast("double").alias("alert_severity_critical"),
    )
    return wide.unpivot([], ["stability_stddev", "signal_cv", "alert_severity_critical"], "metric", "value")


def evaluate_gate(metrics: DataFrame, limits: DataFrame) -> DataFrame:
    """Verdict per metric: PASS inside the limits, otherwise the limit's severity."""
    inside = F.col("value").between(F.col("threshold_min"), F.col("threshold_max"))
    return metrics.join(limits, "metric").withColumn(
        "verdict", F.when(inside, F.lit("PASS")).otherwise(F.col("severity"))
    )


def gate_decisions(bronze: DataFrame, silver: DataFrame, alerts: DataFrame, max_fail_pct: float = 20.0) -> DataFrame:
    """Pass or fail of the three gates from null rows, failed share and critical alerts."""
    nulls = F.col("sensor_id").isNull() | F.col("reading_timestamp").isNull() | F.col("reading_value").isNull()
    share = F.count_if(F.col("quality_flag") == "FAIL") * 100.0 / F.nullif(F.count(F.lit(1)), F.lit(0))
    critical = F.count_if(F.col("alert_severity") == "CRITICAL")

    def decision(df: DataFrame, gate: str, measure: Column, limit: float) -> DataFrame:
        value = F.coalesce(measure.cast("double"), F.lit(0.0))
        return df.agg(value.alias("measure")).select(
            F.lit(gate).alias("gate"),
            "measure",
            F.when(F.col("measure") <= limit, "PASS").otherwise("FAIL").alias("decision"),
        )

    return (
        decision(bronze, "bronze", F.count_if(nulls), 0.0)
        .unionByName(decision(silver, "silver", share, max_fail_pct))
        .unionByName(decision(latest_slice(alerts, "kpi_date"), "gold", critical, 0.0))
    )


# --- reconciliation ----------------------------------------------------------------------


def side_by_side(**counts: DataFrame) -> DataFrame:
    """One row of row counts of several tables.

    Each table gives a one-row aggregate; they are stacked and summed, so nothing is joined.
    """
    parts = []
    for name, df in counts.items():
        n = df.agg(F.count(F.lit(1)).alias("_n"))
        parts.append(n.select(*[(F.col("_n") if c == name else F.lit(0)).cast("bigint").alias(c) for c in counts]))
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked.agg(*[F.sum(c).alias(c) for c in counts])


def reconcile(source: DataFrame, bronze: DataFrame, silver: DataFrame, quarantine: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts of every layer and the verdict that each Bronze row is accounted for.

    Bronze rows are good rows, quarantined rows, or further copies of a key.
    """
    counts = side_by_side(
        source_rows=source, bronze_rows=bronze, silver_rows=silver, quarantined_rows=quarantine,
        distinct_keys=bronze.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies")),
    )
    named = counts.withColumn("duplicate_rows", F.col("bronze_rows") - F.col("distinct_keys")).drop("distinct_keys")
    explained = F.col("silver_rows") + F.col("quarantined_rows") + F.col("duplicate_rows")
    return named.withColumns(
        {
            "source_matches": F.col("source_rows") == F.col("bronze_rows"),
            "rows_explained": F.col("bronze_rows") == explained,
        }
    ).withColumn("verdict", F.when(F.col("source_matches") & F.col("rows_explained"), "PASS").otherwise("FAIL"))


def freshness(df: DataFrame, loaded_at: str, as_of: str, warn_hours: int = 24, error_hours: int = 48) -> DataFrame:
    """Age of the newest load against two limits."""
    newest = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    now = F.lit(as_of).cast("timestamp_ntz")

    def older(hours: int) -> Column:
        return F.col("max_loaded_at") < now - F.expr(f"INTERVAL {hours} HOURS")

    missing = F.col("max_loaded_at").isNull()
    return newest.withColumn(
        "freshness", F.when(missing | older(error_hours), "error").when(older(warn_hours), "warn").otherwise("pass")
    )


def same_content(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows by which two results differ, with the number of copies on each side; empty means equal.

    Rows are counted per distinct content, so copies are compared too.
    """
    columns = a.columns
    counted = (
        a.withColumn("_side", F.lit(1))
        .unionByName(b.select(*columns).withColumn("_side", F.lit(2)))
        .groupBy(*columns)
        .agg(
            F.count_if(F.col("_side") == 1).alias("n_first"),
            F.count_if(F.col("_side") == 2).alias("n_second"),
        )
    )
    return counted.filter(F.col("n_first") != F.col("n_second"))


