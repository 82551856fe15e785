"""Explicit schemas and the limits used by gates and alerts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_S, _D, _I, _L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()
_B, _DATE, _TS, _NTZ = T.BooleanType(), T.DateType(), T.TimestampType(), T.TimestampNTZType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


SENSOR_READINGS = _struct(
    sensor_id=_S, sensor_name=_S, equipment_name=_S, reading_value=_D,
    reading_timestamp=_NTZ, status=_S, process_area=_S, _loaded_at=_NTZ,
)
ORDERS = _struct(
    order_id=_S, order_type=_S, equipment_id=_S, material_id=_S, order_date=_DATE,
    order_quantity=_I, net_value=_D, status=_S, priority=_S, created_by=_S, _loaded_at=_NTZ,
)
EQUIPMENT = _struct(
    equipment_id=_S, equipment_name=_S, equipment_type=_S, location=_S,
    install_date=_DATE, manufacturer=_S, status=_S, _loaded_at=_NTZ,
)
MATERIALS = _struct(
    material_id=_S, material_name=_S, material_type=_S, unit_of_measure=_S,
    plant_code=_S, _loaded_at=_NTZ,
)
VENDORS = _struct(
    vendor_id=_S, vendor_name=_S, vendor_type=_S, country=_S, payment_terms=_S, _loaded_at=_NTZ,
)
THRESHOLDS = _struct(
    gate_name=_S, metric=_S, threshold_min=_D, threshold_max=_D, severity=_S,
)
STATUS_CODES = _struct(
    status_code=_S, status_name=_S, is_operational=_B, description=_S,
)
RUN_LOG = _struct(
    log_id=_L, procedure_name=_S, status=_S, row_count=_L, executed_at=_NTZ, error_message=_S,
)
IOT_PAYLOAD = T.StructType([
    T.StructField("sensor_id", _S),
    T.StructField("status", _S),
    T.StructField("readings", T.ArrayType(_struct(value=_D, unit=_S, quality=_S))),
    T.StructField("metadata", _struct(location=_S, rig=_S)),
    T.StructField("tags", T.ArrayType(_S)),
])

# Layout of the driver's test tables.
TABLES = {
    "region": _struct(r_regionkey=_I, r_name=_S),
    "nation": _struct(n_nationkey=_I, n_name=_S, n_regionkey=_I),
    "customer": _struct(c_custkey=_L, c_name=_S, c_nationkey=_I, c_acctbal=_D, c_mktsegment=_S),
    "supplier": _struct(s_suppkey=_L, s_name=_S, s_nationkey=_I, s_acctbal=_D),
    "part": _struct(p_partkey=_L, p_name=_S, p_brand=_S, p_type=_S, p_size=_I, p_retailprice=_D),
    "orders": _struct(
        o_orderkey=_L, o_custkey=_L, o_orderstatus=_S, o_totalprice=_D, o_orderdate=_NTZ,
        o_orderpriority=_S,
    ),
    "lineitem": _struct(
        l_orderkey=_L, l_partkey=_L, l_suppkey=_L, l_linenumber=_I, l_quantity=_D,
        l_extendedprice=_D, l_discount=_D, l_tax=_D, l_returnflag=_S, l_linestatus=_S,
        l_shipdate=_NTZ,
    ),
    "events": _struct(event_id=_L, ts=_NTZ, user_id=_L, event_type=_S, value=_D, props=_S),
}


@dataclass(frozen=True)
class Band:
    """Inclusive value band; ``fail_*`` marks the physically possible range."""

    lo: float
    hi: float
    fail_lo: float | None = None
    fail_hi: float | None = None


# Default value bands of the sensor gate.
DEFAULT_BAND = Band(-999.0, 9999.0)
LAB_BAND = Band(0.0, 200.0)
SUITE_BAND = Band(-9999.0, 99999.0)


@dataclass(frozen=True)
class AlertLimits:
    """Limits of the statistical process control alerts."""

    stable_below: float = 5.0
    unstable_above: float = 25.0
    noisy_cv: float = 0.3
    very_noisy_cv: float = 0.5
    outlier_sigmas: float = 2.0
    range_sigmas: float = 1.0
    degrading_ratio: float = 1.5
    increasing_ratio: float = 1.1
    improving_ratio: float = 0.9
    spike_sigmas: float = 2.0


# Thresholds of the three gates.
GATE_THRESHOLDS = [
    ("bronze_gate", "null_rate", 0.0, 0.05, "FAIL"),
    ("bronze_gate", "schema_match", 1.0, 1.0, "FAIL"),
    ("silver_gate", "quality_score", 0.95, 1.0, "WARN"),
    ("silver_gate", "duplicate_rate", 0.0, 0.01, "FAIL"),
    ("gold_gate", "stability_stddev", 0.0, 25.0, "WARN"),
    ("gold_gate", "signal_cv", 0.0, 0.3, "WARN"),
    ("gold_gate", "alert_severity_critical", 0.0, 0.0, "BLOCK"),
    ("gold_gate", "completeness", 0.99, 1.0, "WARN"),
]

# Fixed value: text standing for NULL inside hashed keys.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"

# Fixed value: end of an open validity interval.
OPEN_END = "9999-12-31 00:00:00"
