"""Quality flags, gates and classifications as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierworks.schemas import Band


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_match(rules: Sequence[tuple[Column, object]], default: object) -> Column:
    """CASE over ordered (condition, value) rules; a NULL condition does not match."""
    (condition, value), *rest = rules
    case = F.when(condition, value)
    for condition, value in rest:
        case = case.when(condition, value)
    return case.otherwise(default)


def outside(value: str | Column, lo: float, hi: float) -> Column:
    value = _col(value)
    return (value < F.lit(lo)) | (value > F.lit(hi))


def quality_flag(value: str | Column, band: Band) -> Column:
    """FAIL for NULL or impossible values, WARN outside the band, PASS inside it."""
    value = _col(value)
    rules = [(value.isNull(), "FAIL")]
    if band.fail_lo is not None and band.fail_hi is not None:
        rules.append((outside(value, band.fail_lo, band.fail_hi), "FAIL"))
    rules.append((outside(value, band.lo, band.hi), "WARN"))
    return first_match(rules, "PASS")


def is_valid(value: str | Column, band: Band) -> Column:
    value = _col(value)
    return F.coalesce(value.between(band.lo, band.hi), F.lit(False))


def bronze_gate(required: Sequence[str]) -> Column:
    """FAIL as soon as one required column is NULL."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])
    return F.when(missing, "FAIL").otherwise("PASS")


def gold_gate(severity: str | Column) -> Column:
    severity = _col(severity)
    return first_match([(severity == "CRITICAL", "BLOCK"), (severity == "WARNING", "REVIEW")], "APPROVE")


def risk_gate(rpn: str | Column, threshold: float = 100) -> Column:
    """BLOCK when severity x occurrence x detection exceeds the threshold."""
    return F.when(_col(rpn) > threshold, "BLOCK").otherwise("APPROVE")


def orders_flag(matched: Column) -> Column:
    """Order rules, first match wins; ``matched`` tells whether the equipment is known."""
    return first_match(
        [
            (F.col("order_date").isNull(), "FAIL"),
            (F.col("equipment_id").isNull(), "FAIL"),
            (F.col("status") == "CANCELLED", "FAIL"),
            (~matched, "WARN"),
            (F.col("priority").isNull(), "WARN"),
        ],
        "PASS",
    )


def quantity_flag(quantity: str = "order_quantity", net_value: str = "net_value") -> Column:
    return first_match([(F.col(quantity) <= 0, "FAIL"), (F.col(net_value).isNull(), "WARN")], "PASS")


def lifecycle_stage(
    install_date: str | Column,
    status: str | Column,
    as_of: str,
    aging_years: int = 10,
    status_first: bool = False,
) -> Column:
    """AGING by calendar years, RETIRED by status; ``status_first`` swaps the order of the rules."""
    age = F.year(F.lit(as_of).cast("date")) - F.year(_col(install_date))
    rules = [(age > aging_years, "AGING"), (_col(status) == "DECOMMISSIONED", "RETIRED")]
    return first_match(rules[::-1] if status_first else rules, "ACTIVE")


def order_tier(net_value: str | Column = "net_value") -> Column:
    value = _col(net_value)
    return first_match([(value > 10000, "HIGH_VALUE"), (value > 1000, "MEDIUM_VALUE")], "LOW_VALUE")


def validation_status(rule: Column) -> Column:
    """VALID where the rule holds, INVALID where it fails or is unknown."""
    return F.when(rule, "VALID").otherwise("INVALID")


def label_lookup(value: Column, labels: Mapping[str, object], default: Column | None = None) -> Column:
    """Constant map lookup as a CASE; unknown values give ``default``."""
    rules = [(value == key, label) for key, label in labels.items()]
    return first_match(rules, F.lit(None) if default is None else default)
