"""Keys that may be NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """NULL-safe equality of keys between two aliases."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return condition
