"""Hashed keys and row fingerprints."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierworks.schemas import NULL_TOKEN


def _text(c: str | Column) -> Column:
    column = F.col(c) if isinstance(c, str) else c
    return F.coalesce(column.cast("string"), F.lit(NULL_TOKEN))


def surrogate_key(*parts: str | Column) -> Column:
    """MD5 of the parts as text, joined by '-'; NULL has its own token, so it never collides."""
    return F.md5(F.concat_ws("-", *[_text(p) for p in parts]))


def row_hash(columns: Iterable[str | Column]) -> Column:
    """MD5 of tracked columns joined by '|', NULL safe."""
    return F.md5(F.concat_ws("|", *[_text(c) for c in columns]))


def row_number_value(columns: Iterable[str | Column]) -> Column:
    """32-bit number from the row fingerprint, for sums that do not depend on row order."""
    return F.conv(F.substring(row_hash(columns), 1, 8), 16, 10).cast("bigint")
