"""Differences between two states of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """insert, delete, update_preimage and update_postimage rows between two versions.

    Keys are unique and not NULL in each version, so the full join pairs rows one to one.
    """
    columns = new.columns
    o, n = old.select(*columns).alias("o"), new.alias("n")
    on = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys]
    had, has = F.col(f"o.{keys[0]}").isNotNull(), F.col(f"n.{keys[0]}").isNotNull()
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))

    def image(side: str, kind: str):
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in columns], F.lit(kind).alias("_change_type"))

    rows = (
        F.when(had & ~has, F.array(image("o", "delete")))
        .when(has & ~had, F.array(image("n", "insert")))
        .otherwise(F.array(image("o", "update_preimage"), image("n", "update_postimage")))
    )
    differing = o.join(n, on, "full").filter(~(had & has & same))
    return differing.select(F.explode(rows).alias("r")).select("r.*")


def change_rows(old: DataFrame, new: DataFrame, keys: Sequence[str], append_only: bool = False) -> DataFrame:
    """INSERT and DELETE rows; an update is a DELETE and an INSERT marked as update."""
    feed = change_feed(old, new, keys)
    kind = F.col("_change_type")
    rows = feed.withColumns(
        {
            "change_action": F.when(kind.isin("insert", "update_postimage"), "INSERT").otherwise("DELETE"),
            "change_is_update": kind.startswith("update"),
        }
    ).drop("_change_type")
    if append_only:
        return rows.filter((F.col("change_action") == "INSERT") & ~F.col("change_is_update"))
    return rows


def has_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row telling whether anything differs."""
    return (
        change_feed(old, new, keys).limit(1).agg((F.count(F.lit(1)) > 0).alias("has_changes"))
    )
