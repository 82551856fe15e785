"""Merges of a batch of rows into a table, DataFrame in and DataFrame out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierworks.operators.gold import daily_sensor_kpi
from tierworks.operators.sequences import first_rows
from tierworks.operators.skew import same_keys


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; the query fails if a key occurs twice (NULL is a value here)."""
    counted = df.withColumn("_n", F.count(F.lit(1)).over(W.partitionBy(*keys)))
    key_text = F.concat_ws(",", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    clash = F.raise_error(F.concat(F.lit("duplicate merge key: "), key_text)).cast("boolean")
    return counted.filter(F.when(F.col("_n") == 1, F.lit(True)).otherwise(clash)).drop("_n")


def _without(rows: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``others``; NULL keys are equal to each other."""
    return rows.alias("l").join(others.select(*keys).alias("r"), same_keys("l", "r", keys), "left_anti")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    delete_when: Column | None = None,
    strict: bool = True,
) -> DataFrame:
    """Update all columns on a match, insert otherwise; NULL keys match each other.

    ``delete_when`` is a condition on source rows whose keys leave the table.
    Source keys must be unique (``strict`` fails on a repeated key).
    """
    rows = require_unique(source, keys) if strict else source
    arriving = rows if delete_when is None else rows.filter(~F.coalesce(delete_when, F.lit(False)))
    return _without(target, source, keys).unionByName(arriving.select(*target.columns))


def merge_when(
    target: DataFrame, source: DataFrame, keys: Sequence[str], changed: Sequence[str], condition: Column | None = None
) -> DataFrame:
    """Update only the ``changed`` columns, where ``condition`` holds; insert new keys.

    ``condition`` is the caller's own test on the aliases ``t`` and ``s``; without one a
    column is updated where it differs.  NULL keys match each other.
    """
    t = target.withColumn("_here", F.lit(True)).alias("t")
    s = source.withColumn("_here", F.lit(True)).alias("s")
    joined = t.join(s, same_keys("t", "s", keys), "full")
    in_target, in_source = F.col("t._here").isNotNull(), F.col("s._here").isNotNull()
    columns = []
    for c in target.columns:
        mine, theirs = F.col(f"t.{c}"), F.col(f"s.{c}")
        if c in changed:
            # A plain comparison: an unknown value on either side is not a change.
            wanted = mine != theirs if condition is None else condition
            update = in_target & in_source & F.coalesce(wanted, F.lit(False))
            columns.append(F.when(~in_target | update, theirs).otherwise(mine).alias(c))
        else:
            columns.append(F.when(in_target, mine).otherwise(theirs).alias(c))
    return joined.select(*columns)


def merge_insert_new(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """Append source rows whose key is not in the target; running it twice adds nothing.

    Of several source rows with one key the first by ``order`` enters.
    """
    first = first_rows(source, keys, list(order) or [F.col(c) for c in target.columns])
    return target.unionByName(_without(first, target, keys).select(*target.columns))


def merge_kpi(target: DataFrame, silver: DataFrame) -> DataFrame:
    """Recompute the KPI of the silver rows given and merge it by key."""
    fresh = daily_sensor_kpi(silver)
    return merge_upsert(target, fresh.select(*target.columns), ["kpi_sk"], strict=False)


def incremental_new(source: DataFrame, target: DataFrame, ts: str, lookback: str | None = None) -> DataFrame:
    """Source rows newer than the target's high-water mark; an empty target takes everything."""
    mark = F.coalesce(F.max(ts), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    if lookback:
        mark = mark - F.expr(f"INTERVAL {lookback}")
    return source.filter(F.col(ts) > target.agg(mark).scalar())


def cdc_apply(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], seq: str, op: str = "op", target_seq: str | None = None,
    tie_break: Sequence[Column] = (),
) -> DataFrame:
    """Apply ordered inserts, updates and deletes; the last change of a key decides (equal ones by ``tie_break``).

    With ``target_seq``, the column of the target that holds the order, changes older than the target's row are left out.
    """
    last = first_rows(changes, keys, [F.col(seq).desc(), *tie_break])
    if target_seq is not None:
        newer = F.col(f"r.{target_seq}") > F.col(f"l.{seq}")
        last = last.alias("l").join(target.select(*keys, target_seq).alias("r"), same_keys("l", "r", keys) & newer, "left_anti")
    return merge_upsert(target, last, keys, delete_when=F.col(op) == "D", strict=False)


def split_by_flag(df: DataFrame, reasons: Mapping[str, Column], flag: str = "quality_flag") -> tuple[DataFrame, DataFrame]:
    """(promoted, quarantined): FAIL rows go to quarantine with the first reason that holds."""
    failed = F.coalesce(F.col(flag) == "FAIL", F.lit(True))
    reason = F.coalesce(*[F.when(c, F.lit(name)) for name, c in reasons.items()], F.lit("other"))
    return df.filter(~failed), df.filter(failed).withColumn("quarantine_reason", reason)
