"""History tables: slowly changing dimensions and snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierworks.functions.keys import row_hash, surrogate_key
from tierworks.operators import sequences as seq
from tierworks.operators.merge import require_unique
from tierworks.schemas import OPEN_END


def _open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp_ntz")


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return same


def detect_changes(source: DataFrame, history: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """Source rows labelled New, Changed or Unchanged against the current versions."""
    current = history.filter("is_current").select(key, *tracked, F.lit(True).alias("_known")).alias("c")
    hashed = source.withColumn("row_hash", row_hash(tracked)).alias("s")
    label = (
        F.when(F.col("c._known").isNull(), "New").when(~_same("c", "s", tracked), "Changed").otherwise("Unchanged")
    )
    return hashed.join(current, F.col(f"s.{key}") == F.col(f"c.{key}"), "left").select("s.*", label.alias("change"))


def scd2_build(versions: DataFrame, key: str, tracked: Sequence[str], ts: str, spread: bool = False) -> DataFrame:
    """History from a batch of versions.

    Consecutive versions with equal tracked values collapse into one; each version
    ends where the next one starts, the last one is open.  Versions are compared by
    their columns and, at the same time, ordered by them; both steps share one shuffle.
    Loads bring a key once each, so its versions are few; ``spread`` is for feeds of single
    changes, where one key may have much of the rows, and cuts such keys into chunks.
    """
    hashed = versions.withColumn("row_hash", row_hash(tracked)).dropDuplicates([key, ts, *tracked])
    before = {"_prev_at": ts, **{f"_prev_{c}": c for c in tracked}}
    unchanged = F.col("_prev_at").isNotNull()
    for c in tracked:
        unchanged = unchanged & F.col(c).eqNullSafe(F.col(f"_prev_{c}"))
    chunks = seq.by_time(ts) if spread else None
    steps = seq.Ordered.of(hashed, [key], [ts, "row_hash", *tracked], chunks).neighbours(before, {})
    closed = steps.where(~unchanged).neighbours({}, {"_next_from": ts}).frame().withColumn("valid_from", F.col(ts))
    return closed.select(
        surrogate_key(key, "row_hash", "valid_from").alias("version_sk"),
        key,
        *tracked,
        "row_hash",
        F.col("_next_from").isNull().alias("is_current"),
        "valid_from",
        F.coalesce("_next_from", _open_end()).alias("valid_to"),
    )


def scd2_merge(history: DataFrame, source: DataFrame, key: str, tracked: Sequence[str], effective: str) -> DataFrame:
    """Merge a new load into the history in one pass.

    A changed current version is closed at ``effective`` and its new version is
    added; new keys are added; everything else stays as it is.  A source key that
    occurs twice fails the query, so the full join pairs one row with one row.
    """
    at = F.lit(effective).cast("timestamp_ntz")
    incoming = require_unique(source.select(key, *tracked), [key]).withColumn("row_hash", row_hash(tracked)).alias("s")
    # Closed versions meet nothing and pass through the same join.
    meets = (F.col(f"c.{key}") == F.col(f"s.{key}")) & F.col("c._current")
    pairs = history.withColumn("_current", F.col("is_current")).alias("c").join(incoming, meets, "full")
    has_old, has_new = F.col("c._current").isNotNull(), F.col(f"s.{key}").isNotNull()
    changed = has_old & has_new & ~_same("c", "s", tracked)

    old = F.struct(
        *[F.col(f"c.{c}").alias(c) for c in history.columns if c not in ("is_current", "valid_to")],
        (F.col("c._current") & ~changed).alias("is_current"),
        F.when(changed, at).otherwise(F.col("c.valid_to")).alias("valid_to"),
    )
    new = F.struct(
        *[
            {
                "version_sk": surrogate_key(f"s.{key}", "s.row_hash", at),
                "row_hash": F.col("s.row_hash"),
                "valid_from": at,
            }.get(c, F.col(f"s.{c}") if c == key or c in tracked else F.lit(None)).alias(c)
            for c in history.columns
            if c not in ("is_current", "valid_to")
        ],
        F.lit(True).alias("is_current"),
        _open_end().alias("valid_to"),
    )
    rows = F.filter(
        F.array(F.when(has_old, old), F.when(changed | ~has_old, new)), lambda r: r.isNotNull()
    )
    return pairs.select(F.explode(rows).alias("r")).select("r.*").select(*history.columns)


def dim_vendor(history: DataFrame, current_only: bool = True) -> DataFrame:
    return history.filter("is_current") if current_only else history


def _snapshot(
    history: DataFrame,
    source: DataFrame,
    key: str,
    columns: Sequence[str],
    newer: Column,
    starts: Column,
    as_of: str,
    hard_deletes: bool,
) -> DataFrame:
    """Shared snapshot step; ``newer`` compares ``c`` (current) with ``s`` (source)."""
    at = F.lit(as_of).cast("timestamp_ntz")
    closed_rows = history.filter(F.col("valid_to").isNotNull())
    current = history.filter(F.col("valid_to").isNull()).alias("c")
    pairs = current.join(source.alias("s"), F.col(f"c.{key}") == F.col(f"s.{key}"), "full")
    has_old, has_new = F.col(f"c.{key}").isNotNull(), F.col(f"s.{key}").isNotNull()
    changed = has_old & has_new & newer
    gone = has_old & ~has_new & F.lit(hard_deletes)
    old = F.struct(
        *[F.col(f"c.{c}").alias(c) for c in columns],
        F.col("c.valid_from").alias("valid_from"),
        F.when(changed, starts).when(gone, at).otherwise(F.col("c.valid_to")).alias("valid_to"),
    )
    new = F.struct(
        *[F.col(f"s.{c}").alias(c) for c in columns],
        starts.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )
    rows = F.filter(F.array(F.when(has_old, old), F.when(changed | ~has_old, new)), lambda r: r.isNotNull())
    out = pairs.select(F.explode(rows).alias("r")).select("r.*")
    return closed_rows.select(*out.columns).unionByName(out)


def snapshot_start(source: DataFrame, columns: Sequence[str], starts: str | Column) -> DataFrame:
    """First snapshot: every row open, from ``starts``."""
    begin = F.col(starts) if isinstance(starts, str) else starts
    return source.select(
        *columns, begin.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to")
    )


def snapshot_timestamp(
    history: DataFrame, source: DataFrame, key: str, updated_at: str, as_of: str, hard_deletes: bool = True
) -> DataFrame:
    """Timestamp strategy: a newer ``updated_at`` starts a version; vanished keys are closed."""
    columns = [c for c in history.columns if c not in ("valid_from", "valid_to")]
    newer = F.coalesce(F.col(f"s.{updated_at}") > F.col(f"c.{updated_at}"), F.lit(False))
    return _snapshot(history, source, key, columns, newer, F.col(f"s.{updated_at}"), as_of, hard_deletes)


def snapshot_check(
    history: DataFrame, source: DataFrame, key: str, check_cols: Sequence[str], as_of: str, hard_deletes: bool = False
) -> DataFrame:
    """Check strategy: a change in a listed column starts a version; vanished keys stay open."""
    columns = [c for c in history.columns if c not in ("valid_from", "valid_to")]
    newer = ~_same("c", "s", check_cols)
    return _snapshot(history, source, key, columns, newer, F.lit(as_of).cast("timestamp_ntz"), as_of, hard_deletes)
