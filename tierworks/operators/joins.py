"""Join shapes used between static and dynamic data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierworks.operators import sequences as seq


def enrich_and_check(signal: DataFrame, master: DataFrame, on: str, value: str, limit: str) -> DataFrame:
    """Inner enrichment by master data and a check of the value against the unit's own limit."""
    return signal.join(master, on).withColumn(
        f"{value}_status", F.when(F.col(value) > F.col(limit), "CRITICAL").otherwise("OK")
    )


def semi(left: DataFrame, right: DataFrame, on: Sequence[str] | str) -> DataFrame:
    return left.join(right, on, "left_semi")


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose non-null reference has no parent."""
    parents = parent.select(F.col(pk).alias("_pk"))
    return child.filter(F.col(fk).isNotNull()).join(parents, F.col(fk) == F.col("_pk"), "left_anti")


def missing_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of ``a`` which never reached ``b``."""
    return a.select(key).distinct().join(b.select(key), key, "left_anti")


def outer_pairs(left: DataFrame, right: DataFrame, on: str, how: str) -> DataFrame:
    """Right or full outer join on one key that both sides hold once, NULL keys unmatched."""
    r = right.withColumnRenamed(on, "_on")
    return (
        left.join(r, F.col(on) == F.col("_on"), how)
        .withColumn(on, F.coalesce(F.col(on), F.col("_on")))
        .drop("_on")
    )


def as_of_join(fact: DataFrame, history: DataFrame, key: str, ts: str) -> DataFrame:
    """Version of the dimension valid at the fact's time: from inclusive, to exclusive.

    Facts and versions are laid in one order by time, and the last version is carried
    forward to each fact, so a busy key is cut into chunks and never meets all of its
    versions; validity intervals of a key do not overlap.  NULL keys and times find none.
    """
    fact.sparkSession.conf.set("spark.sql.unionOutputPartitioning", "false")  # see ``session.build_session``
    others = [c for c in history.columns if c != key]
    known = F.col(key).isNotNull() & F.col("valid_from").isNotNull()
    versions = history.filter(known).select(
        F.col(key).alias("_key"), F.col("valid_from").alias("_at"), F.struct(*others).alias("_version"),
        F.lit(None).cast(fact.select(F.struct("*")).schema[0].dataType).alias("_fact"),
    )
    facts = fact.select(
        F.col(key).alias("_key"), F.col(ts).cast(versions.schema["_at"].dataType).alias("_at"),
        F.lit(None).cast(versions.schema["_version"].dataType).alias("_version"), F.struct("*").alias("_fact"),
    )
    both = versions.unionByName(facts).withColumn("_is_fact", F.col("_fact").isNotNull())
    carried = seq.Ordered.of(both, ["_key"], ["_at", "_is_fact"], seq.by_time("_at")).carry_last("_version", "_found")
    valid = F.col("_at") < F.col("_found.valid_to")
    return carried.where(F.col("_is_fact")).frame().select(
        "_fact.*", *[F.when(valid, F.col(f"_found.{c}")).alias(c) for c in others]
    )
