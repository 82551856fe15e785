"""Writers: plain, partitioned, clustered, compacted and merged tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierworks.operators.scd import detect_changes, scd2_merge
from tierworks.operators.sequences import first_rows, quantile_edges
from tierworks.sources.files import list_files


def publish(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (), spread: int | None = None
) -> None:
    """Write Parquet; ``overwrite`` also replaces the schema.

    With ``spread`` the rows of each partition value come from that many tasks:
    few files per value, while a value holding much of the data is still written in parallel.
    """
    if partition_by and spread:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(spread))
        df = df.repartition(*[F.col(c) for c in partition_by], salt)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df``."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def with_interleaved_key(df: DataFrame, columns: Sequence[str], out: str, bits: int = 10) -> DataFrame:
    """Add a Morton key of numeric or time columns: the bits of their ranks interleaved, so rows close in all columns get close keys.

    A rank is the place among the column's own quantiles, so cells hold equally many rows whatever the
    distribution; one extreme value changes nothing.  NULLs come first.
    """
    found = df.agg(*[quantile_edges(c, 1 << bits).cast("array<string>").alias(c) for c in columns]).first()
    edges = []  # one pass for all columns; 2^bits numbers of each reach the driver
    for c in columns:
        kind = T.ArrayType(df.schema[c].dataType)
        edges.append(F.split(F.lit("|".join(found[c])), "[|]").cast(kind) if found[c] else F.array().cast(kind))
    ranks = [f"_rank{j}" for j in range(len(columns))]
    rows = df.withColumns({r: F.lit(0) for r in ranks})
    # The edges are halved bit by bit, each in a step of its own: a row compares each column ``bits`` times.
    for bit in reversed(range(bits)):
        step = 1 << bit
        above = [F.get(e, F.col(r) + (step - 1)) <= F.col(c) for e, r, c in zip(edges, ranks, columns)]
        rows = rows.withColumns({r: F.col(r) + F.when(up, step).otherwise(0) for r, up in zip(ranks, above)})
    key = F.lit(0).cast("bigint")
    for bit in range(bits):
        for j, rank in enumerate(ranks):
            one = F.shiftright(F.col(rank).cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(ranks) + j))
    return rows.withColumn(out, key).drop(*ranks)


def publish_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int) -> None:
    """Write range-partitioned, sorted files so that Parquet statistics skip data.

    A hash of the row follows the cluster key in the ranges, so one frequent key
    value is cut into several files instead of one.
    """
    key = F.col(columns[0]) if len(columns) == 1 else F.col("_z")
    keyed = df if len(columns) == 1 else with_interleaved_key(df, columns, "_z")
    ranged = keyed.repartitionByRange(files, key, F.xxhash64(*df.columns))
    ranged.sortWithinPartitions(key, *columns).select(*df.columns).write.mode("overwrite").parquet(path)


def compact(
    spark: SparkSession, path: str, dst: str, target_files: int, where: Column | None = None, cluster: Sequence[str] = ()
) -> None:
    """Rewrite small files of ``path`` into ``dst`` with few files; content is unchanged.

    Rows are dealt out by ranges of ``cluster`` (default: the first column), so a clustered table stays clustered.

    With ``where`` only those rows are compacted, the others keep their layout.
    """
    table = spark.read.parquet(path)
    chosen = table if where is None else table.filter(where)
    by = list(cluster) or table.columns[:1]
    ranged = chosen.repartitionByRange(target_files, *by, F.xxhash64(*table.columns)).sortWithinPartitions(*by)
    ranged.write.mode("overwrite").parquet(dst)
    if where is not None:
        table.filter(~F.coalesce(where, F.lit(False))).write.mode("append").parquet(dst)


def table_detail(spark: SparkSession, path: str, partition_columns: Sequence[str] = ()) -> DataFrame:
    """Number of files and bytes, from the listing alone."""
    return list_files(spark, path).agg(
        F.count(F.lit(1)).alias("num_files"), F.sum("length").alias("size_bytes")
    ).withColumn("partition_columns", F.lit(",".join(partition_columns)))


def backup(spark: SparkSession, path: str, backup_path: str) -> None:
    """Copy a table before it is rebuilt."""
    publish(spark.read.parquet(path), backup_path)


def read_last_good(spark: SparkSession, path: str, backup_path: str, gate_passed: bool) -> DataFrame:
    """The table when its gate passed, otherwise the backup; ``_is_cached`` tells which."""
    return spark.read.parquet(path if gate_passed else backup_path).withColumn("_is_cached", F.lit(not gate_passed))


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, None where there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def merge_partitions(
    batch: DataFrame, path: str, keys: Sequence[str], part: Mapping[str, str], order: Sequence[str] = ()
) -> None:
    """Merge rows into a partitioned table: of all rows of a key the last by ``order`` stays, a new one wins a tie.

    ``part`` names the one partition column and derives it from the keys (SQL); a table laid out by another one is refused.
    The merged partitions are staged beside the table and then replace the old ones, which are the only ones touched.
    A repeated merge of the same batch changes nothing, whoever repeats it, as it is decided by key and order alone.
    """
    spark = batch.sparkSession
    (column, derived), = part.items()
    newest = [F.col(c).desc_nulls_last() for c in order]
    rows = batch.withColumn(column, F.expr(derived)).withColumn("_new", F.lit(1))
    table = read_or_none(spark, path)
    if table is not None:
        if column not in table.columns:
            raise ValueError(f"{path} is not partitioned by {column}")
        touched = rows.select(column).distinct()
        current = table.join(touched, column, "left_semi").withColumn("_new", F.lit(0))
        rows = rows.unionByName(current.select(*rows.columns))
    merged = first_rows(rows, keys, [*newest, F.col("_new").desc()]).drop("_new")
    staged = f"{path}_staged-{uuid.uuid4().hex}"
    publish(merged, staged)
    overwrite_partitions(spark.read.schema(merged.schema).parquet(staged), path, [column])


HISTORY_PART = "key_part"


def publish_history(history: DataFrame, path: str, key: str, parts: int = 64) -> None:
    """Write a history laid out by a hash of its key, as ``merge_history`` needs it."""
    publish(history.withColumn(HISTORY_PART, F.pmod(F.xxhash64(key), F.lit(parts))), path, partition_by=[HISTORY_PART], spread=1)


def merge_history(
    source: DataFrame, path: str, key: str, tracked: Sequence[str], effective: str, parts: int = 64
) -> None:
    """``scd2_merge`` into a stored history, of which only partitions with new or changed keys are read and replaced.

    Rows that change nothing touch no file.  The merged partitions are staged beside the table and then replace the old
    ones; a repeated merge finds nothing new.
    """
    spark = source.sparkSession
    part = F.pmod(F.xxhash64(key), F.lit(parts))
    table = spark.read.parquet(path)
    if HISTORY_PART not in table.columns:
        raise ValueError(f"{path} is not partitioned by {HISTORY_PART}")
    labelled = detect_changes(source, table, key, tracked).where(F.col("change") != "Unchanged")
    staged = f"{path}_staged-{uuid.uuid4().hex}"
    publish(labelled.drop("change", "row_hash"), f"{staged}/changes")
    changes = spark.read.schema(source.schema).parquet(f"{staged}/changes")
    touched = changes.select(part.alias(HISTORY_PART)).distinct()
    old = table.join(F.broadcast(touched), HISTORY_PART, "left_semi").drop(HISTORY_PART)  # at most ``parts`` rows
    merged = scd2_merge(old, changes, key, tracked, effective).withColumn(HISTORY_PART, part)
    publish(merged, f"{staged}/merged")
    overwrite_partitions(spark.read.schema(merged.schema).parquet(f"{staged}/merged"), path, [HISTORY_PART])


def append_checked(df: DataFrame, path: str, predicate: str) -> None:
    """Append a batch only if every row satisfies the constraint; otherwise nothing is written.

    The batch is staged, so that the rows checked are the rows appended, whatever the source does in between.
    """
    spark, staged = df.sparkSession, f"{path}_staged-{uuid.uuid4().hex}"
    df.write.parquet(staged)
    rows = spark.read.schema(df.schema).parquet(staged)
    if not rows.filter(~F.coalesce(F.expr(predicate), F.lit(False))).isEmpty():
        raise ValueError(f"CHECK constraint violated: {predicate}")
    rows.write.mode("append").parquet(path)
