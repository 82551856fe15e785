"""Column alignment and incremental loads into Bronze."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierworks.session import ensure_table
from tierworks.sources.files import list_files


def evolve_union(base: DataFrame, new: DataFrame) -> DataFrame:
    """Append rows with added columns; older rows get NULL there."""
    return base.unionByName(new, allowMissingColumns=True)


def rescue_columns(df: DataFrame, schema: T.StructType, rescue: str = "_rescued_data") -> DataFrame:
    """Fit rows to the schema and keep what does not fit as JSON text.

    Rescued are columns outside the schema and values which cannot be cast.
    """
    wanted = {f.name: f.dataType for f in schema.fields}
    present = set(df.columns)
    typed, kept = [], []
    for name, kind in wanted.items():
        if name not in present:
            typed.append(F.lit(None).cast(kind).alias(name))
            continue
        value = F.col(name).try_cast(kind)
        typed.append(value.alias(name))
        kept.append(F.when(F.col(name).isNotNull() & value.isNull(), F.col(name).cast("string")).alias(name))
    kept += [F.col(c).cast("string").alias(c) for c in df.columns if c not in wanted]
    text = F.to_json(F.struct(*kept)) if kept else F.lit("{}")
    return df.select(*typed, F.when(text != "{}", text).alias(rescue))


def with_ingest_meta(
    df: DataFrame, loaded_at: str, batch_id: str, source_system: str, source_file: Column | None = None
) -> DataFrame:
    """Load time, file, batch and source system; call it directly on a file scan for the file name."""
    file = source_file if source_file is not None else F.col("_metadata.file_name")
    return df.select(
        "*",
        F.lit(loaded_at).cast("timestamp_ntz").alias("_loaded_at"),
        file.alias("_source_file"),
        F.lit(batch_id).alias("_batch_id"),
        F.lit(source_system).alias("_source_system"),
    )


def match_by_name(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Target columns by case-insensitive name; missing ones are NULL, others are left out."""
    by_lower = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(f"`{by_lower[f.name.lower()]}`") if f.name.lower() in by_lower else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def recent(df: DataFrame, ts: str, days: int, as_of: str) -> DataFrame:
    """Rows of the last ``days`` days; the bound is a literal, so files and row groups are skipped."""
    bound = F.expr(f"TIMESTAMP_NTZ '{as_of}' - INTERVAL {days} DAYS")
    return df.filter(F.col(ts) >= bound)


def date_spine(df: DataFrame, ts: str) -> DataFrame:
    """Every day between the first and the last date of a table."""
    ends = df.agg(F.min(F.to_date(ts)).alias("a"), F.max(F.to_date(ts)).alias("b"))
    return ends.select(F.explode(F.sequence("a", "b")).alias("dt"))


LEDGER = "path string, load_no int"
GROUP_FILES = 1000


def copy_into(spark: SparkSession, src: str, dst: str, schema: T.StructType, glob: str = "*.parquet", group_files: int = GROUP_FILES) -> int:
    """Load files not loaded before and return how many there were.

    A ledger in ``dst/_ledger`` holds the names of loaded files.  Each load is
    its own ``_load=N`` folder, numbered from the ledger: a load that stopped half
    way is not in the ledger, and the next attempt overwrites its folder.

    Names stay in tables: tasks write those of the new files to a manifest, dealt out into groups of about
    ``group_files``; one group after the other is read, and the ledger is filled from the manifest.
    """
    ledger = ensure_table(spark, f"{dst}/_ledger", LEDGER)
    last = ledger.agg(F.max("load_no")).first()[0]
    load_no = 0 if last is None else last + 1
    manifest = f"{dst}/_manifest/load-{load_no}"
    new = list_files(spark, src, glob).select("path").join(ledger.select("path"), "path", "left_anti")
    new.write.mode("overwrite").parquet(f"{manifest}/new")
    listed = spark.read.schema("path string").parquet(f"{manifest}/new")
    n = listed.count()
    if not n:
        return 0
    groups = -(-n // group_files)
    dealt = listed.withColumn("group", F.pmod(F.xxhash64("path"), F.lit(groups)))
    dealt.write.mode("overwrite").partitionBy("group").parquet(f"{manifest}/groups")
    out, mode = f"{dst}/_load={load_no}", "overwrite"
    stored = spark.read.schema("path string, group bigint").parquet(f"{manifest}/groups")
    for group in range(groups):
        paths = [row.path for row in stored.where(F.col("group") == group).select("path").collect()]
        if paths:
            rows = spark.read.schema(schema).parquet(*paths).withColumn("_source_file", F.col("_metadata.file_path"))
            rows.write.mode(mode).parquet(out)
            mode = "append"
    entries = stored.select("path", F.lit(load_no).alias("load_no"))
    entries.coalesce(1).write.mode("append").parquet(f"{dst}/_ledger")
    return n


def read_loaded(spark: SparkSession, dst: str) -> DataFrame:
    """All completed loads of ``copy_into``."""
    last = spark.read.parquet(f"{dst}/_ledger").agg(F.max("load_no")).scalar()
    return spark.read.parquet(dst).filter(F.col("_load") <= last).drop("_load")
