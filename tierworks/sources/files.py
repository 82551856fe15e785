"""Readers for Parquet, CSV and JSON drops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that mean NULL in delimited files.
NULL_MARKERS = ("NULL", "null", "")
CORRUPT = "_corrupt_record"
SOURCE_FILE = "_source_file"


def read_bronze(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet under an enforced schema; every row and status is kept."""
    return spark.read.schema(schema).parquet(path)


def read_csv_table(
    spark: SparkSession, path: str, schema: T.StructType, null_markers: Sequence[str] = NULL_MARKERS
) -> DataFrame:
    """CSV with header and optional quotes; several markers mean NULL; strict types."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = spark.read.schema(text).option("header", True).option("quote", '"').csv(path)

    def typed(f: T.StructField) -> Column:
        value = F.col(f.name)
        return F.when(~value.isin(*null_markers), value).cast(f.dataType).alias(f.name)

    return raw.select(*[typed(f) for f in schema.fields])


def read_json_events(
    spark: SparkSession, path: str, schema: T.StructType | None = None, outer_array: bool = False
) -> DataFrame:
    """JSON records as rows, one per line or in an outer array per file.

    Adds the whole record without its null fields, and its file.
    """
    reader = spark.read.option("multiLine", outer_array)
    df = (reader.schema(schema) if schema is not None else reader).json(path)
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    return df.select(*df.columns, record.alias("raw_payload"), F.col("_metadata.file_name").alias(SOURCE_FILE))


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV rows with the raw text of rows that do not fit, and their file."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = (
        spark.read.schema(wide)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
        .withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
    )
    # A row counts as bad only for the columns a query reads; tying the raw text to
    # all of them makes the verdict the same in every query.
    raw, parsed = F.col(CORRUPT), F.concat_ws(",", *[F.col(f.name).cast("string") for f in schema.fields])
    return rows.withColumn(CORRUPT, F.coalesce(raw, F.when(raw.isNotNull(), parsed)))


def load_with_policy(df: DataFrame, on_error: str, n: int = 1) -> DataFrame:
    """Apply a bad-row policy to rows of ``read_csv_checked``.

    CONTINUE drops bad rows, SKIP_FILE drops files with any error, SKIP_FILE_N
    files with at least ``n``, ABORT fails the load at the first error.
    """
    bad = F.col(CORRUPT).isNotNull()
    clean = [c for c in df.columns if c != CORRUPT]
    if on_error == "CONTINUE":
        return df.filter(~bad).select(*clean)
    if on_error == "ABORT":
        stop = F.raise_error(F.concat(F.lit("bad row: "), F.col(CORRUPT))).cast("boolean")
        return df.filter(F.when(bad, stop).otherwise(F.lit(True))).select(*clean)
    limit = {"SKIP_FILE": 1, "SKIP_FILE_N": n}[on_error]
    rejected = (
        df.groupBy(SOURCE_FILE).agg(F.count_if(bad).alias("_bad")).filter(F.col("_bad") >= limit).select(SOURCE_FILE)
    )
    return df.filter(~bad).join(rejected, SOURCE_FILE, "left_anti").select(*clean)


def load_rejects(df: DataFrame) -> DataFrame:
    """Rejected rows of a load: file and raw text."""
    return df.filter(F.col(CORRUPT).isNotNull()).select(SOURCE_FILE, F.col(CORRUPT).alias("rejected_record"))


def list_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """Files below a folder with size and time; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", "modificationTime")
    )
