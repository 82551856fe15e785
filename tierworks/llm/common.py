"""Helpers of the operators: reading tables, and tables written to the shared folder."""

from __future__ import annotations

import json

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tierworks.session import work_dir

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of one Arrow batch between Spark and Python, so that rows with long texts don't pile up in a task.
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> None:
    """Settings of this session that the operators rely on.

    Arrow batches are bounded by bytes as well as by rows. Spark 4.1 can lose rows of a join above a union whose
    branches are partitioned alike, so unions make no claim about their partitioning.
    """
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name, str(2**31 - 1)).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(name, BATCH_BYTES)


def stored(df: DataFrame, label: str, **options) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there, and a lost executor costs nothing."""
    spark = df.sparkSession
    prepare(spark)
    path = work_dir(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tokenizer_json(path: str, **model) -> str:
    """The text of a tokenizer file, with entries of its model replaced."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    spec["model"].update(model)
    return json.dumps(spec)
