"""Session helpers: configuration and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "tierworks", master: str | None = None, **conf) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.unionOutputPartitioning", "false")  # loses rows of joins above some unions in Spark 4.1
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir``, else the warehouse if that is on a shared store.

    A single machine without the setting uses a temporary folder of its own; a cluster is refused.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if not warehouse.startswith(("file:", "/")):
        return warehouse.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
    root = tempfile.mkdtemp(prefix="tierworks-")
    spark.conf.set(CHECKPOINT_CONF, root)
    return root


def ensure_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, created empty where there is none yet."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder for one run of one operator."""
    return f"{shared_root(spark)}/tierworks/{label}-{uuid.uuid4().hex}"
