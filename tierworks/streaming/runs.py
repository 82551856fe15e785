"""Starting, draining and writing streams."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tierworks.operators.quality import expectation_counts
from tierworks.sources.sinks import merge_partitions, overwrite_partitions, publish
from tierworks.streaming.streams import file_stream


ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None, keyed_state: bool = False) -> Iterator[None]:
    """Settings a stateful query takes over at its start.

    State is split once, by default into as many parts as the cluster has cores.
    Sessions are merged before the shuffle too, so a busy key sends few rows.
    ``keyed_state`` is for processors with state of their own, which Spark keeps in RocksDB only.
    """
    settings = {
        "spark.sql.shuffle.partitions": str(partitions or spark.sparkContext.defaultParallelism),
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    }
    if keyed_state:
        settings["spark.sql.streaming.stateStore.providerClass"] = ROCKS_DB
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def start_append(
    stream: DataFrame, path: str, checkpoint: str, interval: str | None = None, keyed_state: bool = False
) -> StreamingQuery:
    """Append to Parquet: everything available and stop, or micro-batches every ``interval``."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    with state_settings(stream.sparkSession, keyed_state=keyed_state):
        return writer.start(path)


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait until all available input is processed, then stop."""
    try:
        query.processAllAvailable()
        if query.exception() is not None:
            raise query.exception()
    finally:
        query.stop()
    return query


def run_append(stream: DataFrame, path: str, checkpoint: str, keyed_state: bool = False) -> StreamingQuery:
    query = start_append(stream, path, checkpoint, keyed_state=keyed_state)
    query.awaitTermination()
    return query


def ingest_files_stream(
    spark: SparkSession, src: str, dst: str, checkpoint: str, schema: T.StructType, glob: str | None = None
) -> DataFrame:
    """Load the files that are new since the last run, with their names, and return the table."""
    stream = file_stream(spark, src, schema, glob).withColumn("_source_file", F.col("_metadata.file_name"))
    run_append(stream, dst, checkpoint)
    return spark.read.parquet(dst)


def run_complete(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Complete mode: the table is replaced by the whole result after each batch.

    Without a watermark no row is ever too late, and the state holds every group there is. A result is staged before it
    takes the table's place, so a failed batch leaves the table as it was.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        staged = f"{path}_staged-{batch_id}"
        publish(batch, staged)
        publish(batch.sparkSession.read.schema(batch.schema).parquet(staged), path)

    _run_batches(stream, "complete", write, checkpoint)
    return stream.sparkSession.read.parquet(path)


def run_checked(
    stream: DataFrame, path: str, metrics: str, checkpoint: str, rules: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """Append the rows that expectations leave, and keep each batch's counts as rows of ``metrics``.

    ``rules`` map a name to (action, predicate): ``warn`` keeps failing rows, ``drop`` leaves them out, ``fail`` stops the
    query before anything of the batch is written. A repeated batch replaces its own rows and counts.
    """
    kept = [F.coalesce(F.expr(p), F.lit(False)) for action, p in rules.values() if action == "drop"]

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            counts = expectation_counts(batch, rules).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            overwrite_partitions(counts, metrics, ["batch_id"])
            stored = batch.sparkSession.read.parquet(metrics).where(F.col("batch_id") == batch_id)
            if not stored.where("action = 'fail' and violations > 0").isEmpty():
                raise ValueError("expectation failed")
            rows = batch
            for good in kept:
                rows = rows.where(good)
            overwrite_partitions(rows.withColumn("_batch", F.lit(batch_id).cast("bigint")), path, ["_batch"])
        finally:
            batch.unpersist()

    _run_batches(stream, "append", write, checkpoint)
    return stream.sparkSession.read.parquet(path).drop("_batch")


def run_update(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], part: Mapping[str, str]
) -> DataFrame:
    """Update mode: changed rows of each batch replace the table's rows of the same keys (see ``merge_partitions``)."""
    return _merge_stream(stream, "update", path, checkpoint, keys, part, ())


def stream_upsert(
    stream: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], checkpoint: str, part: Mapping[str, str]
) -> DataFrame:
    """Merge a stream of rows into a table; the newest row of a key by ``order`` stays, so a repeated batch adds nothing."""
    return _merge_stream(stream, "append", path, checkpoint, keys, part, order)


def _merge_stream(
    stream: DataFrame, mode: str, path: str, checkpoint: str, keys: Sequence[str], part: Mapping[str, str],
    order: Sequence[str],
) -> DataFrame:
    columns = stream.columns

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read several times below, and its state must be touched once
        try:
            if not batch.isEmpty():
                merge_partitions(batch, path, keys, part, order)
        finally:
            batch.unpersist()

    _run_batches(stream, mode, write, checkpoint)
    return stream.sparkSession.read.parquet(path).select(*columns)


def _run_batches(stream: DataFrame, mode: str, write, checkpoint: str) -> None:
    with state_settings(stream.sparkSession):
        query = (
            stream.writeStream.outputMode(mode)
            .foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()
