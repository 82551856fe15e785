"""Files, layouts, versions and streams on small hand-made inputs."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierworks.operators import quality, spc
from tierworks.operators.sequences import quantile_edges
from tierworks.session import work_dir
from tierworks.sources import files, ingest, sinks
from tierworks.streaming import runs, streams

START = datetime(2024, 1, 1)
AT = "2024-01-01 00:00:00"
SCHEMA = (
    T.StructType()
    .add("sensor_id", "string").add("reading_timestamp", T.TimestampNTZType()).add("reading_value", "double")
)


def readings(spark, minutes, sensor="s"):
    rows = [(sensor, START + timedelta(minutes=m), float(m)) for m in minutes]
    return spark.createDataFrame(rows, SCHEMA)


def land(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def test_csv_markers_and_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,qty\n1,"Bolt, long",5\n2,NULL,null\n3,,7\n')
    schema = T.StructType.fromDDL("id int, name string, qty int")
    got = [tuple(r) for r in files.read_csv_table(spark, str(tmp_path), schema).orderBy("id").collect()]
    assert got == [(1, "Bolt, long", 5), (2, None, None), (3, None, 7)]


def test_json_outer_array_loses_null_fields(spark, tmp_path):
    records = [{"event_id": "1", "v": {"a": 1, "b": None}}, {"event_id": "2", "v": None}]
    (tmp_path / "e.json").write_text(json.dumps(records))
    rows = files.read_json_events(spark, str(tmp_path), outer_array=True).orderBy("event_id").collect()
    assert [json.loads(r.raw_payload) for r in rows] == [{"event_id": "1", "v": {"a": 1}}, {"event_id": "2"}]
    assert {r._source_file for r in rows} == {"e.json"}


@pytest.fixture
def dirty(spark, tmp_path):
    (tmp_path / "clean.csv").write_text("id,v\n1,1.5\n2,2.5\n")
    (tmp_path / "one.csv").write_text("id,v\n3,oops\n4,4.5\n")
    (tmp_path / "two.csv").write_text("id,v\n5,oops\nx,6.5\n7,7.5\n")
    return files.read_csv_checked(spark, str(tmp_path), T.StructType.fromDDL("id int, v double"))


def test_bad_row_policies(dirty):
    def ids(*policy):
        return sorted(r.id for r in files.load_with_policy(dirty, *policy).collect())

    assert ids("CONTINUE") == [1, 2, 4, 7]
    assert ids("SKIP_FILE") == [1, 2]
    assert ids("SKIP_FILE_N", 2) == [1, 2, 4]
    with pytest.raises(Exception, match="bad row: 3,oops|bad row: 5,oops|bad row: x,6.5"):
        ids("ABORT")
    rejected = files.load_rejects(dirty).select("rejected_record").collect()
    assert sorted(r[0] for r in rejected) == ["3,oops", "5,oops", "x,6.5"]
    assert files.load_rejects(dirty).count() == 3  # the same verdict whatever columns are read


def test_copy_loads_each_file_once(spark):
    src, dst = work_dir(spark, "src"), work_dir(spark, "dst")
    land(readings(spark, [1, 2]), src)
    assert ingest.copy_into(spark, src, dst, SCHEMA) == 1
    assert ingest.copy_into(spark, src, dst, SCHEMA) == 0
    land(readings(spark, [3]), src)
    # A load which stopped before its ledger entry leaves a folder; the next one replaces it.
    readings(spark, [99]).write.parquet(f"{dst}/_load=1")
    assert ingest.copy_into(spark, src, dst, SCHEMA) == 1
    assert sorted(r.reading_value for r in ingest.read_loaded(spark, dst).collect()) == [1.0, 2.0, 3.0]


def test_names_are_read_in_groups(spark):
    src, dst = work_dir(spark, "src"), work_dir(spark, "dst")
    for minute in range(9):
        land(readings(spark, [minute]), src)
    assert ingest.copy_into(spark, src, dst, SCHEMA, group_files=2) == 9
    land(readings(spark, [50]), src)
    assert [ingest.copy_into(spark, src, dst, SCHEMA, group_files=2) for _ in range(2)] == [1, 0]
    assert sorted(r.reading_value for r in ingest.read_loaded(spark, dst).collect()) == [*map(float, range(9)), 50.0]
    assert spark.read.parquet(f"{dst}/_ledger").groupBy("load_no").count().orderBy("load_no").collect() == [(0, 9), (1, 1)]


def test_rescue_keeps_what_does_not_fit(spark):
    df = spark.createDataFrame([("1", "x", "extra"), ("n/a", None, None)], "qty string, name string, other string")
    rows = ingest.rescue_columns(df, T.StructType.fromDDL("qty int, name string, added date")).collect()
    assert [r.qty for r in rows] == [1, None] and rows[0].added is None
    assert [json.loads(r._rescued_data) for r in rows] == [{"other": "extra"}, {"qty": "n/a"}]


def test_clustered_files_cover_narrow_ranges(spark):
    out = work_dir(spark, "clustered")
    df = spark.range(4000).select((F.col("id") * 7919 % 4000).alias("a"), (F.col("id") % 40).alias("b"))
    sinks.publish_clustered(df, out, ["a", "b"], files=16)
    back = spark.read.parquet(out)
    assert quality.same_content(df, back).isEmpty()
    name = F.col("_metadata.file_name")
    spans = back.groupBy(name).agg((F.max("a") - F.min("a")).alias("a"), (F.max("b") - F.min("b")).alias("b")).collect()
    assert len(spans) > 8
    assert sum(r.a for r in spans) / len(spans) < 2400 and sum(r.b for r in spans) / len(spans) < 30


def test_one_extreme_value_does_not_spoil_the_layout(spark):
    out = work_dir(spark, "outlier")
    a = F.when(F.col("id") == 0, 10**12).otherwise(F.col("id") * 7919 % 4000).alias("a")
    df = spark.range(4000).select(a, (F.col("id") % 40).alias("b"), F.when(F.col("id") % 50 != 0, F.col("id")).alias("n"))
    sinks.publish_clustered(df, out, ["a", "b"], files=16)
    back = spark.read.parquet(out)
    assert quality.same_content(df, back).isEmpty()
    usual = back.where("a < 4000").groupBy(F.col("_metadata.file_name"))
    spans = usual.agg((F.max("a") - F.min("a")).alias("a"), (F.max("b") - F.min("b")).alias("b")).collect()
    assert sum(r.a for r in spans) / len(spans) < 2000 and sum(r.b for r in spans) / len(spans) < 20
    sinks.publish_clustered(df, out, ["n", "b"], files=4)
    assert quality.same_content(df, spark.read.parquet(out)).isEmpty()


def test_ranks_count_the_edges_below(spark):
    at = F.timestamp_seconds(F.col("id") * 37 % 100).cast("timestamp_ntz")
    v = F.when(F.col("id") % 9 == 0, float("nan")).when(F.col("id") % 7 != 0, F.col("id") % 50 - 20.5).alias("v")
    df = spark.range(400).select(v, F.when(F.col("id") % 5 != 0, at).alias("t"), F.lit(None).cast("date").alias("d"))
    for c in df.columns:
        edges = df.agg(quantile_edges(c, 8).alias("e")).first().e or []
        kind = df.schema[c].dataType
        held = F.array(*[F.lit(e).cast(kind) for e in edges]) if edges else F.array().cast(f"array<{kind.simpleString()}>")
        keyed = sinks.with_interleaved_key(df, [c], "_z", bits=3)
        assert keyed.columns == [*df.columns, "_z"]
        assert keyed.where(F.col("_z") != F.size(F.filter(held, lambda e: e <= F.col(c)))).isEmpty()


def test_clustering_compares_each_row_a_few_times(spark):
    import time

    out = work_dir(spark, "ranks")
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).alias("a"), F.col("id").alias("b"))
    began = time.time()
    sinks.publish_clustered(df, out, ["a", "b"], files=4)
    assert time.time() - began < 40
    assert quality.same_content(df, spark.read.parquet(out)).isEmpty()


def test_clustering_splits_one_frequent_value(spark):
    out = work_dir(spark, "hot")
    df = spark.range(3000).select(F.when(F.col("id") < 2000, 5).otherwise(F.col("id")).alias("k"), "id")
    sinks.publish_clustered(df, out, ["k"], files=6)
    sizes = spark.read.parquet(out).groupBy(F.col("_metadata.file_name")).count().collect()
    assert max(r["count"] for r in sizes) < 1200


def test_compaction_keeps_content(spark):
    src, dst = work_dir(spark, "small"), work_dir(spark, "large")
    df = spark.range(100).withColumn("day", F.col("id") % 2)
    df.repartition(10).write.parquet(src)
    sinks.compact(spark, src, dst, 1, where=F.col("day") == 1)
    assert quality.same_content(df, spark.read.parquet(dst)).isEmpty()
    detail = sinks.table_detail(spark, dst).first()
    assert 1 < detail.num_files <= 11 and detail.size_bytes > 0


def test_merge_touches_only_its_partitions_and_may_be_repeated(spark):
    path = work_dir(spark, "merged")
    part = {"id_mod_8": "pmod(id, 8)"}
    first = spark.range(200).select("id", F.lit(1).alias("seq"), F.lit("a").alias("v"))
    sinks.merge_partitions(first, path, ["id"], part, ["seq"])
    before = {r.path for r in files.list_files(spark, path).collect()}
    change = spark.createDataFrame([(7, 2, "b"), (7, 1, "late"), (15, 0, "older"), (503, 1, "new"), (None, 1, "n")], "id bigint, seq int, v string")
    for _ in range(2):
        sinks.merge_partitions(change, path, ["id"], part, ["seq"])
    now = {r.id: r.v for r in spark.read.parquet(path).collect()}
    assert len(now) == 202 and (now[7], now[15], now[503], now[None]) == ("b", "a", "new", "n")
    kept = {r.path for r in files.list_files(spark, path).collect()} & before
    assert kept == {p for p in before if "id_mod_8=7" not in p}
    with pytest.raises(ValueError):
        sinks.merge_partitions(change, path, ["id"], {"id_mod_4": "pmod(id, 4)"}, ["seq"])


def test_backup_is_read_when_the_gate_fails(spark):
    out = work_dir(spark, "gold")
    sinks.publish(spark.range(3), f"{out}/now")
    sinks.backup(spark, f"{out}/now", f"{out}/backup")
    sinks.publish(spark.range(5), f"{out}/now")
    counts = [sinks.read_last_good(spark, f"{out}/now", f"{out}/backup", ok).groupBy("_is_cached").count().first() for ok in (True, False)]
    assert [tuple(c) for c in counts] == [(False, 5), (True, 3)]
    assert sinks.read_or_none(spark, f"{out}/nothing") is None


def test_stream_restart_reads_only_new_files(spark):
    out = work_dir(spark, "restart")
    for minutes in ([1, 2], [3]):
        land(readings(spark, minutes), f"{out}/landing")
        df = runs.ingest_files_stream(spark, f"{out}/landing", f"{out}/table", f"{out}/checkpoint", SCHEMA)
    assert sorted(r.reading_value for r in df.collect()) == [1.0, 2.0, 3.0]


def test_rows_behind_the_watermark_are_dropped(spark):
    out = work_dir(spark, "late")
    batches = [[10, 70], [600], [20, 610]]  # minute 20 arrives when the watermark is at minute 480
    for minutes in batches:
        land(readings(spark, minutes), f"{out}/landing")
        stream = streams.file_stream(spark, f"{out}/landing", SCHEMA)
        windows = streams.hourly_stream(stream, "reading_timestamp", "2 hours")
        runs.run_append(windows, f"{out}/table", f"{out}/checkpoint")
    got = sorted((r.window_start.hour, r.n_readings) for r in spark.read.parquet(f"{out}/table").collect())
    assert got == [(0, 1), (1, 1)]


def test_update_mode_matches_batch(spark):
    out = work_dir(spark, "update")
    for minutes in ([1, 2, 65], [3, 66, 130]):
        land(readings(spark, minutes), f"{out}/landing")
        stream = streams.file_stream(spark, f"{out}/landing", SCHEMA)
        windows = streams.hourly_stream(stream, "reading_timestamp", "1 day")
        day = {"window_day": "to_date(window_start)"}
        df = runs.run_update(windows, f"{out}/table", f"{out}/checkpoint", ["sensor_id", "window_start"], day)
    assert sorted((r.window_start.hour, r.n_readings) for r in df.collect()) == [(0, 3), (1, 2), (2, 1)]


def test_complete_mode_keeps_rows_however_late(spark):
    out = work_dir(spark, "complete")
    for minutes in ([600, 610], [20, 70], [21, 605]):
        land(readings(spark, minutes), f"{out}/landing")
        stream = streams.file_stream(spark, f"{out}/landing", SCHEMA)
        df = runs.run_complete(streams.hourly_stream(stream, "reading_timestamp"), f"{out}/table", f"{out}/checkpoint")
    assert sorted((r.window_start.hour, r.n_readings) for r in df.collect()) == [(0, 2), (1, 1), (10, 3)]


def test_alarms_know_the_window_before(spark):
    import random

    draw, out = random.Random(4), work_dir(spark, "alarms")
    rows = []
    for sensor in ("quiet", "wild"):
        for minute in range(0, 12 * 60, 7):
            spread = 1 if sensor == "quiet" else 3 ** (minute // 120)
            rows.append((sensor, START + timedelta(minutes=minute), 100 + spread * draw.random()))
    rows.sort(key=lambda r: (r[1] - START).total_seconds() / 60 + draw.randrange(50))  # out of order, within the watermark
    for k in range(6):
        land(spark.createDataFrame(rows[k * len(rows) // 6 : (k + 1) * len(rows) // 6], SCHEMA), f"{out}/landing")
        stream = streams.file_stream(spark, f"{out}/landing", SCHEMA)
        alarms = streams.alarm_stream(stream, "reading_timestamp", width="1 hour", watermark="1 hour")
        runs.run_append(alarms, f"{out}/table", f"{out}/checkpoint", keyed_state=True)
    hours = spark.createDataFrame(rows, SCHEMA).groupBy("sensor_id", F.date_trunc("hour", "reading_timestamp").cast("timestamp_ntz").alias("kpi_date"))
    stats = hours.agg(
        F.avg("reading_value").alias("avg_reading"), F.stddev("reading_value").alias("stddev_reading"), F.min("reading_value").alias("min_reading"),
        F.max("reading_value").alias("max_reading"), F.count(F.lit(1)).alias("total_readings"),
    ).withColumns({c: F.lit("") for c in ("sensor_name", "equipment_name", "process_area")})
    names = ["stability_level", "signal_quality", "has_outlier", "range_violated", "volatility_trend", "spike_status", "alert_severity"]
    batch = {(r.sensor_id, r.kpi_date): [r[c] for c in names] for r in spc.sensor_alerts(stats).collect()}
    stream = {(r.sensor_id, r.window_start): [r[c] for c in names] for r in spark.read.parquet(f"{out}/table").collect()}
    assert len(stream) >= 18 and all(batch[k] == v for k, v in stream.items())
    assert {v[4] for v in stream.values()} >= {"NO_HISTORY", "DEGRADING"}


def test_counts_of_each_batch_are_rows_and_a_failed_batch_writes_nothing(spark):
    out = work_dir(spark, "checked")
    land(readings(spark, [1, 2, 3]), f"{out}/landing")
    stream = streams.file_stream(spark, f"{out}/landing", SCHEMA)
    rules = {"small": ("warn", "reading_value < 2"), "odd": ("drop", "reading_value % 2 = 1"), "known": ("fail", "reading_value IS NOT NULL")}
    df = runs.run_checked(stream, f"{out}/table", f"{out}/metrics", f"{out}/checkpoint", rules)
    assert sorted(r.reading_value for r in df.collect()) == [1.0, 3.0]
    counts = {r.expectation: (r.violations, r.rows_kept, r.batch_id) for r in spark.read.parquet(f"{out}/metrics").collect()}
    assert counts == {"small": (2, 3, 0), "odd": (1, 2, 0), "known": (0, 3, 0)}
    land(readings(spark, [5]).withColumn("reading_value", F.lit(None).cast("double")), f"{out}/landing")
    with pytest.raises(Exception, match="expectation failed"):
        runs.run_checked(stream, f"{out}/table", f"{out}/metrics", f"{out}/checkpoint", rules)
    assert spark.read.parquet(f"{out}/table").count() == 2


def _upsert(spark, out, source="landing", checkpoint="checkpoint"):
    stream = streams.file_stream(spark, f"{out}/{source}", SCHEMA)
    part = {"sensor_part": "pmod(xxhash64(sensor_id), 4)"}
    return runs.stream_upsert(stream, f"{out}/table", ["sensor_id"], ["reading_timestamp"], f"{out}/{checkpoint}", part)


def test_upsert_stream_keeps_the_newest(spark):
    out = work_dir(spark, "upsert")
    for minutes in ([5, 9], [7]):  # an older reading arrives later
        land(readings(spark, minutes), f"{out}/landing")
        df = _upsert(spark, out)
    assert [r.reading_value for r in df.collect()] == [9.0]


def test_upsert_loses_nothing_with_a_new_checkpoint_or_a_second_stream(spark):
    out = work_dir(spark, "upsert")
    land(readings(spark, [5]), f"{out}/landing")
    _upsert(spark, out)
    other = readings(spark, [6]).withColumn("sensor_id", F.lit("another"))
    land(other, f"{out}/second")
    _upsert(spark, out, "second", "second-checkpoint")  # its batch has the same number
    land(readings(spark, [8]), f"{out}/landing")
    df = _upsert(spark, out, checkpoint="new-checkpoint")  # repeats the first file as well
    assert sorted((r.sensor_id == "another", r.reading_value) for r in df.collect()) == [(False, 8.0), (True, 6.0)]


def test_stream_expectations_report_each_batch(spark):
    out = work_dir(spark, "expect")
    land(readings(spark, [1, 2]).union(readings(spark, [3]).withColumn("reading_value", F.lit(None).cast("double"))), f"{out}/landing")
    stream = streams.file_stream(spark, f"{out}/landing", SCHEMA)
    checked = quality.expect_stream(stream, warn={"small": "reading_value < 2"}, drop={"value": "reading_value IS NOT NULL"})
    query = runs.run_append(checked, f"{out}/table", f"{out}/checkpoint")
    counts = [p.observedMetrics["expectations"] for p in query.recentProgress if "expectations" in p.observedMetrics]
    assert [(c["n_rows"], c["small"], c["value"]) for c in counts] == [(3, 2, 1)]
    assert spark.read.parquet(f"{out}/table").count() == 2


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark, "x").startswith(configured.rstrip("/") + "/")
