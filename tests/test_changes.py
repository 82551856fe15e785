"""Merges, history tables, change feeds: invariants and small worked cases."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierworks.operators import changes, merge, quality, scd

OLD = [("a", 1, "x"), ("b", 2, "y"), ("c", 3, None)]
NEW = [("b", 2, "z"), ("c", 3, None), ("d", 4, "w")]
SCHEMA = "k string, n int, v string"
T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upsert_and_delete(spark):
    target, source = spark.createDataFrame(OLD, SCHEMA), spark.createDataFrame(NEW, SCHEMA)
    assert rows(merge.merge_upsert(target, source, ["k"])) == sorted([OLD[0], *NEW], key=repr)
    kept = merge.merge_upsert(target, source, ["k"], delete_when=F.col("v") == "z")
    assert rows(kept) == sorted([OLD[0], NEW[1], NEW[2]], key=repr)


def test_repeated_source_key_is_refused(spark):
    target, source = spark.createDataFrame(OLD, SCHEMA), spark.createDataFrame(NEW + NEW[:1], SCHEMA)
    with pytest.raises(Exception, match="duplicate merge key: b"):
        merge.merge_upsert(target, source, ["k"]).collect()


def test_conditional_merge_changes_one_column(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, None)], SCHEMA)
    source = spark.createDataFrame([("a", 9, "q"), ("b", 9, "q"), ("c", 9, "q")], SCHEMA)
    got = rows(merge.merge_when(target, source, ["k"], ["v"]))
    assert got == [("a", 1, "q"), ("b", 2, None), ("c", 9, "q")]


def test_insert_only_merge_is_idempotent(spark):
    target, source = spark.createDataFrame(OLD, SCHEMA), spark.createDataFrame(NEW, SCHEMA)
    once = merge.merge_insert_new(target, source, ["k"])
    assert quality.same_content(once, merge.merge_insert_new(once, source, ["k"])).isEmpty()
    assert rows(once) == sorted([*OLD, NEW[2]], key=repr)


def test_change_feed(spark):
    old, new = spark.createDataFrame(OLD, SCHEMA), spark.createDataFrame(NEW, SCHEMA)
    want = [("a", 1, "x", "delete"), ("b", 2, "y", "update_preimage"), ("b", 2, "z", "update_postimage"), ("d", 4, "w", "insert")]
    assert rows(changes.change_feed(old, new, ["k"])) == sorted(want, key=repr)
    assert changes.has_changes(old, new, ["k"]).first()[0] is True
    assert changes.has_changes(old, old, ["k"]).first()[0] is False


def test_cdc_last_operation_wins(spark):
    target = spark.createDataFrame(OLD, SCHEMA)
    ops = [("a", 1, "p", 1, "U"), ("a", 1, "q", 2, "D"), ("b", 2, "r", 5, "U"), ("b", 2, "old", 4, "D"), ("e", 5, "s", 1, "I")]
    events = spark.createDataFrame(ops, SCHEMA + ", seq int, op string")
    assert rows(merge.cdc_apply(target, events, ["k"], "seq")) == [("b", 2, "r"), ("c", 3, None), ("e", 5, "s")]


def test_high_water_mark(spark):
    source = spark.createDataFrame([(1, T1), (2, T2), (3, T3)], "id int, at timestamp_ntz")
    assert [r.id for r in merge.incremental_new(source, source.filter("id < 3"), "at").collect()] == [3]
    assert merge.incremental_new(source, source.limit(0), "at").count() == 3  # an empty target takes everything
    assert merge.incremental_new(source, source.filter("id < 3"), "at", "10 DAYS").count() == 2


TRACKED = ["v"]
versions = st.lists(
    st.tuples(st.sampled_from("ab"), st.integers(0, 400), st.sampled_from(["x", "y", None])),
    min_size=1, max_size=25, unique_by=lambda r: (r[0], r[1]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(versions)
def test_history_is_contiguous_and_true(spark, data):
    from datetime import timedelta

    df = spark.createDataFrame([(k, T1 + timedelta(days=d), v) for k, d, v in data], "k string, at timestamp_ntz, v string")
    got = {}
    for r in scd.scd2_build(df, "k", TRACKED, "at").orderBy("k", "valid_from").collect():
        got.setdefault(r.k, []).append(r)
    for key, history in got.items():
        assert [r.is_current for r in history] == [False] * (len(history) - 1) + [True]
        assert history[-1].valid_to.year == 9999
        for a, b in zip(history, history[1:]):
            assert a.valid_to == b.valid_from and a.v != b.v
        for k, day, value in data:
            if k == key:
                at = T1 + timedelta(days=day)
                assert [r.v for r in history if r.valid_from <= at < r.valid_to] == [value]


def test_merge_closes_and_opens_in_one_pass(spark):
    first = scd.scd2_build(spark.createDataFrame([("a", T1, "x"), ("b", T1, "y")], "k string, at timestamp_ntz, v string"), "k", TRACKED, "at")
    load2 = spark.createDataFrame([("a", "z"), ("c", "n")], "k string, v string")
    second = scd.scd2_merge(first, load2, "k", TRACKED, "2024-02-01 00:00:00")
    # a returns to its first value: a third version, not a rewrite of the first
    third = scd.scd2_merge(second, spark.createDataFrame([("a", "x")], "k string, v string"), "k", TRACKED, "2024-03-01 00:00:00")
    got = sorted((r.k, r.v, r.is_current, r.valid_from) for r in third.collect())
    assert got == [("a", "x", False, T1), ("a", "x", True, T3), ("a", "z", False, T2), ("b", "y", True, T1), ("c", "n", True, T2)]
    assert third.select("version_sk").distinct().count() == 5
    again = scd.scd2_merge(third, spark.createDataFrame([("a", "x")], "k string, v string"), "k", TRACKED, "2024-04-01 00:00:00")
    assert quality.same_content(third, again).isEmpty()


def test_snapshots_and_vanished_keys(spark):
    schema = "k string, v string, at timestamp_ntz"
    source1 = spark.createDataFrame([("a", "x", T1), ("b", "y", T1)], schema)
    source2 = spark.createDataFrame([("a", "z", T2)], schema)
    start = scd.snapshot_start(source1, ["k", "v", "at"], "at")
    by_time = scd.snapshot_timestamp(start, source2, "k", "at", "2024-03-01 00:00:00")
    assert sorted((r.k, r.v, r.valid_to) for r in by_time.collect() if r.valid_to) == [("a", "x", T2), ("b", "y", T3)]
    by_value = scd.snapshot_check(start, source2, "k", ["v"], "2024-03-01 00:00:00")
    assert sorted((r.k, r.v) for r in by_value.collect() if r.valid_to is None) == [("a", "z"), ("b", "y")]


def test_key_hash_tells_null_positions_apart(spark):
    from tierworks.functions.keys import row_hash, surrogate_key

    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    for make in (lambda: row_hash(["x", "y", "z"]), lambda: surrogate_key("x", "y", "z")):
        assert df.select(make()).distinct().count() == 2


def test_null_and_repeated_keys_merge_once(spark):
    target = spark.createDataFrame([(None, "old"), (1, "one")], "k int, v string")
    source = spark.createDataFrame([(None, "new"), (2, "two")], "k int, v string")
    rows = lambda df: sorted(((r.k or 0, r.v) for r in df.collect()))
    once = merge.merge_upsert(target, source, ["k"])
    assert rows(once) == rows(merge.merge_upsert(once, source, ["k"])) == [(0, "new"), (1, "one"), (2, "two")]
    doubled = source.union(spark.createDataFrame([(2, "another"), (None, "more")], "k int, v string"))
    with pytest.raises(Exception, match="duplicate merge key"):
        merge.merge_upsert(target, doubled, ["k"]).collect()
    added = merge.merge_insert_new(target, doubled, ["k"], [F.col("v")])
    assert rows(added) == [(0, "old"), (1, "one"), (2, "another")]


def test_merge_when_takes_the_callers_condition(spark):
    target = spark.createDataFrame([(1, "a", 5), (2, "b", 5), (None, "c", 5)], "k int, v string, seq int")
    source = spark.createDataFrame([(1, "x", 9), (2, "y", 1), (None, "z", 9), (3, "w", 1)], "k int, v string, seq int")
    got = merge.merge_when(target, source, ["k"], ["v", "seq"], F.col("s.seq") > F.col("t.seq"))
    assert sorted((r.k or 0, r.v) for r in got.collect()) == [(0, "z"), (1, "x"), (2, "b"), (3, "w")]


def test_late_changes_do_not_undo_the_target(spark):
    target = spark.createDataFrame([(1, "new", 9), (2, "b", 1)], "k int, v string, seq int")
    changes = spark.createDataFrame([(1, "late", 3, "U"), (2, "c", 2, "U"), (2, "d", 2, "U")], "k int, v string, seq int, op string")
    got = merge.cdc_apply(target, changes, ["k"], "seq", target_seq="seq", tie_break=[F.col("v").desc()])
    assert sorted((r.k, r.v) for r in got.collect()) == [(1, "new"), (2, "d")]


def test_changes_are_told_by_columns(spark):
    """The joined texts of both rows are the same, the columns are not."""
    first = spark.createDataFrame([(1, "a|b", "c")], "k int, x string, y string")
    second = spark.createDataFrame([(1, "a", "b|c")], "k int, x string, y string")
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    history = scd.scd2_build(first.withColumn("ts", at), "k", ["x", "y"], "ts")
    assert scd.detect_changes(second, history, "k", ["x", "y"]).first().change == "Changed"
    assert scd.scd2_merge(history, second, "k", ["x", "y"], "2024-02-01 00:00:00").count() == 2
    later = second.withColumn("ts", F.lit("2024-03-01 00:00:00").cast("timestamp_ntz"))
    assert scd.scd2_build(first.withColumn("ts", at).union(later), "k", ["x", "y"], "ts").count() == 2
    with pytest.raises(Exception, match="duplicate merge key"):
        scd.scd2_merge(history, second.union(second), "k", ["x", "y"], "2024-02-01 00:00:00").collect()


def test_as_of_with_a_busy_key(spark, monkeypatch):
    import random
    from datetime import timedelta

    from tierworks.operators import joins, sequences

    monkeypatch.setattr(sequences, "CHUNK_ROWS", 20)
    draw, start = random.Random(6), datetime(2024, 1, 1)
    versions = []
    for key, n in (("hot", 60), ("cold", 2), ("late", 1)):
        times = sorted(draw.sample(range(1000), n))
        for k, minute in enumerate(times):
            end = times[k + 1] if k + 1 < n else 2000
            end -= draw.choice([0, 0, 3])  # some gaps
            versions.append((key, f"{key}-{k}", start + timedelta(minutes=minute), start + timedelta(minutes=max(end, minute + 1))))
    versions.append((None, "nobody", start, start + timedelta(days=9)))
    facts = [(draw.choice(["hot", "hot", "hot", "cold", "late", "none", None]), None if k % 50 == 0 else start + timedelta(minutes=draw.randrange(-5, 1100)), k) for k in range(400)]
    facts += [(v[0], v[2], 1000 + k) for k, v in enumerate(versions)] + [(v[0], v[3], 2000 + k) for k, v in enumerate(versions)]
    history = spark.createDataFrame(versions, "k string, label string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    fact = spark.createDataFrame(facts, "k string, at timestamp_ntz, n int")
    got = {r.n: r.label for r in joins.as_of_join(fact, history, "k", "at").collect()}
    want = {n: next((v[1] for v in versions if key and at and v[0] == key and v[2] <= at < v[3]), None) for key, at, n in facts}
    assert got == want


def test_stored_history_touches_only_changed_partitions(spark):
    from tierworks.session import work_dir
    from tierworks.sources import files, sinks

    path = work_dir(spark, "history")
    first = spark.range(300).selectExpr("concat('k', id) AS k", "'old' AS v", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS at")
    history = scd.scd2_build(first, "k", ["v"], "at")
    sinks.publish_history(history, path, "k", parts=16)
    before = {r.path for r in files.list_files(spark, path).collect()}
    load = spark.range(300).selectExpr("concat('k', id) AS k", "CASE WHEN id IN (3, 4) THEN 'new' ELSE 'old' END AS v").union(
        spark.createDataFrame([("added", "new")], "k string, v string"))
    want = sorted(map(tuple, scd.scd2_merge(history, load, "k", ["v"], "2024-02-01 00:00:00").collect()))
    for _ in range(2):  # the second time nothing is new
        sinks.merge_history(load, path, "k", ["v"], "2024-02-01 00:00:00", parts=16)
        got = sorted(map(tuple, spark.read.parquet(path).select(*history.columns).collect()))
        assert got == want
        kept = {r.path for r in files.list_files(spark, path).collect()} & before
        assert len(before) - 3 <= len(kept) < len(before)


def test_a_busy_key_has_the_same_history(spark, monkeypatch):
    from tierworks.operators import sequences

    monkeypatch.setattr(sequences, "CHUNK_ROWS", 9)
    df = spark.range(200).selectExpr(
        "IF(id % 4 = 0, 'rare', 'hot') AS k", "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, id) AS at", "(id DIV 7) % 3 AS v")
    plain, spread = (sorted(map(tuple, scd.scd2_build(df, "k", ["v"], "at", spread=s).collect())) for s in (False, True))
    assert plain == spread and len(plain) > 40
