"""Chunked operators against plain windows, with ties, NULL keys and NULL values."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierworks.operators import sequences as seq

SCHEMA = "k string, n int, ts timestamp_ntz, v double"
START = datetime(2024, 1, 1)

rows = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "", None]),
        st.integers(0, 5000),
        st.one_of(st.none(), st.sampled_from([0.0, 1.0, 1.5, 7.25, -3.0])),
    ),
    max_size=40,
    unique_by=lambda r: (r[0], r[1]),
)
#: Rows of a chunk: one chunk per key, or many.
depths = pytest.mark.parametrize("depth", [None, 3])
checked = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, data):
    return spark.createDataFrame([(k, m, START + timedelta(minutes=m), v) for k, m, v in data], SCHEMA)


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    left = sorted((tuple(r) for r in a.select(columns).collect()), key=repr)
    assert left == sorted((tuple(r) for r in b.select(columns).collect()), key=repr)


@depths
@checked
@given(rows)
def test_neighbours(spark, depth, data):
    df = frame(spark, data)
    w = W.partitionBy("k").orderBy("ts")
    want = df.withColumns({"p": F.lag("v").over(w), "q": F.lead("n").over(w)})
    same(seq.with_neighbours(df, ["k"], ["ts"], seq.by_time("ts", depth), {"p": "v"}, {"q": "n"}), want)


@depths
@checked
@given(rows)
def test_row_number(spark, depth, data):
    df = frame(spark, data)
    want = df.withColumn("rn", F.row_number().over(W.partitionBy("k").orderBy("ts")).cast("bigint"))
    same(seq.with_row_number(df, ["k"], ["ts"], seq.by_time("ts", depth), "rn"), want)


@pytest.mark.parametrize("descending", [True, False])
@depths
@checked
@given(rows)
def test_ranks(spark, descending, depth, data):
    df = frame(spark, data)
    w = W.partitionBy("k").orderBy(F.col("v").desc() if descending else F.col("v").asc())
    want = df.withColumns({"r": F.rank().over(w).cast("bigint"), "d": F.dense_rank().over(w).cast("bigint")})
    same(seq.with_ranks(df, ["k"], "v", seq.by_value("v", descending, depth), "r", "d"), want)


@depths
@checked
@given(rows)
def test_running_rows(spark, depth, data):
    df = frame(spark, data)
    w = W.partitionBy("k").orderBy("ts").rowsBetween(W.unboundedPreceding, W.currentRow)
    want = df.withColumns({"s": F.sum("v").over(w), "c": F.count("v").over(w), "a": F.avg("v").over(w)})
    got = seq.with_running(df, ["k"], ["ts"], seq.by_time("ts", depth), "v", avg="a", total="s", count="c")
    same(got, want)


@depths
@checked
@given(rows)
def test_running_with_ties(spark, depth, data):
    df = frame(spark, data).withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    df = df.withColumn("ts", F.when(F.col("n") % 7 != 0, F.col("ts")))
    w = W.partitionBy("k").orderBy("ts")
    want = df.withColumns({"s": F.sum("v").over(w), "c": F.count("v").over(w)})
    got = seq.with_running(
        df, ["k"], ["ts"], seq.by_time("ts", depth), "v", total="s", count="c", share_ties=True
    )
    same(got, want)


@depths
def test_order_may_be_null_once(spark, depth):
    df = spark.createDataFrame([("a", None, 1.0), ("a", START, None), ("a", START + timedelta(days=2), 3.0)],
                               "k string, ts timestamp_ntz, v double")
    w = W.partitionBy("k").orderBy("ts")
    want = df.withColumns({"p": F.lag("v").over(w), "q": F.lead("v").over(w)})
    same(seq.with_neighbours(df, ["k"], ["ts"], seq.by_time("ts", depth), {"p": "v"}, {"q": "v"}), want)


def test_first_rows_limits_before_the_shuffle(spark, capsys):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    out = seq.first_rows(df, ["k"], [F.col("v").desc()], n=2)
    out.explain()
    plan = capsys.readouterr().out
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert sorted(r.v for r in out.collect()) == [94, 95, 96, 97, 98, 99]


def test_chunks_have_one_depth_whatever_the_density(spark):
    """Bursts and an extreme value: chunks of about the same size, and a hundredth of the rows as borders at most."""
    far = F.when(F.col("id") == 7, 10**12).otherwise(F.when(F.col("id") % 3 == 0, F.col("id") * 86400).otherwise(F.col("id")))
    df = spark.range(30_000).select(F.when(F.col("id") % 10 == 0, "few").otherwise("hot").alias("k"), far.alias("at"))
    rows = seq.Ordered.of(df, ["k"], ["at"], seq.by_value("at", rows=1000)).rows
    sizes = rows.where("_busy").groupBy("k", "_chunk").count().collect()
    assert 25 <= len(sizes) <= 60 and max(r["count"] for r in sizes) <= 2000
    assert len(sizes) * 100 <= 30_000
    assert rows.where("not _busy").isEmpty()
    plain = seq.Ordered.of(df, ["k"], ["at"], seq.by_value("at")).rows
    assert plain.where("_busy").isEmpty()
