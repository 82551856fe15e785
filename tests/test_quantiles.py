"""The way for hot groups gives the same quantiles as the plain one."""

import random

import pytest
from pyspark.sql import functions as F

from tierworks.operators.quantiles import aggregate_with_quantiles, exact_quantiles

PROBS = {"median": 0.5, "p95": 0.95, "p0": 0.0, "p100": 1.0}


def data(spark, seed):
    r = random.Random(seed)
    rows = []
    for key, n in (("a", 2000), ("b", 7), ("c", 1), (None, 300)):
        for _ in range(n):
            value = r.choice([r.gauss(0, 1), 5.0, 1e6 * r.random()])
            rows.append((key, None if r.random() < 0.05 else value))
    return spark.createDataFrame(rows, "k string, v double")


def collected(df):
    return {r.k: [r[c] for c in PROBS] for r in df.collect()}


@pytest.mark.parametrize("accuracy", [10, 100, 100_000])
def test_exact_quantiles_are_exact(spark, accuracy):
    df = data(spark, accuracy).filter("v IS NOT NULL")
    plain = df.groupBy("k").agg(*[F.percentile("v", p).alias(n) for n, p in PROBS.items()])
    got, want = collected(exact_quantiles(df, ["k"], "v", PROBS, accuracy)), collected(plain)
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key], rel=1e-12)


def test_with_other_measures(spark):
    df = data(spark, 1)
    others = [F.count(F.lit(1)).alias("n"), F.max("v").alias("top")]
    got = aggregate_with_quantiles(df, ["k"], "v", PROBS, others)
    plain = df.groupBy("k").agg(*others, *[F.percentile("v", p).alias(n) for n, p in PROBS.items()])
    a, b = collected(got), collected(plain)
    assert a.keys() == b.keys()
    for key in b:
        assert a[key] == pytest.approx(b[key], rel=1e-12)
    assert {r.k: (r.n, r.top) for r in got.collect()} == {r.k: (r.n, r.top) for r in plain.collect()}
