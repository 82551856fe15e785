"""Exact continuous quantiles per group in two scans, safe for very large groups.

``percentile`` keeps every distinct value of a group in one task.  Here the first scan takes the other aggregates of a
group together with a mergeable sketch, which brackets each wanted rank.  The second scan turns each value, per
quantile, into "below the bracket" or into itself, and counts these before its shuffle: what is below becomes one row
per task, and only the values inside the bracket are ranked.  The sketch's error is bounded, so the bracket holds the
rank; should it ever not, the query fails instead of returning a wrong value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierworks.operators.skew import same_keys

SKETCH_ACCURACY = 100_000


def _summaries(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], others: Sequence[Column], accuracy: int
) -> DataFrame:
    """``others``, the number of values and the brackets of each group."""
    margin = 4.0 / accuracy
    v = F.col(value).cast("double")
    inner = [(max(p - margin, 0.0), min(p + margin, 1.0)) for p in probs.values()]
    summary = df.groupBy(*keys).agg(
        *others, F.count(v).alias("_n"), F.min(v).alias("_min"), F.max(v).alias("_max"),
        F.percentile_approx(v, [edge for pair in inner for edge in pair], accuracy).alias("_edges"),
    )
    # Of a group no larger than the sketch's accuracy all values are inside; the very ends are taken as they are.
    small, brackets = F.col("_n") <= accuracy, []
    for i, (low, high) in enumerate(inner):
        lo = F.when(small | F.lit(low <= 0), F.col("_min")).otherwise(F.col("_edges")[2 * i])
        hi = F.when(small | F.lit(high >= 1), F.col("_max")).otherwise(F.col("_edges")[2 * i + 1])
        brackets.append(F.struct(lo.alias("lo"), hi.alias("hi")))
    # Reading every column keeps the two uses of the summary alike, so that Spark scans and shuffles for it once.
    whole = F.xxhash64(*[c for c in summary.columns if c not in keys]).isNotNull()
    return summary.withColumn("_brackets", F.when(whole, F.array(*brackets))).drop("_min", "_max", "_edges")


def _quantiles(
    df: DataFrame, summary: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float]
) -> DataFrame:
    values = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    bracketed = summary.select(*keys, "_n", "_brackets")
    joined = values.alias("v").join(bracketed.alias("s"), same_keys("v", "s", keys))
    own = [F.col(f"v.{k}").alias(k) for k in keys]
    sides = []
    for i, name in enumerate(probs):
        lo, hi = F.col("_brackets")[i]["lo"], F.col("_brackets")[i]["hi"]
        inside = F.when(F.col("_v") >= lo, F.col("_v"))
        sides.append(F.when(F.col("_v") <= hi, F.struct(F.lit(name).alias("q"), inside.alias("v"))))
    seen = joined.select(*own, "_n", F.explode(F.filter(F.array(*sides), lambda x: x.isNotNull())).alias("e"))
    counts = seen.groupBy(*keys, "_n", "e.q", "e.v").agg(F.count(F.lit(1)).alias("_c"))

    # What is below the bracket has no value and stands first.
    along = W.partitionBy(*keys, "q").orderBy(F.col("v").asc_nulls_first()).rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = counts.withColumn("_upto", F.sum("_c").over(along))
    position = F.element_at(F.create_map(*[x for n, p in probs.items() for x in (F.lit(n), F.lit(float(p)))]), F.col("q")) * (F.col("_n") - 1)
    ranked = ranked.withColumn("_p", position)

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_upto") - F.col("_c") <= rank) & (rank < F.col("_upto")), F.col("v")))

    found = ranked.groupBy(*keys, "q").agg(
        at(F.floor("_p")).alias("_lo"), at(F.ceil("_p")).alias("_hi"), F.max("_p").alias("_p")
    )
    missed = F.raise_error(F.lit("a quantile is outside of its bracket")).cast("double")
    quantile = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_p") - F.floor("_p"))
    found = found.withColumn("_q", F.when(F.col("_lo").isNull() | F.col("_hi").isNull(), missed).otherwise(quantile))
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("q") == n, F.col("_q"))).alias(n) for n in probs])


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """Exact quantiles of groups with a value; every step is combined before its shuffle."""
    return _quantiles(df, _summaries(df, keys, value, probs, [], accuracy), keys, value, probs)


def aggregate_with_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], others: Sequence[Column],
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """``others`` plus exact quantiles of ``value`` per group."""
    summary = _summaries(df, keys, value, probs, others, accuracy)
    base, exact = summary.drop("_n", "_brackets"), _quantiles(df, summary, keys, value, probs)
    joined = base.alias("b").join(exact.alias("e"), same_keys("b", "e", keys), "left")
    return joined.select("b.*", *[F.col(f"e.{n}").alias(n) for n in probs])
