"""Ordered operations per key that stay spread when one key owns much of the data.

A plain ``Window.partitionBy(key)`` sorts all rows of a key in one task.  Here busy keys are cut into chunks of about
``CHUNK_ROWS`` rows along the order column, at borders that are order statistics of the key itself, so any density and
any outlier gives chunks of the same depth.  Rows are windowed inside (key, chunk); counts, sums and edge values go over
the borders in a table with one row per chunk.  Keys below that size are one chunk and need no border row, which
keeps that table under a hundredth of the rows.

What is broadcast is bounded by construction: at most ``BUSY_KEYS`` keys (the largest) are cut, into ``2 * BUSY_KEYS``
chunks in all and ``QUANTILES`` at most per key; a window over borders never holds more rows than that.  Rows of one key
that are equal in the column that is cut are one chunk; ranks and shared running values deal such rows out again.
The plan is the same at every size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_ROWS = 100_000
BUSY_KEYS = 16_384
QUANTILES = 512
SAMPLE_ROWS = 4096  # of a chunk
FINE = 32  # edges under one coarse edge
_SALT = 64  # parts of a chunk of equal values

_CHUNK, _NULLS, _BUSY, _CUT = "_chunk", "_nulls", "_busy", "_cut"


@dataclass(frozen=True)
class Chunks:
    """How keys are cut: ``expr`` (a number, date or time) must rise, or fall, along with the order."""

    expr: Column
    descending: bool = False
    rows: int | None = None


def by_time(ts: str, rows: int | None = None) -> Chunks:
    return Chunks(F.col(ts), rows=rows)


def by_value(value: str, descending: bool = False, rows: int | None = None) -> Chunks:
    return Chunks(F.col(value), descending, rows)


def _filler(kind: T.DataType) -> Column:
    """Any non-null value of a type."""
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(kind)
    if isinstance(kind, T.BooleanType):
        return F.lit(False)
    return F.lit(0).cast(kind)


def _without_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill NULLs in grouping columns and note in ``_nulls`` which ones were filled, so that plain equality matches NULL groups."""
    mask = F.lit(0)
    for i, c in enumerate(columns):
        mask = mask + F.when(F.col(c).isNull(), 1 << i).otherwise(0)
    filled = {c: F.coalesce(F.col(c), _filler(df.schema[c].dataType)) for c in columns}
    return df.withColumn(_NULLS, mask).withColumns(filled)


def _busy_edges(rows: DataFrame, group: Sequence[str], target: int) -> DataFrame:
    """Inner edges of the chunks of each key that is cut, in order, from a sample that grows with the rows.

    The sample decides where keys are cut and nothing else; it is combined before its shuffle.
    """
    share = min(1.0, SAMPLE_ROWS / target)
    drawn = rows.select(*group, _CUT).sample(share, 1) if share < 1 else rows
    found = drawn.groupBy(*group).agg((F.count(F.lit(1)) / share).alias("_n"), quantile_edges(_CUT, QUANTILES).alias("_q"))
    busy = found.where(F.col("_n") > target).orderBy(F.desc("_n")).limit(BUSY_KEYS)
    depth = F.greatest(F.lit(float(target)), F.sum("_n").over(W.partitionBy()) / BUSY_KEYS)
    step = F.ceil(QUANTILES * F.least(depth / F.col("_n"), F.lit(1.0)))
    every = F.array_distinct(F.filter("_q", lambda x, i: (i + 1) % F.col("_step") == 0))
    return busy.withColumn("_step", step).select(*group, F.coalesce(every, F.array()).alias("_edges"))


def place_among(value: Column, edges: Column, coarse: Column) -> Column:
    """How many edges, which are in order, are not above a value; ``coarse`` is every ``FINE``-th of them."""
    under = F.size(F.filter(coarse, lambda e: e <= value)) * FINE
    return under + F.size(F.filter(F.slice(edges, under + 1, FINE), lambda e: e <= value))


def quantile_edges(column: str, n: int) -> Column:
    """The inner edges of ``n`` parts of equal size, as an aggregate."""
    # One literal instead of many: plans with long lists of them are slow to build.
    ranks = ",".join(f"{i / n:.8f}" for i in range(1, n))
    return F.percentile_approx(column, F.split(F.lit(ranks), ",").cast("array<double>"), n * 8)


def every_fine(edges: str | Column) -> Column:
    return F.filter(edges, lambda x, i: (i + 1) % FINE == 0)


def _cut(df: DataFrame, keys: Sequence[str], chunks: Chunks) -> DataFrame:
    """Rows with the chunk they are in (0 where the key is not cut) and whether their key is cut.

    Chunk numbers rise along the order; NULLs of a key that is cut stand at the end Spark sorts them to.
    """
    rows, group = _without_nulls(df.withColumn(_CUT, chunks.expr), keys), [*keys, _NULLS]
    edges = _busy_edges(rows, group, chunks.rows or CHUNK_ROWS)
    at = F.col(_CUT)
    place = place_among(at, F.col("_edges"), every_fine("_edges"))
    number = F.when(at.isNull(), 1).otherwise(-place) if chunks.descending else F.when(at.isNull(), -1).otherwise(place)
    busy = F.col("_edges").isNotNull()
    marked = rows.join(F.broadcast(edges), group, "left").withColumns({_CHUNK: F.when(busy, number).otherwise(0), _BUSY: busy})
    return marked.drop("_edges")


@dataclass(frozen=True)
class Ordered:
    """Rows cut into chunks along an order.  Operations can follow each other and share one shuffle."""

    rows: DataFrame
    keys: tuple[str, ...]
    order: tuple[str | Column, ...]
    columns: tuple[str, ...]
    whole: bool = False

    @classmethod
    def of(cls, df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], chunks: Chunks | None) -> Ordered:
        """``chunks`` may be left out (None) where the caller knows a small bound of the rows of a key, as of loads."""
        if chunks is None:
            rows = _without_nulls(df, keys).withColumns({_CHUNK: F.lit(0), _BUSY: F.lit(False)})
        else:
            rows = _cut(df, keys, chunks)
        return cls(rows, tuple(keys), tuple(order), tuple(df.columns), chunks is None)

    @property
    def group(self) -> list[str]:
        return [*self.keys, _NULLS]

    @property
    def ids(self) -> list[str]:
        return [*self.group, _CHUNK]

    def _inside(self):
        return W.partitionBy(*self.ids).orderBy(*self.order)

    def _along(self):
        return W.partitionBy(*self.group).orderBy(_CHUNK)

    def _earlier(self):
        return self._along().rowsBetween(W.unboundedPreceding, -1)

    def _position(self) -> Column:
        # One plain column keeps an aggregation by position a hash aggregation.
        order = [F.col(c) if isinstance(c, str) else c for c in self.order]
        return order[0] if len(order) == 1 else F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)])

    def _joined(self, rows: DataFrame, aggregates: Sequence[Column], carried: Mapping[str, Column]) -> DataFrame:
        """Rows with what reaches their chunk from other chunks: a row per chunk of the keys that are cut."""
        edges = self.rows.where(F.col(_BUSY)).groupBy(*self.ids).agg(*aggregates)
        borders = edges.withColumns(dict(carried)).select(*self.ids, *carried)
        if self.whole:  # none is cut
            return rows.withColumns({c: F.lit(None).cast(borders.schema[c].dataType) for c in carried})
        return rows.join(F.broadcast(borders), self.ids, "left")

    def _with(self, rows: DataFrame, added: Mapping[str, Column]) -> Ordered:
        own = [*self.columns, _NULLS, _CHUNK, _BUSY]
        return replace(
            self, rows=rows.select(*own, *[c.alias(n) for n, c in added.items()]), columns=(*self.columns, *added)
        )

    def where(self, condition: Column) -> Ordered:
        return replace(self, rows=self.rows.where(condition))

    def with_columns(self, added: Mapping[str, Column]) -> Ordered:
        return self._with(self.rows, added)

    def neighbours(self, lag: Mapping[str, str], lead: Mapping[str, str]) -> Ordered:
        """Values of the row before (``lag``) and behind (``lead``), as new name to source column."""
        position = self._position()

        def edge(choose, column: str) -> Column:
            # Only rows without any position, a chunk of their own, are not found by it.
            return F.when(F.count(position) > 0, choose(column, position)).otherwise(F.any_value(column))

        edges = [edge(F.max_by, c).alias(f"_last_{n}") for n, c in lag.items()]
        edges += [edge(F.min_by, c).alias(f"_first_{n}") for n, c in lead.items()]
        local, carried = {}, {}
        if lag:
            local["_lag"] = F.lag(F.struct(*[F.col(c).alias(n) for n, c in lag.items()])).over(self._inside())
            carried["_before"] = F.lag(F.struct(*[F.col(f"_last_{n}").alias(n) for n in lag])).over(self._along())
        if lead:
            local["_lead"] = F.lead(F.struct(*[F.col(c).alias(n) for n, c in lead.items()])).over(self._inside())
            carried["_after"] = F.lead(F.struct(*[F.col(f"_first_{n}").alias(n) for n in lead])).over(self._along())
        out = self._joined(self.rows.withColumns(local), edges, carried)

        def pick(near: str, far: str, name: str) -> Column:
            return F.when(F.col(near).isNotNull(), F.col(f"{near}.{name}")).otherwise(F.col(f"{far}.{name}"))

        added = {n: pick("_lag", "_before", n) for n in lag} | {n: pick("_lead", "_after", n) for n in lead}
        return self._with(out, added)

    def carry_last(self, column: str, out: str) -> Ordered:
        """The last non-null ``column`` up to each row."""
        known = F.col(column).isNotNull()
        last = F.max_by(column, F.when(known, self._position())).alias("_last")
        carried = {"_before": F.last("_last", ignorenulls=True).over(self._earlier())}
        local = F.last(column, ignorenulls=True).over(self._inside().rowsBetween(W.unboundedPreceding, W.currentRow))
        rows = self._joined(self.rows.withColumn("_near", local), [last], carried)
        return self._with(rows, {out: F.coalesce("_near", "_before")})

    def row_number(self, out: str) -> Ordered:
        carried = {"_n0": F.sum("_n").over(self._earlier())}
        rows = self.rows.withColumn("_row", F.row_number().over(self._inside()))
        rows = self._joined(rows, [F.count(F.lit(1)).alias("_n")], carried)
        return self._with(rows, {out: F.col("_row") + F.coalesce("_n0", F.lit(0).cast("bigint"))})

    def running(
        self, value: str, avg: str | None = None, total: str | None = None, count: str | None = None, share_ties: bool = False
    ) -> Ordered:
        """Running average, sum and count of ``value``; each row ends its own frame, or rows equal in the one order
        column share a result (``share_ties``)."""
        aggregates = [F.sum(value).alias("_ts"), F.count(value).alias("_tc")]
        carried = {"_s0": F.sum("_ts").over(self._earlier()), "_c0": F.sum("_tc").over(self._earlier())}
        rows, window = self.rows, self._inside()
        s, c = F.sum(value), F.count(value)
        if share_ties:
            at = F.col(self.order[0])
            aggregates += [F.min(at).eqNullSafe(F.max(at)).alias("_one")]
            carried |= {"_ts": F.col("_ts"), "_tc": F.col("_tc"), "_one": F.col("_one")}
            rows = _dealt_out(self._joined(rows, aggregates, carried))
            window = W.partitionBy(*self.ids, "_salt").orderBy(*self.order)
            equal = F.coalesce("_one", F.lit(False))
            rows = rows.withColumns({"_s": F.when(equal, F.col("_ts")).otherwise(s.over(window)),
                                     "_c": F.when(equal, F.col("_tc")).otherwise(c.over(window))})
        else:
            frame = window.rowsBetween(W.unboundedPreceding, W.currentRow)
            rows = rows.withColumns({"_s": s.over(frame), "_c": c.over(frame)})
            rows = self._joined(rows, aggregates, carried)
        n = F.coalesce(F.col("_c"), F.lit(0)) + F.coalesce(F.col("_c0"), F.lit(0))
        both = F.coalesce(F.col("_s"), F.lit(0)) + F.coalesce(F.col("_s0"), F.lit(0))
        both = F.when(F.col("_s").isNotNull() | F.col("_s0").isNotNull(), both)
        named = ((avg, both / F.nullif(n, F.lit(0))), (total, both), (count, n))
        return self._with(rows, {name: column for name, column in named if name})

    def ranks(self, value: str, rank: str, dense_rank: str) -> Ordered:
        """rank and dense_rank along ``value``, which is the order and what was cut."""
        counted = self.rows.where(F.col(_BUSY)).groupBy(*self.ids, value).agg(F.count(F.lit(1)).alias("_n"))
        totals = counted.groupBy(*self.ids).agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_d"))
        borders = totals.select(
            *self.ids, (F.col("_d") == 1).alias("_one"),
            F.sum("_n").over(self._earlier()).alias("_n0"), F.sum("_d").over(self._earlier()).alias("_d0"),
        )
        rows = _dealt_out(self.rows.join(F.broadcast(borders), self.ids, "left"))
        window = W.partitionBy(*self.ids, "_salt").orderBy(*self.order)
        rows = rows.withColumns({"_rank": F.rank().over(window), "_dense": F.dense_rank().over(window)})
        none = F.lit(0).cast("bigint")
        return self._with(rows, {
            rank: F.col("_rank") + F.coalesce("_n0", none), dense_rank: F.col("_dense") + F.coalesce("_d0", none),
        })

    def frame(self, *columns: str) -> DataFrame:
        """The rows with their keys as they were."""
        original = {
            c: F.when(F.col(_NULLS).bitwiseAND(F.lit(1 << i)) == 0, F.col(c)).alias(c)
            for i, c in enumerate(self.keys)
        }
        return self.rows.select(*[original.get(c, F.col(c)) for c in columns or self.columns])


def _dealt_out(rows: DataFrame) -> DataFrame:
    """``_salt`` parts chunks whose rows are all equal (``_one``), in which the order says nothing."""
    part = F.when(F.col("_one"), F.pmod(F.spark_partition_id(), F.lit(_SALT))).otherwise(0)
    return rows.withColumn("_salt", part)


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunks: Chunks,
    lag: Mapping[str, str] | None = None,
    lead: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add values of the previous (``lag``) and next (``lead``) row of the key.

    ``lag`` and ``lead`` map new column names to source columns; rows that are equal
    in ``order`` stand in an arbitrary order to each other, so end it with a tie-break.
    """
    return Ordered.of(df, keys, order, chunks).neighbours(dict(lag or {}), dict(lead or {})).frame()


def with_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunks: Chunks, out: str) -> DataFrame:
    """Position of each row of a key in ascending ``order``; see ``with_neighbours`` about ties."""
    return Ordered.of(df, keys, order, chunks).row_number(out).frame()


def with_ranks(df: DataFrame, keys: Sequence[str], value: str, chunks: Chunks, rank: str, dense_rank: str) -> DataFrame:
    """rank and dense_rank of ``value`` inside each key."""
    order = F.col(value).desc() if chunks.descending else F.col(value).asc()
    return Ordered.of(df, keys, [order], chunks).ranks(value, rank, dense_rank).frame()


def with_running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunks: Chunks,
    value: str,
    avg: str | None = None,
    total: str | None = None,
    count: str | None = None,
    share_ties: bool = False,
) -> DataFrame:
    """Running average, sum and count of ``value``.

    Each row ends its own frame (ROWS).  With ``share_ties`` rows equal in the one
    order column share a result (the default RANGE frame).
    """
    return Ordered.of(df, keys, order, chunks).running(value, avg, total, count, share_ties).frame()


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows per key.

    Spark evaluates the limit before the shuffle as well (WindowGroupLimit), so
    each task sends at most ``n`` rows per key and busy keys stay cheap.
    """
    name = rank or "_rn"
    w = W.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return out if rank else out.drop(name)
