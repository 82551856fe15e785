"""Nearest neighbours by an inverted multi-index.

Vectors are halved and each half has a codebook of its own, so ``centroids`` squared cells come from two small
codebooks. The codebooks are fitted on a bounded sample; every vector is indexed, as part of blocks of one cell (at
most ``BLOCK`` vectors), so a cell with a third of all vectors is many blocks. A cell knows the radius of its vectors in
both halves.

A query walks the cells by the sum of its two squared centroid distances, with a heap over the two sorted lists, until
the cells hold ``enough`` vectors. Its entries are reranked on the original vectors in double precision. The distance of
the last of the k found then bounds the rest: every further cell that could hold something nearer, by its centroids and
radii, is read as well. No vector is skipped that could belong to the result, so the neighbours are the exact ones.

Behaviour: vectors that are null, zero, of another length than most of the sample, or hold null or non-finite components
take no part, nor do null ids; rows with a query's own id are not its neighbours; equal distances go to the smaller id;
an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierworks.llm.common import stored

SAMPLE, CENTROIDS, ROUNDS = 8192, 32, 12
BLOCK, TASK_ROWS = 512, 32768
QUERY_BLOCK = 128


def _valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    usable = F.expr(
        f"`{vector_col}` is not null and `{id_col}` is not null"
        f" and forall(`{vector_col}`, x -> coalesce(cast(x as double) between -1.7976931348623157e308 and 1.7976931348623157e308, false))"
        f" and exists(`{vector_col}`, x -> x <> 0)"
    )
    return vectors.where(usable).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")
    )


def _codebook(points: np.ndarray, count: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids by k-means from distinct first points."""
    centres = np.unique(points, axis=0)
    centres = centres[np.linspace(0, len(centres) - 1, min(count, len(centres))).astype(int)].copy()
    for _ in range(rounds):
        near = _squares(points, centres).argmin(axis=1)
        for k in range(len(centres)):
            if (own := near == k).any():
                centres[k] = points[own].mean(axis=0)
    return centres


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows, in blocks of bounded size."""
    out = np.empty((len(a), len(b)))
    for at in range(0, len(a), 1024):
        out[at : at + 1024] = ((a[at : at + 1024, None, :] - b[None]) ** 2).sum(axis=2)
    return out


def _matrix(column) -> np.ndarray:
    return np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def fit(vectors: DataFrame, centroids: int = CENTROIDS, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray] | None:
    """Codebooks of both halves from the ``sample`` vectors with the smallest hash; none if there are no vectors."""
    rows = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).collect()
    if not rows:
        return None
    width = Counter(len(r["vector"]) for r in rows).most_common(1)[0][0]
    points = np.array([r["vector"] for r in rows if len(r["vector"]) == width])
    half = max(1, width // 2)
    return _codebook(points[:, :half], centroids), _codebook(points[:, half:], centroids)


def index(vectors: DataFrame, books) -> DataFrame:
    """Blocks: ``cell``, ``n``, ``r1`` and ``r2`` (largest distances to the centroids), ``ids`` and ``data``."""
    first, second = books
    half = first.shape[1]

    def blocks(ids: np.ndarray, data: np.ndarray):
        d1, d2 = _squares(data[:, :half], first), _squares(data[:, half:], second)
        i, j = d1.argmin(axis=1), d2.argmin(axis=1)
        cell, at = i * len(second) + j, np.arange(len(ids))
        r1, r2 = np.sqrt(d1[at, i]), np.sqrt(d2[at, j])
        order = np.argsort(cell, kind="stable")
        edges = np.flatnonzero(np.diff(cell[order])) + 1
        for own in np.split(order, edges):
            for k in range(0, len(own), BLOCK):
                some = own[k : k + BLOCK]
                yield int(cell[some[0]]), len(some), float(r1[some].max()), float(r2[some].max()), ids[some].tobytes(), data[some].tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, data, held = [], [], 0

        def emit():
            rows = list(blocks(np.concatenate(ids), np.concatenate(data)))
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["cell", "n", "r1", "r2", "ids", "data"]
            )

        for batch in batches:
            if batch.num_rows:
                ids.append(batch.column(0).to_numpy(zero_copy_only=False).astype("<i8"))
                data.append(_matrix(batch.column(1)).astype("<f8"))
                held += batch.num_rows
            if held >= TASK_ROWS:
                yield emit()
                ids, data, held = [], [], 0
        if held:
            yield emit()

    width = half + second.shape[1]
    return vectors.where(F.size("vector") == width).mapInArrow(
        run, "cell bigint, n bigint, r1 double, r2 double, ids binary, data binary"
    )


def walk(d1: np.ndarray, d2: np.ndarray, counts: np.ndarray, enough: int) -> list[int]:
    """Cells by ascending sum of squared distances, until they hold ``enough`` vectors."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    heap, seen, cells, held = [(d1[o1[0]] + d2[o2[0]], 0, 0)], {(0, 0)}, [], 0
    while heap and held < enough:
        _, a, b = heapq.heappop(heap)
        cell = int(o1[a]) * len(d2) + int(o2[b])
        if counts[cell]:
            cells.append(cell)
            held += int(counts[cell])
        for x, y in ((a + 1, b), (a, b + 1)):
            if x < len(o1) and y < len(o2) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (d1[o1[x]] + d2[o2[y]], x, y))
    return cells


def _distances(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Exact distances: squares are added component by component, as a plain sum is."""
    total = np.zeros((len(queries), len(data)))
    for d in range(queries.shape[1]):
        step = queries[:, d, None] - data[None, :, d]
        total += step * step
    return np.sqrt(total)


def search(
    vectors: DataFrame, is_query: str, k: int = 10, enough: int = 512, centroids: int = CENTROIDS, sample: int = SAMPLE,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest others of each row for which ``is_query`` (SQL on ``id``) holds.

    Columns: ``query_id``, ``rank``, ``vec_id``, ``score``.
    """
    rows = _valid(vectors, id_col, vector_col)
    books = fit(rows, centroids, sample)
    if books is None:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).where("false")
    first, second = books
    half, width, n_cells = first.shape[1], first.shape[1] + second.shape[1], len(first) * len(second)
    blocks = stored(index(rows, books), "multi-index")
    counts, r1, r2 = np.zeros(n_cells, np.int64), np.zeros(n_cells), np.zeros(n_cells)
    for r in blocks.groupBy("cell").agg(F.sum("n").alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")).collect():
        counts[r["cell"]], r1[r["cell"]], r2[r["cell"]] = r["n"], r["r1"], r["r2"]  # a row per cell: centroids squared

    def asked(further: bool):
        """Blocks of queries for each cell that they visit: in the walk, or beyond it within the bound."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, QUERY_BLOCK):
                    part = batch.slice(at, QUERY_BLOCK)
                    ids = part.column(0).to_numpy(zero_copy_only=False)
                    data = _matrix(part.column(1))
                    bound = part.column(2).to_numpy(zero_copy_only=False)
                    d1, d2 = _squares(data[:, :half], first), _squares(data[:, half:], second)
                    visits: dict[int, list[int]] = {}
                    for q in range(len(ids)):
                        near = walk(d1[q], d2[q], counts, enough)
                        if further:
                            low = np.maximum(0, np.sqrt(d1[q])[:, None] - r1.reshape(len(first), -1)) ** 2
                            low += np.maximum(0, np.sqrt(d2[q])[None, :] - r2.reshape(len(first), -1)) ** 2
                            could = (low.ravel() * (1 - 1e-9) - 1e-12 <= bound[q] ** 2) & (counts > 0)
                            could[near] = False
                            near = np.flatnonzero(could).tolist()
                        for cell in near:
                            visits.setdefault(cell, []).append(q)
                    if visits:
                        lists = [np.array(v) for v in visits.values()]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(list(visits), pa.int64()), pa.array([ids[v].astype("<i8").tobytes() for v in lists], pa.binary()),
                             pa.array([data[v].tobytes() for v in lists], pa.binary()),
                             pa.array([bound[v].tobytes() for v in lists], pa.binary())],
                            names=["cell", "q_ids", "q_data", "q_bound"],
                        )

        return run

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[float, int]]] = {}

        def emit():
            flat = [(q, v, d) for q, found in best.items() for d, v in found]
            q, v, d = zip(*flat) if flat else ((), (), ())
            best.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(d, pa.float64())], names=["query_id", "vec_id", "score"]
            )

        for batch in batches:
            for ids, data, q_ids, q_data, q_bound in zip(*(c.to_pylist() for c in batch.columns)):
                ids, q_ids = np.frombuffer(ids, "<i8"), np.frombuffer(q_ids, "<i8")
                bound = np.frombuffer(q_bound, "<f8").copy()
                for a, q in enumerate(q_ids.tolist()):
                    if len(best.get(q, ())) == k:
                        bound[a] = min(bound[a], best[q][-1][0])
                far = _distances(np.frombuffer(q_data, "<f8").reshape(-1, width), np.frombuffer(data, "<f8").reshape(-1, width))
                fits = (far <= bound[:, None]) & (ids[None, :] != q_ids[:, None])
                for a in np.flatnonzero(fits.any(axis=1)).tolist():
                    own = np.flatnonzero(fits[a])
                    if len(own) > k:
                        own = own[np.lexsort((ids[own], far[a, own]))[:k]]
                    old = best.get(int(q_ids[a]), [])
                    best[int(q_ids[a])] = heapq.nsmallest(k, [*old, *zip(far[a, own].tolist(), ids[own].tolist())])
                if len(best) > 20_000:
                    yield emit()
        yield emit()

    def found(queries: DataFrame, further: bool) -> DataFrame:
        cells = queries.select("id", "vector", "bound").mapInArrow(asked(further), "cell bigint, q_ids binary, q_data binary, q_bound binary")
        met = blocks.select("cell", "ids", "data").join(cells, "cell").select("ids", "data", "q_ids", "q_data", "q_bound")
        return met.mapInArrow(rerank, "query_id bigint, vec_id bigint, score double")

    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    top = lambda df: df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    queries = rows.where(f"{is_query}").where(F.size("vector") == width)
    near = stored(top(found(queries.withColumn("bound", F.lit(float("inf"))), False)), "near")
    bounds = near.groupBy("query_id").agg(F.when(F.count("*") >= k, F.max("score")).alias("_bound"))
    bounded = queries.join(bounds, F.col("id") == F.col("query_id"), "left").select(
        "id", "vector", F.coalesce("_bound", F.lit(float("inf"))).alias("bound")
    )
    both = near.drop("rank").union(found(bounded, True))
    return top(both).select("query_id", "rank", "vec_id", "score")
