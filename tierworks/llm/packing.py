"""Best-fit packing of token sequences with large-item matching.

Documents are cut only where they are longer than a sequence. Of pieces above a third of the capacity at most two share
a sequence; they are matched greedily, the largest with the largest that still fits, which leaves the fewest sequences
for them. Smaller pieces then go, largest first, to the sequence with the smallest gap that takes them.

The plan needs only how many pieces there are of each length: at most ``capacity`` rows, whatever the size of the
corpus. Sequences that look alike are handled as one run of sequences, so the plan also stays small. It is a list of
entries "pieces of this length with these ranks go to these sequences at this offset", and each piece finds its own
entry by its length and rank; ranks come from counts per writing task, without sorting or gathering pieces.

Behaviour: null text is an empty one (one token, the end id); repeated rows and equal or null ids are packed as rows of
their own; an empty table gives an empty result; extra columns are not read. Within a length it is arbitrary which
piece takes which place.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierworks.llm.bpe import encoder
from tierworks.llm.common import WORD_BPE, stored

#: Length, first rank, sequences, pieces in each, first sequence, offset.
ENTRY = ("length", "rank", "bins", "each", "first", "offset")


def plan(lengths: dict[int, int], capacity: int) -> np.ndarray:
    """Entries for so many pieces of each length, sorted by length and rank."""
    left = {n: c for n, c in lengths.items() if c}
    if any(n < 1 or n > capacity for n in left):
        raise ValueError("lengths must be from 1 to the capacity")
    entries: list[tuple[int, ...]] = []
    ranks: Counter = Counter()
    gaps: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []
    sequences = 0

    def put(length, bins, each, first, offset):
        entries.append((length, ranks[length], bins, each, first, offset))
        ranks[length] += bins * each

    def free(gap, first, bins):
        if gap and bins:
            if gap not in gaps:
                bisect.insort(order, gap)
                gaps[gap] = []
            gaps[gap].append((first, bins))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        length = large[-1]
        count = left[length]
        at = bisect.bisect_right(large, capacity - length) - 1
        partner = large[at] if at >= 0 else None
        if partner == length and count == 1:
            partner = large[at - 1] if at > 0 else None
        if partner is None:
            pairs, singles = 0, count
        elif partner == length:
            pairs, singles = count // 2, 0
        else:
            pairs, singles = min(count, left[partner]), 0
        if pairs:
            put(length, pairs, 1, sequences, 0)
            put(partner, pairs, 1, sequences, length)
            free(capacity - length - partner, sequences, pairs)
            left[length] -= pairs
            left[partner] -= pairs
        if singles:
            put(length, singles, 1, sequences, 0)
            free(capacity - length, sequences, singles)
            left[length] = 0
        sequences += pairs + singles
        large = [n for n in large if left[n]]

    for length in sorted((n for n in left if left[n]), reverse=True):
        count = left[length]
        while count:
            at = bisect.bisect_left(order, length)
            if at < len(order):
                gap = order[at]
                first, bins = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], order[at]
            else:
                gap, first, bins = capacity, sequences, -(-count // (capacity // length))
                sequences += bins
            each = gap // length
            full = min(bins, count // each)
            if full:
                put(length, full, each, first, capacity - gap)
                free(gap - each * length, first, full)
            count -= full * each
            if full < bins and count:
                put(length, 1, count, first + full, capacity - gap)
                free(gap - count * length, first + full, 1)
                full, count = full + 1, 0
            if gap < capacity:
                free(gap, first + full, bins - full)
    return np.array(sorted(entries), np.int64).reshape(-1, len(ENTRY))


def cut(
    docs: DataFrame, tokenizer: str = WORD_BPE, end_id: int = 1, capacity: int = 4096, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """A row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32`` (and ``ids``), task and rank in the task."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, task = encoder(tokenizer, tree=False), TaskContext.get().partitionId()
        end, seen = np.array([end_id], "<u2").tobytes(), Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows, takes = [], []
                for k, text in enumerate(part.column(1)):
                    ids = np.frombuffer(tool.encode(text.as_py()) + end, "<u2").astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        own = ids[start : start + capacity]
                        data = own.tobytes()
                        rows.append((piece, start, len(own), zlib.crc32(data), seen[len(own)], data if with_ids else None))
                        seen[len(own)] += 1
                        takes.append(k)
                piece, start, length, crc, rank, ids = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(takes)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([task] * len(rows), pa.int32()),
                     pa.array(rank, pa.int64()), *([pa.array(ids, pa.binary())] if with_ids else [])],
                    names=[id_col, "piece", "start", "length", "ids_crc32", "task", "rank", *(["ids"] if with_ids else [])],
                )

    return docs.select(id_col, text_col).mapInArrow(
        run,
        f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, task int, rank bigint"
        + ", ids binary" * with_ids,
    )


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``pieces`` (a written table with ``length``, ``task`` and ``rank``) with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    counts = pieces.groupBy("task", "length").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))), "piece-counts")
    sizes = counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()  # at most ``capacity`` rows
    shared = spark.sparkContext.broadcast(plan({r["length"]: r["n"] for r in sizes}, capacity))
    ranked = pieces.join(counts.drop("_n").hint("merge"), ["task", "length"]).withColumn("rank", F.col("rank") + F.col("_before"))
    names = [c for c in pieces.columns if c not in ("task", "rank")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = shared.value
        keys = (entries[:, 0] << 44) | entries[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = entries[np.searchsorted(keys, (length << 44) | rank, side="right") - 1]
            turn = rank - at[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(at[:, 4] + turn // at[:, 3], pa.int64()),
                 pa.array(at[:, 5] + turn % at[:, 3] * length, pa.int64())],
                names=[*names, "sequence_id", "offset"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema}
    schema = ", ".join(f"`{n}` {kinds[n]}" for n in names) + ", sequence_id bigint, offset bigint"
    return ranked.select(*names, "rank").mapInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id``, its ``ids`` (32-bit, binary) and ``lengths``, from packed pieces cut with their ids."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))  # at most ``capacity`` pieces
    return packed.groupBy("sequence_id").agg(inside.alias("_in")).select(
        "sequence_id", F.expr("aggregate(_in, X'', (a, x) -> concat(a, x.ids))").alias("ids"),
        F.col("_in.length").alias("lengths"),
    )


def pack_documents(docs: DataFrame, capacity: int = 4096, **options) -> DataFrame:
    """Cut and packed: a row per piece."""
    return pack(stored(cut(docs, capacity=capacity, **options), "pieces"), capacity)
