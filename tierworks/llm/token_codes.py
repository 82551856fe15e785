"""Token ids in files of directly addressable codes.

An id is cut into chunks of eight bits. Level 0 holds the lowest chunk of every token; a bitmap says which tokens go on
in level 1, and so forth. A rank directory (a count per 512 bits and one per 64 bits) tells how many tokens before a
given one go on, which is the place of its next chunk, so any token is reached with a few array reads and nothing
before it is decoded.

Written files: Parquet folders with one row per segment (about a million tokens, whole documents) in ascending document
order: ``shard``, ``segment``, ``first`` (tokens of the shard before it), ``n_tokens``, the ids and places of its
documents, and ``payload``, a segment as laid out by :func:`pack_codes`. Parquet writing gives committed, repeatable
output on any store; the payload column is stored uncompressed.

Behaviour: null text is an empty one and has only its end id; null document ids come first; repeated rows and equal ids
each keep an entry of their own, ordered by a hash of the text; an empty table gives an empty folder and result; extra
columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierworks.llm.bpe import encoder
from tierworks.llm.common import BYTE_BPE

MAGIC = b"TWDC"
SEGMENT_TOKENS = 1 << 20


def pack_codes(ids: np.ndarray) -> bytes:
    """Header (magic, levels, tokens), then per level: count, chunks, and if more follow: bitmap and directory."""
    levels, rest = [], np.ascontiguousarray(ids, dtype="<u4")
    while True:
        low, rest = (rest & 0xFF).astype("u1"), rest >> 8
        more = rest > 0
        rest = rest[more]
        body = struct.pack("<Q", len(low)) + low.tobytes() + b"\0" * (-len(low) % 8)
        if not len(rest):
            levels.append(body)
            break
        bits = np.zeros(-(-len(low) // 512) * 512, bool)
        bits[: len(more)] = more
        words = np.packbits(bits, bitorder="little").view("<u8")
        ones = np.bitwise_count(words).astype("<u8").reshape(-1, 8)
        per_block = ones.sum(axis=1)
        blocks = (np.cumsum(per_block) - per_block).astype("<u8")
        within = (np.cumsum(ones, axis=1) - ones).astype("<u2")
        levels.append(body + words.tobytes() + blocks.tobytes() + within.tobytes())
    return MAGIC + struct.pack("<IQ", len(levels), len(ids)) + b"".join(levels)


class Codes:
    """A packed segment; ``get`` reads the tokens at any positions."""

    def __init__(self, payload: bytes) -> None:
        if payload[:4] != MAGIC:
            raise ValueError("not a segment of token codes")
        n_levels, self.n = struct.unpack_from("<IQ", payload, 4)
        self.levels, at = [], 16
        for level in range(n_levels):
            (count,) = struct.unpack_from("<Q", payload, at)
            at += 8
            chunks = np.frombuffer(payload, "u1", count, at)
            at += count + -count % 8
            if level + 1 == n_levels:
                self.levels.append((chunks, None, None, None))
                break
            n_blocks = -(-count // 512)
            words = np.frombuffer(payload, "<u8", n_blocks * 8, at)
            blocks = np.frombuffer(payload, "<u8", n_blocks, at + n_blocks * 64)
            within = np.frombuffer(payload, "<u2", n_blocks * 8, at + n_blocks * 72)
            at += n_blocks * 88
            self.levels.append((chunks, words, blocks, within))

    def get(self, positions: np.ndarray) -> np.ndarray:
        """Ids at ``positions`` of the segment, in the order asked for."""
        place = np.asarray(positions, dtype=np.int64)
        ids = np.zeros(len(place), "<u4")
        alive = np.arange(len(place))
        for level, (chunks, words, blocks, within) in enumerate(self.levels):
            ids[alive] |= chunks[place].astype("<u4") << np.uint32(8 * level)
            if words is None:
                break
            word, bit = words[place >> 6], (place & 63).astype("<u8")
            goes_on = (word >> bit) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            rank = blocks[place >> 9].astype(np.int64) + within[place >> 6] + np.bitwise_count(below)
            alive, place = alive[goes_on], rank[goes_on]
        return ids


def write_codes(
    docs: DataFrame, path: str, tokenizer: str = BYTE_BPE, end_id: int = 2, segment_tokens: int = SEGMENT_TOKENS,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Encodes whole texts, each followed by ``end_id``, and writes them in ascending order of ``id_col``."""
    kind = docs.schema[id_col].dataType.simpleString()
    arrow_kind = pa.int64() if kind == "bigint" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, shard = encoder(tokenizer, tree=False), TaskContext.get().partitionId()
        end = np.array([end_id], "<u2").tobytes()
        names, sizes, parts, held, first, segment = [], [], [], 0, 0, 0

        def segment_row():
            starts = np.cumsum([0, *sizes[:-1]])
            ids = np.frombuffer(b"".join(parts), "<u2")
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([segment], pa.int32()), pa.array([first], pa.int64()),
                 pa.array([held], pa.int64()), pa.array([names], pa.list_(arrow_kind) if arrow_kind else None),
                 pa.array([starts.tolist()], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
                 pa.array([pack_codes(ids)], pa.binary())],
                names=["shard", "segment", "first", "n_tokens", "doc_ids", "starts", "sizes", "payload"],
            )

        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1)):
                ids = tool.encode(text.as_py()) + end
                names.append(name.as_py())
                sizes.append(len(ids) // 2)
                parts.append(ids)
                held += sizes[-1]
                if held >= segment_tokens:
                    yield segment_row()
                    first, segment = first + held, segment + 1
                    names, sizes, parts, held = [], [], [], 0
        if names:
            yield segment_row()

    schema = (
        f"shard int, segment int, first bigint, n_tokens bigint, doc_ids array<{kind}>, starts array<bigint>, "
        "sizes array<bigint>, payload binary"
    )
    rows = docs.select(F.col(id_col), F.col(text_col)).withColumn("_tie", F.xxhash64(F.col(text_col)))
    (
        rows.repartitionByRange(F.col(id_col).asc_nulls_first(), "_tie")
        .sortWithinPartitions(F.col(id_col).asc_nulls_first(), "_tie")
        .select(id_col, text_col)
        .mapInArrow(run, schema)
        .write.option("compression", "none")
        .parquet(path)
    )


def _shards(spark: SparkSession, path: str) -> DataFrame:
    """Tokens before each shard: a row per writing task, so its size is bounded by the number of tasks."""
    totals = spark.read.parquet(path).groupBy("shard").agg(F.sum("n_tokens").alias("_total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("base"))


def read_codes(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """Per document: id, ``start`` (tokens of all documents before it), ``n_tokens``, ``ids`` (32-bit, binary)."""
    segments = spark.read.parquet(path)
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                names, starts, sizes, payload, base = (batch.column(k)[row] for k in range(5))
                codes, starts, sizes, names = Codes(payload.as_py()), starts.as_py(), sizes.as_py(), names.values
                for at in range(0, len(sizes), 256):
                    some = list(zip(starts[at : at + 256], sizes[at : at + 256]))
                    low, high = some[0][0], sum(some[-1])
                    data = codes.get(np.arange(low, high)).tobytes()
                    ids = [data[4 * (s - low) : 4 * (s - low + n)] for s, n in some]
                    yield pa.RecordBatch.from_arrays(
                        [names.slice(at, len(some)), pa.array([base.as_py() + s for s, _ in some], pa.int64()),
                         pa.array([n for _, n in some], pa.int64()), pa.array(ids, pa.binary()),
                         pa.array([zlib.crc32(i) for i in ids], pa.int64())],
                        names=[id_col, "start", "n_tokens", "ids", "ids_crc32"],
                    )

    placed = segments.join(F.broadcast(_shards(spark, path)), "shard").select(
        "doc_ids", "starts", "sizes", "payload", (F.col("base") + F.col("first")).alias("base")
    )
    return placed.mapInArrow(run, f"`{id_col}` {kind}, start bigint, n_tokens bigint, ids binary, ids_crc32 bigint")


def tokens_at(spark: SparkSession, path: str, positions: DataFrame, col: str = "position") -> DataFrame:
    """The token at each global position (others give no row); only the segments asked for are opened."""
    segments = spark.read.parquet(path)
    step = SEGMENT_TOKENS
    spans = segments.join(F.broadcast(_shards(spark, path)), "shard").select(
        (F.col("base") + F.col("first")).alias("low"), "n_tokens", "payload"
    )
    cells = spans.withColumn("cell", F.explode(F.sequence(F.expr(f"low div {step}"), F.expr(f"(low + n_tokens - 1) div {step}"))))
    asked = positions.select(F.col(col).cast("bigint").alias("position")).withColumn("cell", F.expr(f"position div {step}"))
    wanted = (
        cells.select("cell", "low", "n_tokens")
        .join(asked, "cell")
        .where("position >= low and position < low + n_tokens")
        .groupBy("low", F.expr("(position - low) div 65536").alias("part"))
        .agg(F.collect_list("position").alias("positions"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, places, payload in zip(*batch.columns):
                at = places.values.to_numpy(zero_copy_only=False)
                ids = Codes(payload.as_py()).get(at - low.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at, pa.int64()), pa.array(ids.astype(np.int64), pa.int64())], names=["position", "id"]
                )

    held = wanted.join(spans, "low").select("low", "positions", "payload")
    return held.mapInArrow(run, "position bigint, id bigint")
