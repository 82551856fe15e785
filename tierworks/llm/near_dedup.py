"""Near-duplicate documents by HyperMinHash sketches.

A document is the set of its distinct word shingles (64-bit hashes of them). Each of ``registers`` hash functions keeps
the smallest hash of the set, compressed to its number of leading zeros (six bits) and the ten bits after its leading
one, so a register takes two bytes. Every register has a hash function of its own rather than a share of one function's
values, so that no register of a short document stays empty. Four registers are a band: one 64-bit key.

1. Documents with the same set (a digest of the whole sorted set) are one class, represented by its smallest id. From
   here on copies cost nothing.
2. Classes that agree in a band meet in a bucket. Not all pairs of a bucket are made: one member chosen by one of
   ``HUBS`` hashes serves as the hub and is compared with the others.
3. Of each pair, the share of equal registers, less the share that collides by chance at these set sizes, estimates the
   similarity. Pairs far below the threshold (six standard deviations) go; all others are confirmed on their full sets.
4. Components are formed of the confirmed links. Where a bucket still holds several components, hubs were not enough.
   There the registers of all members are compared across components, by the rule of step 3, in blocks of
   ``BLOCK_CLASSES``; a pair of blocks is a key of its own. Components with members that pass form cells; members that
   share a bucket by a common passage or by chance do not. A cell's full sets are laid out in blocks of bounded size,
   and blocks are compared with each other, exactly and across components only. Blocks meet in strips of
   ``STRIP_BLOCKS``, whose pairs are dealt out as keys of their own, so a large cell is many tasks. A pair of blocks
   gives no more links than it joins components, so no group is ever written out as all its pairs.

So no link between classes that share a band is lost unless it joins what is one component already, or is six standard
deviations off in its registers. Two sets of similarity 0.8 share no band of 24 with a probability of 3e-6, and have
too few equal registers with one of 4e-8; more similar ones with far less.

Behaviour: null text, or one without words, has an empty set, is linked with nothing and kept. Rows with a null id are
linked with nothing, get no component and are kept. Rows that repeat an id are one node of the graph. With fewer words
than a shingle has, the whole sequence is one. An empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierworks.llm.common import stored

REGISTERS, MANTISSA = 96, 10
HUBS = 4
BLOCK_SHINGLES, DENSE = 65536, 1 << 22
#: Classes of a bucket that one task holds against as many others, and pairs of them whose registers it compares at once.
BLOCK_CLASSES, TILE = 8192, 1 << 18
#: Blocks of a cell that one task may hold against as many others.
STRIP_BLOCKS = 32
#: Share of register collisions of unrelated sets of equal size at no mantissa bits, as published for HyperMinHash.
COLLISION = 0.169919487159739093975315012348630288992889
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


@lru_cache(maxsize=1)
def _constants():
    random = np.random.default_rng(20240613)
    draw = lambda n: random.integers(0, 2**64, n, dtype=np.uint64)
    return draw(256) | np.uint64(1), draw(64) | np.uint64(1), draw(1024), draw(1024) | np.uint64(1)


@lru_cache(maxsize=1)
def _powers(n: int):
    base = np.uint64(0x9E3779B97F4A7C15)
    inverse = np.uint64(pow(int(base), -1, 2**64))
    up, down = np.full(n, base), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; all words of the texts are hashed at once."""
    letters, places, _, _ = _constants()
    data = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    ends = np.cumsum([len(d) + 1 for d in data])
    flat = np.frombuffer(b" ".join([*data, b""]), np.uint8)
    up, down = _powers(1 << max(16, int(len(flat)).bit_length()))
    space = _SPACE[flat]
    before = np.concatenate([[True], space[:-1]])
    starts, stops = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    total = np.cumsum(letters[flat] * up[: len(flat)], dtype=np.uint64)
    shifted = np.concatenate([np.zeros(1, np.uint64), total])
    words = _mix((shifted[stops] - shifted[starts]) * down[starts])
    bounds = np.concatenate([[0], np.searchsorted(starts, ends)])
    sets = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        n = b - a
        if not n:
            sets.append(np.zeros(0, np.uint64))
            continue
        k = min(n, width)
        acc = np.full(n - k + 1, np.uint64(k))
        for j in range(k):
            acc += words[a + j : b - k + 1 + j] * places[j]
        acc = np.sort(_mix(acc))
        sets.append(acc[np.concatenate([[True], acc[1:] != acc[:-1]])])
    return sets


def registers(sets: list[np.ndarray], count: int = REGISTERS) -> np.ndarray:
    """HyperMinHash registers (leading zeros, mantissa) of non-empty sets: a row of 16-bit numbers for each."""
    _, _, salts, factors = _constants()
    values = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    least = np.empty((len(sets), count), np.uint64)
    for k in range(count):
        hashed = values ^ salts[k]
        hashed *= factors[k]
        least[:, k] = np.minimum.reduceat(hashed, starts)
    bits = np.searchsorted(np.uint64(1) << np.arange(64, dtype=np.uint64), least.ravel(), side="right").reshape(least.shape)
    zeros = np.minimum(64 - bits, 63).astype(np.uint64)
    tail = (least << zeros << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    return ((zeros << np.uint64(MANTISSA)) | tail).astype("<u2")


def estimate(equal: np.ndarray, n: np.ndarray, m: np.ndarray, count: int = REGISTERS) -> np.ndarray:
    """Similarity from numbers of equal registers, corrected for collisions at set sizes ``n`` and ``m``."""
    ratio = np.maximum(n, m) / np.minimum(n, m)
    chance = COLLISION * 2.0**-MANTISSA * 4 * ratio / (1 + ratio) ** 2
    return np.maximum(0, (equal / count - chance) / (1 - chance))


def _floor(threshold: float, count: int = REGISTERS) -> float:
    return threshold - 6 * (threshold * (1 - threshold) / count) ** 0.5


def _chunks(batch: pa.RecordBatch):
    """Slices of a batch with about ``CHUNK_BYTES`` of text each."""
    sizes = np.array([len(t.as_buffer()) if t.is_valid else 0 for t in batch.column(1)], np.int64)
    at, held = 0, 0
    for k, n in enumerate(sizes):
        if held and held + n > CHUNK_BYTES:
            yield batch.slice(at, k - at)
            at, held = k, 0
        held += n
    if at < batch.num_rows:
        yield batch.slice(at)


def sketches(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id``, ``n`` (set size), ``same`` (digest of the set) and ``bands``; the last two null if empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _chunks(batch):
                sets = shingle_sets(part.column(1).to_pylist(), width)
                full = [s for s in sets if len(s)]
                bands = iter(registers(full).view("<i8")) if full else iter(())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([hashlib.blake2b(s, digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                     pa.array([next(bands) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                    names=["id", "n", "same", "bands"],
                )

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id bigint, n bigint, same binary, bands array<bigint>")


def _full_sets(docs: DataFrame, wanted: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``same`` and ``shingles`` of the classes named in ``wanted`` (``id``, ``same``), from their whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _chunks(batch):
                sets = shingle_sets(part.column(1).to_pylist(), width)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([hashlib.blake2b(s, digest_size=16).digest() for s in sets], pa.binary()),
                     pa.array([s.view("<i8") for s in sets], pa.list_(pa.int64()))],
                    names=["id", "same", "shingles"],
                )

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    sets = rows.join(wanted.select("id").distinct(), "id", "left_semi").mapInArrow(
        run, "id bigint, same binary, shingles array<bigint>"
    )
    return sets.join(wanted, ["id", "same"], "left_semi").dropDuplicates(["same"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of ``pairs`` (``a``, ``b``: digests), those whose full sets are similar enough."""
    b = sets.select(F.col("same").alias("b"), F.col("shingles").alias("_b"))
    a = sets.select(F.col("same").alias("a"), F.col("shingles").alias("_a"))
    both = F.size(F.array_intersect("_a", "_b"))
    return pairs.join(b, "b").join(a, "a").where(
        100 * both >= percent * (F.size("_a") + F.size("_b") - both)
    ).select("a", "b")


def _alike(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Of ``pairs`` (``a``, ``b``), those whose sizes and registers allow the threshold."""
    side = lambda x: classes.select(
        F.col("same").alias(x), F.col("n").alias(f"n_{x}"), F.col("bands").alias(f"bands_{x}")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
            left, right = (_sketch_matrix(batch.column(k)) for k in (4, 5))
            keep = estimate((left == right).sum(axis=1), n, m) >= _floor(threshold)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    fit = pairs.join(side("b"), "b").join(side("a"), "a").where(
        (F.col("n_a") >= threshold * F.col("n_b")) & (F.col("n_b") >= threshold * F.col("n_a"))
    )
    return fit.select("a", "b", "n_a", "n_b", "bands_a", "bands_b").mapInArrow(run, "a binary, b binary")


def _sketch_matrix(column) -> np.ndarray:
    flat = np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False)).view("<u2")
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, REGISTERS)


def _buckets(classes: DataFrame, *more: str) -> DataFrame:
    """``bucket`` (band and key) and ``same`` of every band of every class."""
    bands = classes.select("same", *more, F.posexplode("bands").alias("band", "key"))
    return bands.select(F.xxhash64("band", "key").alias("bucket"), "same", *more)


def _hub_pairs(members: DataFrame) -> DataFrame:
    """Hubs of each bucket with its other members; ``members``: ``bucket``, ``same``."""
    hubs = members.groupBy("bucket").agg(
        F.min_by("same", F.xxhash64("same", F.pmod("bucket", F.lit(HUBS)))).alias("hub"), F.count("*").alias("_n")
    ).where("_n > 1").drop("_n")
    return (
        members.join(hubs, "bucket")
        .where(F.col("same") != F.col("hub"))
        .select(F.greatest("same", "hub").alias("b"), F.least("same", "hub").alias("a"))
        .distinct()
    )


def _compatible(members: DataFrame, threshold: float) -> DataFrame:
    """Links (``a``, ``b``: components) between classes of a bucket whose sizes and registers allow the threshold.

    A pair of blocks gives a forest of them. ``members``: ``bucket``, ``members`` (their number), ``same``,
    ``component``, ``n``, ``bands``.
    """
    sized = members.withColumn("_blocks", F.expr(f"cast(ceil(members / {BLOCK_CLASSES}) as int)"))
    dealt = sized.withColumn("block", F.expr("cast(pmod(xxhash64(same), _blocks) as int)"))
    sent = dealt.withColumn("partner", F.explode(F.expr("sequence(0, _blocks - 1)"))).select(
        "bucket", F.least("block", "partner").alias("left"), F.greatest("block", "partner").alias("right"),
        F.struct(F.expr("block <= partner").alias("first"), "component", "n", "bands").alias("_one"),
    )
    meet = sent.repartition("bucket", "left", "right").groupBy("bucket", "left", "right").agg(F.collect_list("_one").alias("held"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = [x for held in batch.column(0) for x in _bucket_links(held.values, threshold)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links)] or [pa.array([], pa.int64())] * 2, names=["a", "b"])

    return meet.select("held").mapInArrow(run, "a bigint, b bigint")


class _Forest:
    """Components that are joined one by one; ``root`` has the root of each."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def joins(self, a: np.ndarray, b: np.ndarray) -> list[int]:
        """The places of the pairs that join what was apart."""
        parent, places = self.root.tolist(), []

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        for place, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
            x, y = find(x), find(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
                places.append(place)
        self.root = np.array([find(x) for x in parent])
        return places


def _bucket_links(held, threshold: float) -> list[tuple[int, int]]:
    """A forest of the compatible pairs of components of two blocks of a bucket, or of one: registers of all pairs are compared."""
    names, code = np.unique(held.field("component").to_numpy(zero_copy_only=False), return_inverse=True)
    if len(names) == 1:
        return []
    n, sketches = held.field("n").to_numpy(zero_copy_only=False), _sketch_matrix(held.field("bands"))
    first, order = held.field("first").to_numpy(zero_copy_only=False).astype(bool), np.argsort(n, kind="stable")
    left, right = order[first[order]], order[~first[order]]
    alone = not len(right)
    right = left if alone else right
    one, two = (np.ascontiguousarray(sketches[x].T) for x in (left, right))
    low, forest, links = _floor(threshold), _Forest(len(names)), []
    rows = max(1, TILE // len(right))
    for i in range(0, len(left), rows):
        some = left[i : i + rows]
        # both sides are in order of size, so sizes that fit are a stretch
        start, stop = np.searchsorted(n[right], [threshold * n[some[0]] - 1, n[some[-1]] / threshold + 1])
        start = max(start, i) if alone else start
        if start >= stop:
            continue
        mine, others = one[:, i : i + rows], two[:, start:stop]
        equal = np.zeros((mine.shape[1], others.shape[1]), np.uint8)
        if equal.size < 512:
            equal += (mine[:, :, None] == others[:, None, :]).sum(axis=0, dtype=np.uint8)
        else:
            for k in range(REGISTERS):
                equal += mine[k, :, None] == others[k]
        apart = forest.root[code[some]][:, None] != forest.root[code[right[start:stop]]]
        a, b = np.nonzero((equal >= REGISTERS * low) & apart)
        x, y = some[a], right[start + b]
        fit = (estimate(equal[a, b].astype(np.int64), n[x], n[y]) >= low) & (n[x] >= threshold * n[y]) & (n[y] >= threshold * n[x])
        x, y = code[x[fit]], code[y[fit]]
        links += [(int(names[x[p]]), int(names[y[p]])) for p in forest.joins(x, y)] if len(x) else []
    return links


def _cell_links(members: DataFrame, percent: int) -> DataFrame:
    """Links (``a``, ``b``: digests) that join components within a cell, from full sets in blocks.

    ``members``: ``cell``, ``same``, ``component``, ``shingles``.
    """
    sized = members.withColumn("n", F.size("shingles").cast("bigint"))
    totals = sized.groupBy("cell").agg(F.sum("n").alias("_all"))
    spread = F.expr(f"pmod(xxhash64(same), cast(ceil(_all / {BLOCK_SHINGLES}) as int))")
    # dealt out by block: a cell's own blocks need not meet in one task
    dealt = sized.join(totals, "cell").withColumn("block", spread).repartition("cell", "block")
    blocks = dealt.groupBy("cell", "block").agg(
        F.collect_list(F.struct("same", "component", "shingles")).alias("held"),
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.expr(f"(cast(ceil(max(_all) / {BLOCK_SHINGLES}) as int) - 1) div {STRIP_BLOCKS}").alias("last"),
    ).withColumn("strip", F.expr(f"block div {STRIP_BLOCKS}"))

    # the pairs of strips of a cell are keys of their own; each strip goes to as many of them as the cell has strips
    def side(x: str, partners: str, one: str, two: str) -> DataFrame:
        sent = blocks.withColumn("partner", F.explode(F.expr(partners)))
        columns = (F.col(c).alias(f"{c}_{x}") for c in ("block", "held", "low", "high"))
        return sent.select("cell", F.col(one).alias("left"), F.col(two).alias("right"), *columns)

    first = side("a", "sequence(strip, last)", "strip", "partner")
    second = side("b", "sequence(0, strip)", "partner", "strip")
    meet = first.join(second, ["cell", "left", "right"]).where(
        "block_a <= block_b and not (low_a = high_a and low_b = high_b and low_a = low_b)"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, two in zip(*batch.columns):
                links = _block_links(one.values, two.values, percent)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*links)] or [pa.array([], pa.binary())] * 2, names=["a", "b"])

    return meet.select("held_a", "held_b").mapInArrow(run, "a binary, b binary")


def _block_links(one, two, percent: int) -> list[tuple[bytes, bytes]]:
    """A forest of the links between components of two blocks: shared shingles are counted for all pairs at once."""
    lists = [block.field("shingles") for block in (one, two)]
    sizes = [np.diff(x.offsets.to_numpy()).astype(np.int64) for x in lists]
    vocabulary, places = np.unique(np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in lists]), return_inverse=True)
    places = np.split(places, [sizes[0].sum()])
    held = [np.bincount(x, minlength=len(vocabulary)) for x in places]
    # only what two sets may share is counted; a block that meets itself has each of its sets twice
    alone = one.field("same").equals(two.field("same"))
    shared = held[0] > 1 if alone else (held[0] > 0) & (held[1] > 0)
    column, width = np.cumsum(shared) - 1, int(shared.sum())
    if not width:
        return []
    sets = []
    for x, n in zip(places, sizes):
        keep = shared[x]
        sets.append((np.repeat(np.arange(len(n)), n)[keep], column[x[keep]]))
    names, code = np.unique(np.concatenate([x.field("component").to_numpy(zero_copy_only=False) for x in (one, two)]), return_inverse=True)
    groups = np.split(code, [len(sizes[0])])
    rows = max(1, DENSE // max(width, 2048))

    def dense(side: int, start: int) -> np.ndarray:
        row, columns = sets[side]
        some = slice(*np.searchsorted(row, [start, start + rows]))
        out = np.zeros((len(sizes[side][start : start + rows]), width), np.float32)
        out[row[some] - start, columns[some]] = 1
        return out

    forest, links = _Forest(len(names)), []
    for i in range(0, len(sizes[0]), rows):
        left = dense(0, i)
        for j in range(i if alone else 0, len(sizes[1]), rows):
            both = (left @ dense(1, j).T).astype(np.int64)
            n, m = sizes[0][i : i + rows, None], sizes[1][None, j : j + rows]
            apart = forest.root[groups[0][i : i + rows]][:, None] != forest.root[groups[1][j : j + rows]]
            a, b = np.nonzero((100 * both >= percent * (n + m - both)) & apart)
            if len(a):
                a, b = a + i, b + j
                links += [(one.field("same")[a[p]].as_py(), two.field("same")[b[p]].as_py()) for p in forest.joins(groups[0][a], groups[1][b])]
    return links


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of all nodes of ``edges`` (``a``, ``b``): alternating stars."""
    edges = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == state:
            break
        state = now
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(F.col("m").alias("x"), F.col("a").alias("y")).union(low.select("m", "b"))
        edges = stored(small.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component"))


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: the id, ``n_shingles``, ``component_id`` (smallest id reachable) and ``kept`` (it is that id)."""
    threshold = percent / 100
    rows = stored(sketches(docs, width, id_col, text_col), "sketches")
    known = rows.where("n > 0 and id is not null")
    classes = stored(
        known.groupBy("same").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands")), "classes"
    )
    pairs = stored(_alike(_hub_pairs(_buckets(classes)), classes, threshold), "pairs")
    ends = lambda p: p.select(F.col("a").alias("same")).union(p.select(F.col("b").alias("same"))).distinct()
    names = classes.select("same", "id")
    sets = stored(_full_sets(docs, ends(pairs).join(names, "same"), width, id_col, text_col), "sets")
    links = stored(_confirmed(pairs, sets, percent), "links")

    def as_ids(found):
        return found.join(names.toDF("a", "x"), "a").join(names.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))

    # a node with several sets belongs to the classes of all of them
    joined = known.select(F.col("id").alias("b"), "same").distinct().join(names.toDF("same", "a"), "same").select("a", "b")
    several = joined.join(joined.groupBy("b").agg(F.min("a").alias("_a"), F.max("a").alias("_z")).where("_a <> _z").select("b", "_a"), "b")
    edges = as_ids(links).union(several.select("_a", "a"))
    groups = components(edges)

    labelled = classes.join(groups, F.col("id") == F.col("node"), "left").withColumn("component", F.coalesce("component", "id"))
    labelled = stored(labelled.select("same", "n", "bands", "component"), "labelled")
    spread = _buckets(labelled, "component")
    mixed = spread.groupBy("bucket").agg(
        F.min("component").alias("_l"), F.max("component").alias("_h"), F.count("*").alias("_n")
    ).where("_l <> _h and _n > 2").select("bucket", F.col("_n").alias("members"))
    still = stored(spread.join(mixed, "bucket"), "open")
    near = _compatible(still.join(labelled.select("same", "n", "bands"), "same"), threshold)
    cells = components(near).toDF("component", "cell")
    cells = cells.union(cells.select("cell", "cell").distinct())  # the smallest component of a cell is no row of its own
    inside = stored(still.select("same", "component").distinct().join(cells, "component"), "inside")
    more = inside.select("same").join(sets.select("same"), "same", "left_anti").join(names, "same")
    sets = sets.unionByName(stored(_full_sets(docs, more, width, id_col, text_col), "sets"))
    late = stored(_cell_links(inside.join(sets.select("same", "shingles"), "same"), percent), "links")
    groups = components(edges.union(as_ids(late))) if late.head(1) else groups

    named = names.join(groups, F.col("id") == F.col("node"), "left").select("same", F.coalesce("component", "id").alias("_component"))
    out = rows.drop("bands").join(named, "same", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("_component", "id"))
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
