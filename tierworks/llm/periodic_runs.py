"""Periodic runs in word sequences by a dictionary of basic factors.

Each stretch of 2^k words (a basic factor) gets a name, made from the names of its two halves; equal names are equal
stretches of the same document. Where a factor comes back within twice its length, the distance to its next occurrence
is a candidate period, and neighbouring positions with the same distance form an arithmetic progression. Inside a run
of smallest period q and at least three periods, the factor of length L with L/2 < q <= L comes back after exactly q
words from every position it fits at: a nearer return would give the run a smaller period. Progressions that are long
enough are extended to both sides and deduplicated. Factors that occur once are dropped before names are doubled, so
ordinary text costs little more than naming its words.

Spark deals out the rows; inside a task the documents of an Arrow batch are named together, and names never reach across
documents. A document is one row, as in the input: its words, names and places take some 60 bytes a word.

Behaviour: null text has no words; null ids and repeated rows pass through row by row; a text without a run gives an
empty list and itself with single spaces; an empty table gives an empty one; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

RUN = "struct<start:bigint,length:bigint,period:bigint>"
BATCH_ROWS = 2048


def find_runs(
    words: np.ndarray, owners: np.ndarray, min_length: int = 6, min_exponent: int = 4
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of all maximal runs, by start and then period.

    ``words`` are word numbers of documents laid end to end, ``owners`` the document of each. Runs of fewer than
    ``min_length`` words or ``min_exponent`` periods do not count; fewer than three periods are refused.
    """
    if min_exponent < 3:
        raise ValueError("runs of fewer than three periods are not found by this method")
    n = len(words)
    found: list[np.ndarray] = []
    base = np.unique((owners.astype(np.int64) << 32) | words.astype(np.int64), return_inverse=True)[1].astype(np.int64)
    full = np.full(n, -1, np.int64)  # names by place, of factors that occur twice
    places, names, size = np.arange(n), base, 1
    while True:
        twice = np.bincount(names)[names] > 1 if len(names) else np.zeros(0, bool)
        places, names = places[twice], names[twice]
        if len(places) < 2:
            break
        order = np.argsort(names, kind="stable")
        gap = np.zeros(len(places), np.int64)
        same = names[order[1:]] == names[order[:-1]]
        gap[order[:-1][same]] = (places[order[1:]] - places[order[:-1]])[same]
        found.append(_progressions(places, gap, size, min_length, min_exponent))
        full[places] = names
        right = places + size
        fits = right < n
        fits[fits] = full[right[fits]] >= 0
        full_right = full[right[fits]]
        pairs = names[fits] * (names.max() + 1) + full_right
        full[places] = -1
        places = places[fits]
        names = np.unique(pairs, return_inverse=True)[1].astype(np.int64) if len(pairs) else pairs
        size *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, end, period = np.concatenate(found, axis=1)
    start, end = _extended(base, start, end, period)
    start, period, end = np.unique(np.stack([start, period, end]), axis=1)
    keep = end - start >= np.maximum(min_length, min_exponent * period)
    return start[keep], (end - start)[keep], period[keep]


def _progressions(places, gap, size, min_length, min_exponent) -> np.ndarray:
    """Start, end and period of stretches from whose places, one after the other, the factor comes back after the same gap."""
    near = (gap > 0) & (gap <= 2 * size) & (2 * gap > size)
    at, period = places[near], gap[near]
    if not len(at):
        return np.zeros((3, 0), np.int64)
    head = np.ones(len(at), bool)
    head[1:] = (at[1:] != at[:-1] + 1) | (period[1:] != period[:-1])
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(at)) - 1
    start, end, period = at[first], at[last] + period[first] + size, period[first]
    enough = end - start >= np.maximum(min_length, min_exponent * period)
    return np.stack([start, end, period])[:, enough]


def _extended(base, start, end, period) -> tuple[np.ndarray, np.ndarray]:
    """Stretches grown to both sides as long as words one period apart agree."""
    start, end, n = start.copy(), end.copy(), len(base)
    for edge, step in ((start, -1), (end, 1)):
        open_ = np.arange(len(start))
        while len(open_):
            new = edge[open_] - 1 if step < 0 else edge[open_]
            other = new - step * period[open_]
            inside = (new >= 0) & (new < n)
            open_, new, other = open_[inside], new[inside], other[inside]
            agree = base[new] == base[other]
            open_ = open_[agree]
            edge[open_] += step
    return start, end


class _Numbers(dict):
    """Words numbered in the order of their first occurrence."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def collapse(texts: Sequence[Sequence[bytes]], min_length: int = 6, min_exponent: int = 4):
    """Per word list: its runs (start, length, period) and the words left when each run keeps its first period only."""
    numbers = _Numbers()
    sizes = np.array([len(t) for t in texts], np.int64)
    words = np.array([numbers[w] for t in texts for w in t], np.int64)
    owners = np.repeat(np.arange(len(texts)), sizes)
    start, length, period = find_runs(words, owners, min_length, min_exponent)
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, start + period, 1)
    np.add.at(marks, start + length, -1)
    stays = np.cumsum(marks[:-1]) == 0
    lows = np.cumsum(sizes) - sizes
    bounds = np.searchsorted(start, [*lows, len(words)])
    for k, text in enumerate(texts):
        a, b = bounds[k], bounds[k + 1]
        if a == b:
            yield [], text
            continue
        runs = list(zip((start[a:b] - lows[k]).tolist(), length[a:b].tolist(), period[a:b].tolist()))
        yield runs, [w for w, stay in zip(text, stays[lows[k] : lows[k] + sizes[k]].tolist()) if stay]


def periodic_runs(
    docs: DataFrame, rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None, min_length: int = 6,
    min_exponent: int = 4, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per document: ``id_col``, ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    Words are parted by the white space of ASCII. ``rewrite`` may change a document's words, given its id, before the
    search. A word of ``collapsed`` is left out if any run holds it behind that run's first period.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                texts = [(t.as_py() or "").encode().split() for t in part.column(1)]
                if rewrite is not None:
                    texts = [rewrite(i.as_py(), t) for i, t in zip(part.column(0), texts)]
                found = list(collapse(texts, min_length, min_exponent))
                runs = [[{"start": s, "length": m, "period": p} for s, m, p in r] for r, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(t) for t in texts], pa.int64()),
                     pa.array(runs, pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
                     pa.array([b" ".join(w).decode() for _, w in found], pa.string())],
                    names=[id_col, "n_words", "runs", "collapsed"],
                )

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_words bigint, runs array<{RUN}>, collapsed string")
