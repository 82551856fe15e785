"""SentencePiece BPE encoding by a table of last tokens.

For every prefix of a stretch of text there is one token that ends the prefix's encoding. It is found among the
vocabulary's pieces that end there (an automaton lists them all): the piece is the last token exactly if it goes with
the last token of the prefix before it, that is, if the two pieces, put together, are encoded as just these two. With
the table filled from left to right, ids are read off backwards. Time is linear in the text for any run, however long
and unsplit; the table takes four bytes a character.

White space is a symbol of the pieces, and stands only at their beginning: text is cut before each symbol that follows
other characters, and the ids of short stretches are kept in a cache of bounded size. A vocabulary with pieces that
reach across such a place is encoded uncut.

Behaviour: null text is an empty one (no ids, empty decoded text); characters outside the vocabulary become byte tokens,
or the unknown token where there are none; repeated rows, ties and null ids of documents pass through row by row; an
empty table gives an empty one; extra columns are not read. Models other than BPE, and those with user-defined or unused
pieces, are refused. Ids may have 32 bits.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
CACHE_ENTRIES = 800_000
PAIR_ENTRIES = 1_000_000
NEVER = float("-inf")
SHORT = 64  # characters of stretches that are kept


class PieceEncoder:
    def __init__(self, path: str = PIECE_BPE) -> None:
        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(lib.get_piece_size())
        names = [lib.id_to_piece(i) for i in ids]
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) for i in ids]
        if any(lib.is_unused(i) for i in ids):
            raise ValueError("unused pieces are not supported")
        self.pieces = [n for n, s in zip(names, special) if not s]
        self.ids = [i for i, s in zip(ids, special) if not s]
        self.scores = {p: lib.get_score(i) for p, i in zip(self.pieces, self.ids)}
        symbols = set("".join(self.pieces))
        lone = sorted(symbols - set(self.pieces))  # characters of longer pieces that are none by themselves
        self.bytes = {int(names[i][1:-1], 16): i for i in ids if lib.is_byte(i)}
        self.out = [(i,) for i in self.ids] + [self._spelled(c)[::-1] for c in lone]  # last id first
        self.pieces += lone
        self.lengths = [len(p) for p in self.pieces]
        self.symbols = symbols
        self.ends = ahocorasick.Automaton()
        for k, piece in enumerate(self.pieces):
            self.ends.add_word(piece, (k, len(piece)))
        self.ends.make_automaton()
        across = any(SPACE in p.lstrip(SPACE) for p in self.pieces)
        self.stretches = re.compile(r".+" if across else f"{SPACE}*[^{SPACE}]+|{SPACE}+", re.S).findall
        self.traces = _Traces(self)
        self.pairs: dict[int, bool] = {}
        self.cache = _Cache(self)
        if lib.encode("a a") != self.encode("a a"):
            raise ValueError("not a BPE model")

    def _spelled(self, char: str) -> tuple[int, ...]:
        """Ids of a character that is no piece."""
        if len(self.bytes) == 256:
            return tuple(self.bytes[b] for b in char.encode())
        return (self.library.unk_id(),)

    def _trace(self, piece: int) -> list[tuple[float, str, str]] | None:
        """How a piece is built by itself: score of each merge (the best pair first, of equals the leftmost), and the
        piece's first and last symbol before it. None for a piece that ends up as other pieces."""
        symbols, scores, steps = [*self.pieces[piece]], self.scores, []
        while len(symbols) > 1:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                score = scores.get(symbols[k] + symbols[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                return None
            steps.append((best, symbols[0], symbols[-1]))
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return [*steps, (NEVER, symbols[0], symbols[0])]

    def goes_with(self, left: int, right: int) -> bool:
        """Whether two pieces, put together, are encoded as just these two.

        Their merges take turns, the better score first; they stay apart if no merge over the border is ever better
        than the next one inside.
        """
        key = left * len(self.pieces) + right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIR_ENTRIES:
                self.pairs.clear()
            known = self.pairs[key] = self._apart(self.traces[left], self.traces[right])
        return known

    def _apart(self, left, right) -> bool:
        if left is None or right is None:
            return False
        scores, i, j = self.scores, 0, 0
        while True:
            own, _, x = left[i]
            other, y, _ = right[j]
            over = scores.get(x + y)
            if over is not None and over > own and over >= other:
                return False
            if own >= other:
                if own == NEVER:
                    return True
                i += 1
            else:
                j += 1

    def _table(self, text: str) -> list[int]:
        """Ids of a stretch of known characters, the last first."""
        n, size, pairs = len(text), len(self.pieces), self.pairs
        last = [-1] * (n + 1) if n < 4096 else array("i", [-1]) * (n + 1)
        for at, (piece, length) in self.ends.iter(text):
            end = at + 1
            if last[end] >= 0:
                continue
            start = end - length
            if start:
                before = last[start]
                if before < 0:
                    continue
                fits = pairs.get(before * size + piece)
                if fits is None:
                    fits = self.goes_with(before, piece)
                if not fits:
                    continue
            last[end] = piece
        ids, end, out, lengths = [], n, self.out, self.lengths
        while end:
            piece = last[end]
            ids += out[piece]
            end -= lengths[piece]
        return ids

    def stretch(self, text: str) -> list[int]:
        """Ids of a stretch; characters outside the vocabulary part it."""
        if self.symbols.issuperset(text):
            ids = self._table(text)
            ids.reverse()
            return ids
        ids, known = [], []
        for char in [*text, ""]:
            if char in self.symbols:
                known.append(char)
                continue
            if known:
                ids.extend(reversed(self._table("".join(known))))
                known.clear()
            if char:
                ids.extend(self._spelled(char))
        return ids

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text, without begin or end ids."""
        if not text:
            return []
        ids: list[int] = []
        cache = self.cache.current()
        for stretch in self.stretches(self.library.normalize(text)):
            ids += cache[stretch]
        return ids

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids) if ids else ""


class _Traces(dict):
    def __init__(self, tool: PieceEncoder) -> None:
        self.tool = tool

    def __missing__(self, piece: int):
        self[piece] = trace = self.tool._trace(piece)
        return trace


class _Generation(dict):
    def __init__(self, tool: PieceEncoder, before: dict) -> None:
        self.tool, self.before = tool, before

    def __missing__(self, text: str) -> list[int]:
        ids = self.before.get(text)
        if ids is None:
            ids = self.tool.stretch(text)
        if len(text) <= SHORT:
            self[text] = ids
        return ids


class _Cache:
    """Two generations of ids; the older one goes when the younger is full."""

    def __init__(self, tool: PieceEncoder) -> None:
        self.tool = tool
        self.young = _Generation(tool, {})

    def current(self) -> _Generation:
        if len(self.young) >= CACHE_ENTRIES // 2:
            self.young = _Generation(self.tool, dict(self.young))
        return self.young


@lru_cache(maxsize=4)
def encoder(path: str) -> PieceEncoder:
    """One per worker process and file."""
    return PieceEncoder(path)


def encode_documents(docs: DataFrame, model: str = PIECE_BPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, ``ids`` (a list), ``n_tokens`` and ``decoded``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                ids = [tool.encode(t.as_py()) for t in part.column(1)]
                sizes = np.array([len(i) for i in ids], np.int64)
                ends = pa.array([0, *np.cumsum(sizes).tolist()], pa.int32())
                flat = pa.array(np.array([x for i in ids for x in i], np.int64), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(ends, flat), pa.array(sizes, pa.int64()),
                     pa.array([tool.decode(i) for i in ids], pa.string())],
                    names=[id_col, "ids", "n_tokens", "decoded"],
                )

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<bigint>, n_tokens bigint, decoded string")
