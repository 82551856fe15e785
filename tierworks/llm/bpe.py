"""BPE encoding and decoding by tree concatenation.

Text that the tokenizer's pre-tokenizer leaves unsplit is one run of symbols for BPE, however long it is. Such a run is
halved down to leaves, all leaves are encoded independently, and neighbours are joined level by level: a window of
tokens around the join is encoded anew, and grows until its outermost tokens are those that both sides had there. In
BPE a token sequence is the encoding of its text exactly if each two neighbours in it are the encoding of theirs, so
agreement at both edges of the window proves the whole. The work is n log n at most for any run. Leaves and joins of a run
are computed one after the other in the task that holds its row, not in parallel.

Words come again and again, so tasks remember the ids of white-space-free stretches in a cache of bounded size.

Behaviour: null text is an empty one (no ids, empty decoded text); repeated rows, ties and null ids of documents pass
through row by row; an empty table gives an empty one; extra columns are not read. Ids outside the vocabulary decode to
nothing, as in the library.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tierworks.llm.common import WORD_BPE, tokenizer_json

LEAF = 16
CACHE_ENTRIES = 1_000_000
#: Byte-level symbols: bytes that print stand for themselves, the others for the characters from 256 on, in order.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_SYMBOLS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTED)}
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(rf"([{_LETTERS}]+)([!-/:-@\[-`{{-~]*)").fullmatch


def tree_encode(symbols: str, inner, last, leaf: int = LEAF) -> list[int]:
    """Ids of one unsplit run. ``inner`` and ``last`` encode a stretch inside the run and one that ends it."""
    n = len(symbols)
    if n <= leaf:
        return last(symbols)
    cuts = [0, n]
    while cuts[1] - cuts[0] > leaf:
        cuts = sorted({*cuts, *((a + b) // 2 for a, b in zip(cuts, cuts[1:]))})
    parts = [(last if b == n else inner)(symbols[a:b]) for a, b in zip(cuts, cuts[1:])]
    while len(parts) > 1:
        joined, at = [], 0
        for k in range(0, len(parts), 2):
            if k + 1 == len(parts):
                joined.append(parts[k])
                break
            start, mid, end = cuts[k], cuts[k + 1], cuts[k + 2]
            joined.append(_join(symbols, parts[k], parts[k + 1], start, mid, end, n, inner, last))
            at = k + 2
        cuts = cuts[::2] if at == len(cuts) - 1 else [*cuts[::2], n]
        parts = joined
    return [i for i, _ in parts[0]]


def _join(symbols, left, right, start, mid, end, n, inner, last):
    """Tokens of [start, end) from those of [start, mid) and [mid, end)."""
    reach = 1
    while True:
        a, b = min(reach, len(left)), min(reach, len(right))
        low = mid - sum(size for _, size in left[len(left) - a :])
        high = mid + sum(size for _, size in right[:b])
        window = (last if high == n else inner)(symbols[low:high])
        if (low == start or window[0] == left[-a]) and (high == end or window[-1] == right[b - 1]):
            return [*left[: len(left) - a], *window, *right[b:]]
        reach *= 2


class Encoder:
    """Encodes like the tokenizers library without special tokens added; unsplit runs by tree concatenation.

    ``separate``: white space always parts words and is dropped, as with word-end vocabularies. Otherwise one space
    before a word belongs to it, as in byte-level vocabularies.
    """

    def __init__(self, path: str = WORD_BPE, leaf: int = LEAF, tree: bool = True) -> None:
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.suffix = self.model.end_of_word_suffix
        self.inner_library = Tokenizer.from_str(tokenizer_json(path, end_of_word_suffix=None)) if self.suffix else None
        self.inner_model = self.inner_library.model if self.suffix else self.model
        self.separate = bool(self.suffix)
        self.leaf = leaf if tree else 1 << 62
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.normalizer, self.splitter = self.library.normalizer, self.library.pre_tokenizer
        lead = "" if self.separate else self._symbols(" ")
        self.marks: dict[str, bytes] = _Marks(self)
        self.newline = b"" if self.separate else self._pack(self.run(self._symbols("\n")))
        self.bare = _Cache(self, "")
        self.spaced = _Cache(self, lead)
        names = self.library.get_vocab(with_added_tokens=True)
        self.names = dict(sorted((i, t) for t, i in names.items()))
        self.dense = [self.names.get(i) for i in range(max(self.names) + 1)] if self.names else []

    def _inner(self, run: str):
        return [(t.id, len(run[t.offsets[0] : t.offsets[1]])) for t in self._tokens(self.inner_model, run)]

    def _last(self, run: str):
        return [(t.id, t.offsets[1] - t.offsets[0]) for t in self._tokens(self.model, run)]

    @staticmethod
    def _tokens(model, run: str):
        return _by_symbols(model.tokenize(run), run)

    def run(self, symbols: str) -> list[int]:
        """Ids of one run that the pre-tokenizer has left unsplit, given in its byte symbols."""
        if len(symbols) <= self.leaf:
            return [t.id for t in self.model.tokenize(symbols)]
        return tree_encode(symbols, self._inner, self._last, self.leaf)

    def _symbols(self, text: str) -> str:
        """The byte symbols of a text that needs no splitting."""
        if text.isascii() and text.isalpha():
            return text
        return text.encode().decode("latin-1").translate(_BYTE_SYMBOLS)

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return array("H", ids).tobytes()

    def stretch(self, text: str, spaced: bool = False) -> bytes:
        """Ids, as 16-bit ones, of a stretch that no token reaches beyond."""
        text = " " * (spaced and not self.separate) + text
        if any(s in text for s in self.special):
            return self._pack(self.library.encode(text, add_special_tokens=False).ids)
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        ids: list[int] = []
        for piece, _ in self.splitter.pre_tokenize_str(text):
            ids += self.run(piece)
        return self._pack(ids)

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 16-bit integers."""
        if not text:
            return b""
        if self.separate:
            return b"".join(map(self.bare.current().__getitem__, text.split(" ")))
        first, *rest = text.split(" ")
        try:
            return self.bare.current()[first] + b"".join(map(self.spaced.current().__getitem__, rest))
        except _Ragged:
            return self._by_pattern(text)

    def _by_pattern(self, text: str) -> bytes:
        return self._pack(self.library.encode(text, add_special_tokens=False).ids)

    def decode(self, ids: np.ndarray) -> str:
        """As the library decodes with special tokens kept."""
        if self.library.decoder is None and len(ids):
            top = len(self.dense)
            names = [self.dense[i] for i in ids.tolist() if i < top]
            return " ".join(n for n in names if n is not None) if None in names else " ".join(names)
        return self.library.decode(ids.tolist(), skip_special_tokens=False)


class _Ragged(Exception):
    """A stretch next to more white space than one space."""


class _Generation(dict):
    """Ids of stretches; ``at`` knows the tool, the generation before, and the symbol of a space before the stretch."""

    def __init__(self, at: _Cache, before: dict) -> None:
        self.at, self.before = at, before

    def __missing__(self, text: str) -> bytes:
        ids = self.before.get(text)
        if ids is None:
            ids = self._new(text)
        if len(text) <= 64:
            self[text] = ids
        return ids

    def _new(self, text: str) -> bytes:
        tool = self.at.tool
        found = _PLAIN(text)
        if found:  # letters, then marks: two pieces for every splitter here
            word, marks = found.groups()
            if marks:
                return self[word] + tool.marks[marks]
            if tool.separate:
                small = word.lower()
                if small != word:
                    return self[small]
            return tool._pack(tool.run(self.at.lead + tool._symbols(word)))
        if tool.separate:
            return b"".join(map(self.__getitem__, text.split("\n"))) if "\n" in text else tool.stretch(text)
        if not text or text[0].isspace() or text[-1].isspace():
            raise _Ragged
        if "\n" in text:  # a line end between two other characters is a piece of its own
            first, *rest = text.split("\n")
            bare = tool.bare.current()
            return self[first] + b"".join(tool.newline + bare[x] for x in rest)
        return tool.stretch(text, bool(self.at.lead))


class _Cache:
    """Two generations of ids; the older one goes when the younger is full."""

    def __init__(self, tool: Encoder, lead: str) -> None:
        self.tool, self.lead = tool, lead
        self.young = _Generation(self, {})

    def current(self) -> _Generation:
        if len(self.young) >= CACHE_ENTRIES // 2:
            before = dict(self.young)
            self.young = _Generation(self, before)
        return self.young


class _Marks(dict):
    """Ids of runs of punctuation behind letters."""

    def __init__(self, tool: Encoder) -> None:
        self.tool = tool

    def __missing__(self, marks: str) -> bytes:
        ids = self.tool._pack(self.tool.run(self.tool._symbols(marks)))
        if len(marks) <= 16 and len(self) < 65536:
            self[marks] = ids
        return ids


def _by_symbols(tokens, run: str):
    """Tokens with offsets in symbols; the library gives them in the symbols' UTF-8 bytes."""
    if run.isascii():
        return tokens
    ends = np.cumsum([len(c.encode()) for c in run])
    at = dict(zip([0, *ends.tolist()], range(len(run) + 1)))
    return [_Token(t.id, (at[t.offsets[0]], at[t.offsets[1]])) for t in tokens]


class _Token:
    __slots__ = ("id", "offsets")

    def __init__(self, id: int, offsets: tuple[int, int]) -> None:
        self.id, self.offsets = id, offsets


@lru_cache(maxsize=4)
def encoder(path: str, leaf: int = LEAF, tree: bool = True) -> Encoder:
    """One per worker process and file."""
    return Encoder(path, leaf, tree)


def encode_documents(
    docs: DataFrame, tokenizer: str = WORD_BPE, leaf: int = LEAF, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per document: its id, ``ids`` (binary, little-endian unsigned 32-bit), ``n_tokens`` and ``decoded``."""
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer, leaf)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                ids = [np.frombuffer(tool.encode(t.as_py()), "<u2") for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary()),
                     pa.array([len(i) for i in ids], pa.int64()), pa.array([tool.decode(i) for i in ids], pa.string())],
                    names=[id_col, "ids", "n_tokens", "decoded"],
                )

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind.simpleString()}, ids binary, n_tokens bigint, decoded string"
    )


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
