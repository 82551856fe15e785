"""Encoding, token codes and packing against the tokenizers library and plain versions."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tierworks.llm import bpe, packing, token_codes
from tierworks.llm.common import BYTE_BPE, WORD_BPE
from tierworks.session import work_dir

PARTS = ["a", "the", "é", "Σ", "İ", " ", "  ", "\n", "́", "x" * 40, "日本", "🙂", "<|endoftext|>", "\x1c", "\x85", "'s", "12",
         "ing", "!" * 24, "a" * 45, "\t", ".", "than,", "Über", "re.\nErtion"]
TEXTS = [None, "", " ", "\n\n", "One two two.", "One two two.", "a" * 5000, "lorem ipsum " * 3000, "<|endoftext|> <|startoftext|>",
         "éèê" * 700, "x y\nz  w", "THE END!!", None]


def library(path):
    return Tokenizer.from_file(path)


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
@pytest.mark.parametrize("leaf", [2, 5, 16])
def test_tree_concatenation_equals_the_library(path, leaf):
    tool, other, draw = bpe.Encoder(path, leaf), library(path), random.Random(leaf)
    texts = [t or "" for t in TEXTS]
    texts += ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 12))) for _ in range(400)]
    texts += ["".join(draw.choice("abtheinrso") for _ in range(draw.randint(0, 300))) for _ in range(200)]
    texts += ["".join(draw.choice("éèabth日") for _ in range(draw.randint(0, 200))) for _ in range(100)]
    for text in texts:
        ids = other.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(tool.encode(text), "<u2").tolist() == ids
        assert tool.decode(np.array(ids)) == other.decode(ids, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200))
def test_any_text(text):
    for path in (BYTE_BPE, WORD_BPE):
        ids = library_of(path).encode(text, add_special_tokens=False).ids
        assert np.frombuffer(bpe.encoder(path).encode(text), "<u2").tolist() == ids


_LIBRARIES = {}


def library_of(path):
    return _LIBRARIES.setdefault(path, library(path))


def test_ids_outside_the_vocabulary_decode_to_nothing():
    tool = bpe.encoder(WORD_BPE)
    assert tool.decode(np.array([320, 70000, 320])) == library(WORD_BPE).decode([320, 70000, 320], skip_special_tokens=False)


def documents(spark, texts):
    rows = [(i, t, "x", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, ids string, piece bigint")


def test_encode_documents_with_odd_rows(spark):
    other = library(WORD_BPE)
    found = {r.doc_id: r for r in bpe.encode_documents(documents(spark, TEXTS)).collect()}
    assert len(found) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        ids = other.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(found[i].ids, "<u4").tolist() == ids and found[i].n_tokens == len(ids)
        assert found[i].decoded == other.decode(ids, skip_special_tokens=False)
    assert bpe.encode_documents(documents(spark, [])).count() == 0


@pytest.mark.parametrize("ids", [[], [0], [255, 256, 65535, 65536, 2**24, 2**32 - 1], list(range(70000)), [5] * 1025])
def test_codes_give_every_position(ids):
    codes = token_codes.Codes(token_codes.pack_codes(np.array(ids, np.uint32)))
    assert codes.get(np.arange(len(ids))).tolist() == ids
    mixed = np.random.default_rng(1).permutation(len(ids))[:500]
    assert codes.get(mixed).tolist() == [ids[i] for i in mixed]


def test_codes_refuse_other_bytes():
    with pytest.raises(ValueError):
        token_codes.Codes(b"something else")


def test_token_codes_round_trip_and_random_access(spark):
    texts = TEXTS * 3
    rows = [(None if i == 4 else i // 2 * 2, t, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, start string")
    path = work_dir(spark, "codes")
    token_codes.write_codes(docs, path, segment_tokens=700)
    found = token_codes.read_codes(spark, path).orderBy("start").collect()
    ids = [r.doc_id for r in found]
    assert len(found) == len(texts) and ids == sorted(ids, key=lambda x: (x is not None, x))
    other, start, everything = library(BYTE_BPE), 0, []
    wanted = sorted((zlib.crc32(np.array([*other.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for t in texts))
    for r in found:
        assert r.start == start and r.ids_crc32 == zlib.crc32(r.ids)
        start += r.n_tokens
        everything += np.frombuffer(r.ids, "<u4").tolist()
    assert sorted(r.ids_crc32 for r in found) == wanted
    asked = [0, 1, start - 1, start, 999_999_999, *range(7, start, 997)]
    places = spark.createDataFrame([(p,) for p in asked], "position bigint")
    at = {r.position: r.id for r in token_codes.tokens_at(spark, path, places).collect()}
    assert at == {p: everything[p] for p in asked if p < start}


def test_token_codes_of_nothing(spark):
    path = work_dir(spark, "codes")
    token_codes.write_codes(documents(spark, []), path)
    assert token_codes.read_codes(spark, path).count() == 0


def bins_of(entries):
    bins, ranks = {}, {}
    for length, rank, n, each, first, offset in entries.tolist():
        assert rank == ranks.get(length, 0)
        ranks[length] = rank + n * each
        for b in range(n):
            for k in range(each):
                bins.setdefault(first + b, []).append((offset + k * length, length))
    for held in bins.values():
        place = 0
        for offset, length in sorted(held):
            assert offset == place
            place += length
    return bins, ranks


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=25))
def test_plan_is_complete_and_tight(lengths):
    bins, ranks = bins_of(packing.plan(lengths, 60))
    assert ranks == lengths
    assert all(sum(n for _, n in held) <= 60 for held in bins.values())
    assert all(sum(1 for _, n in held if 3 * n > 60) <= 2 for held in bins.values())


def fewest(pieces, capacity):
    """The least number of sequences, by trying every place for every piece."""
    best = len(pieces)

    def put(k, gaps):
        nonlocal best
        if len(gaps) >= best:
            return
        if k == len(pieces):
            best = len(gaps)
            return
        for g in sorted(set(gaps)):
            if g >= pieces[k]:
                at = gaps.index(g)
                put(k + 1, [*gaps[:at], g - pieces[k], *gaps[at + 1 :]])
        put(k + 1, [*gaps, capacity - pieces[k]])

    pieces = sorted(pieces, reverse=True)
    put(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=9))
def test_plan_is_near_the_optimum(pieces):
    bins, _ = bins_of(packing.plan(dict(Counter(pieces)), 60))
    assert len(bins) <= fewest(pieces, 60) * 11 / 9 + 1


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(21, 60), max_size=9))
def test_large_pieces_take_the_fewest_sequences(pieces):
    bins, _ = bins_of(packing.plan(dict(Counter(pieces)), 60))
    assert len(bins) == fewest(pieces, 60)


def test_large_pieces_are_matched_in_fewest_sequences():
    lengths = {40: 2, 35: 1, 25: 2, 20 + 1: 1, 22: 3}
    bins, _ = bins_of(packing.plan(lengths, 60))
    assert len(bins) == fewest([n for n, c in lengths.items() for _ in range(c)], 60) == 6
    bins, _ = bins_of(packing.plan({16: 19, 45: 9}, 60))
    assert len(bins) == 16  # a 45 and a 16 do not fit together, and three 16 at most do


def test_plan_refuses_impossible_lengths():
    with pytest.raises(ValueError):
        packing.plan({61: 1}, 60)


def test_packing_keeps_every_token(spark):
    texts = TEXTS * 4
    docs = documents(spark, texts).repartition(3)
    pieces = packing.pack_documents(docs, capacity=64, with_ids=True).collect()
    other = library(WORD_BPE)
    by_doc, by_bin = {}, {}
    for p in sorted(pieces, key=lambda p: p.piece):
        assert p.start == 64 * p.piece and p.length == len(p.ids) // 4 <= 64 and p.ids_crc32 == zlib.crc32(p.ids)
        by_doc[p.doc_id] = by_doc.get(p.doc_id, b"") + p.ids
        by_bin.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for i, text in enumerate(texts):
        assert np.frombuffer(by_doc[i], "<u4").tolist() == [*other.encode(text or "", add_special_tokens=False).ids, 1]
    for held in by_bin.values():
        place = 0
        for offset, length in sorted(held):
            assert offset == place
            place += length
        assert place <= 64
    total = sum(p.length for p in pieces)
    assert len(by_bin) <= -(-total // 64) + 2


def test_sequences_hold_their_pieces(spark):
    docs = documents(spark, TEXTS)
    packed = packing.pack_documents(docs, capacity=64, with_ids=True).cache()
    made = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    for p in packed.collect():
        data = made[p.sequence_id].ids
        assert data[4 * p.offset : 4 * (p.offset + p.length)] == p.ids


def test_packing_nothing(spark):
    assert packing.pack_documents(documents(spark, [])).count() == 0
