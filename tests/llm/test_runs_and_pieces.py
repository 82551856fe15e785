"""Periodic runs and piece encoding, against brute force and the sentencepiece library."""

import hashlib
import random
import zlib

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tierworks.llm import periodic_runs, piece_bpe, queries


def plain_runs(words, min_length=6, min_exponent=4):
    """Every maximal run, by looking at every period."""
    n, out = len(words), []
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            low, size = i, j - i + q
            smallest = all(any(words[x] != words[x + d] for x in range(low, low + size - d)) for d in range(1, q))
            if size >= max(min_length, min_exponent * q) and smallest:
                out.append((low, size, q))
            i = j + 1 if j == i else j
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {x for low, size, q in runs for x in range(low + q, low + size)}
    return [w for i, w in enumerate(words) if i not in gone]


@pytest.mark.parametrize("limits", [(6, 4), (3, 3), (12, 5)])
def test_runs_equal_brute_force(limits):
    draw = random.Random(str(limits))
    for _ in range(500):
        texts = []
        for _ in range(draw.randint(0, 4)):
            text = []
            for _ in range(draw.randint(0, 5)):
                unit = [draw.choice("abc").encode() for _ in range(draw.randint(1, 6))]
                text += (unit * draw.randint(1, 9))[: draw.randint(1, 40)]
            texts.append(text)
        for (runs, left), text in zip(periodic_runs.collapse(texts, *limits), texts):
            assert runs == plain_runs(text, *limits)
            assert left == plain_collapsed(text, runs)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"x", b"y"]), max_size=40), max_size=3))
def test_runs_of_two_words(texts):
    for (runs, _), text in zip(periodic_runs.collapse(texts), texts):
        assert runs == plain_runs(text)


def test_too_few_periods_are_refused():
    with pytest.raises(ValueError):
        list(periodic_runs.collapse([[b"a"]], min_exponent=2))


def test_a_long_run_is_found():
    unit = [str(i).encode() for i in range(777)]
    text = [b"start", *unit * 400, b"end"]
    (runs, left), = periodic_runs.collapse([text])
    assert runs == [(1, 777 * 400, 777)] and left == [b"start", *unit, b"end"]


def test_registered_runs_equal_brute_force(spark, tmp_path):
    draw = random.Random(9)
    texts = [None, "", " \t\n", "a", "la " * 50, "a b c " * 9 + "x y z", "x\vx\fx x\rx x"]
    texts += [" ".join(draw.choice("abcdefgh") for _ in range(draw.randint(1, 300))) for _ in range(80)]
    rows = [(i, t, "clash", "clash", 1) for i, t in enumerate(texts)] + [(5, texts[5], "", "", 2), (None, "b " * 30, "", "", 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs string, words string, n_words int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op12_basic_factors(spark, str(tmp_path)).collect()
    assert len(found) == len(rows)
    wanted, planted = [], 0
    for doc_id, text, *_ in rows:
        words = (text or "").encode().split()
        h = zlib.crc32(str(doc_id).encode())
        if doc_id is not None and h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
        wanted.append((
            doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(plain_collapsed(words, runs))).hexdigest(),
        ))
    assert planted > 3
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def pieces():
    return piece_bpe.PieceEncoder(), sentencepiece.SentencePieceProcessor(model_file=piece_bpe.PIECE_BPE)


ODD = ["", " ", "▁", "a▁b", "▁▁a ", "\x00", "a\x00b", "\n\n\r", "é" * 90, "a" * 9000, "日本語🙂" * 10, "<s>", "<0x0A>", "</s> <unk>",
       "﻿", "é", "x" + " " * 37 + "y", "lorem ipsum " * 3000]


def test_pieces_equal_the_library(pieces):
    tool, library = pieces
    draw, symbols = random.Random(3), "".join(tool.pieces)
    texts = [*ODD, *(" " * n for n in range(70)), *("a" + " " * n + "the" for n in range(70))]
    for _ in range(4000):
        kinds = [draw.choice(tool.pieces), draw.choice(symbols), draw.choice("abcdehinorst "), draw.choice(["  ", "▁", "🙂", "\n"])]
        texts.append("".join(draw.choice(kinds) for _ in range(draw.randint(1, 14))))
        texts.append("".join(draw.choice("aehinost") for _ in range(draw.randint(1, 120))))
    for text in texts:
        ids = library.encode(text)
        assert tool.encode(text) == ids, text
        assert tool.decode(ids) == library.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_pieces_of_any_text(text):
    tool = piece_bpe.encoder(piece_bpe.PIECE_BPE)
    assert tool.encode(text) == tool.library.encode(text)


def test_short_memories_change_nothing(pieces, monkeypatch):
    monkeypatch.setattr(piece_bpe, "CACHE_ENTRIES", 20)
    monkeypatch.setattr(piece_bpe, "PAIR_ENTRIES", 30)
    tool, library = piece_bpe.PieceEncoder(), pieces[1]
    for text in ODD:
        assert tool.encode(text) == library.encode(text)


def test_registered_pieces(spark, tmp_path, pieces):
    texts = [None, *ODD]
    rows = [(i, t, "clash", "clash") for i, t in enumerate(texts)] + [(3, texts[3], "", ""), (None, "no id", "", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, decoded string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    library, wanted = pieces[1], []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        wanted.append((doc_id, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids) if ids else "")))
    found = queries.op13_piece_table(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)
    assert piece_bpe.encode_documents(docs.limit(0)).count() == 0
