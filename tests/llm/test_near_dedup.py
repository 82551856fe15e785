"""HyperMinHash near-dedup against all pairs."""

import random

import numpy as np
import pytest

from tierworks.llm import near_dedup

SCHEMA = "doc_id bigint, text string, n bigint, same string"


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, 1, "x") for i, t in zip(ids, texts)], SCHEMA)


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    if len(words) < width:
        return {tuple(words)}
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(texts, width, percent=80, ids=None):
    ids = list(range(len(texts)) if ids is None else ids)
    sets = [shingles(t, width) for t in texts]
    parent = {i: i for i in ids if i is not None}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(texts)):
        for b in range(a):
            if ids[a] is None or ids[b] is None or not sets[a] or not sets[b]:
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(ids[a]), find(ids[b])))
                parent[y] = x
    return [(i, len(s), None if i is None else find(i)) for i, s in zip(ids, sets)]


def got(df):
    return [(r.doc_id, r.n_shingles, r.component_id) for r in df.collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def corpus(seed, n=60, mutations=(0, 1, 2, 4, 8, 12)):
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    texts = []
    for _ in range(n):
        if texts and draw.random() < 0.7:
            held = draw.choice(texts).split()
            for _ in range(draw.choice(mutations)):
                held[draw.randrange(len(held))] = draw.choice(words)
            texts.append(" ".join(held))
        else:
            texts.append(" ".join(draw.choice(words) for _ in range(draw.randint(20, 80))))
    return texts


def test_equals_all_pairs(spark):
    for seed, width in ((1, 2), (2, 5)):
        texts = corpus(seed)
        assert order(got(near_dedup.near_duplicates(documents(spark, texts), width=width))) == order(brute(texts, width))


def test_large_group_with_outsiders_that_share_bands(spark):
    draw = random.Random(5)
    base = [f"w{k}" for k in range(60)]
    texts = []
    for k in range(120):
        held = list(base)
        for j in range(draw.choice((0, 1, 2, 5, 6, 7))):
            held[draw.randrange(60)] = f"own{k}x{j}"
        texts.append(" ".join(held))
    result = near_dedup.near_duplicates(documents(spark, texts), width=2)
    assert order(got(result)) == order(brute(texts, 2))


def test_cells_of_many_strips_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 100)
    monkeypatch.setattr(near_dedup, "STRIP_BLOCKS", 2)
    texts = corpus(8, n=40)
    sets = near_dedup.shingle_sets(texts, 2)
    rows = [(7, str(i).encode(), i, [int(x) for x in s.view("<i8")]) for i, s in enumerate(sets)]
    members = spark.createDataFrame(rows, "cell bigint, same binary, component bigint, shingles array<bigint>")
    links = near_dedup._cell_links(members, 80)
    edges = links.selectExpr("cast(cast(a as string) as bigint) as a", "cast(cast(b as string) as bigint) as b")
    assert edges.count() > 5
    found = {r.node: r.component for r in near_dedup.components(edges).collect()}
    assert {i: found.get(i, i) for i in range(len(texts))} == {i: c for i, _, c in brute(texts, 2)}


def test_classes_that_share_only_a_passage_are_not_compared_on_full_sets(spark, monkeypatch):
    passage = " ".join(f"shared{k}" for k in range(51))
    texts = [passage + " " + " ".join(f"own{i}x{k}" for k in range(50)) for i in range(80)]
    compared, links = [], near_dedup._cell_links
    monkeypatch.setattr(near_dedup, "_cell_links", lambda members, percent: compared.append(members.count()) or links(members, percent))
    result = near_dedup.near_duplicates(documents(spark, texts), width=2)
    assert order(got(result)) == order(brute(texts, 2))
    assert compared == [0]


@pytest.mark.parametrize("block", [8192, 7])
def test_buckets_without_hubs_lose_no_link(spark, monkeypatch, block):
    draw = random.Random(6)
    texts = []
    for group in range(3):
        base = [f"g{group}w{k}" for k in range(60 + 30 * group)]
        for k in range(40):
            held = list(base)
            for j in range(draw.choice((0, 1, 2, 4, 6, 12))):
                held[draw.randrange(len(held))] = f"own{group}x{k}x{j}"
            texts.append(" ".join(held))
    hubs = near_dedup._hub_pairs
    monkeypatch.setattr(near_dedup, "_hub_pairs", lambda members: hubs(members).limit(0))
    monkeypatch.setattr(near_dedup, "BLOCK_CLASSES", block)
    result = near_dedup.near_duplicates(documents(spark, texts), width=2)
    assert order(got(result)) == order(brute(texts, 2))


def test_odd_rows(spark):
    long = " ".join(f"long{k % 5000}" for k in range(60000))
    texts = [None, "", "  \n", "one", "ONE", "one two", "one  TWO", "É É", "é é", long, long + " more", "three", None]
    ids = [9, 8, 7, 6, 5, 4, 3, 2, 1, 0, 10, None, None]
    result = near_dedup.near_duplicates(documents(spark, texts, ids), width=2)
    assert order(got(result)) == order(brute(texts, 2, ids=ids))
    kept = {(r.doc_id, r.component_id): r.kept for r in result.collect()}
    assert kept[(6, 5)] is False and kept[(5, 5)] is True and kept[(None, None)] is True


def test_repeated_rows_and_ids(spark):
    texts = ["a b c d", "a b c d", "x y z w", "x y z w", "q r s t"]
    ids = [1, 1, 1, 7, 9]
    found = {(r.doc_id, r.component_id) for r in near_dedup.near_duplicates(documents(spark, texts, ids), width=2).collect()}
    assert found == {(1, 1), (7, 1), (9, 9)}


def test_empty_table(spark):
    assert near_dedup.near_duplicates(documents(spark, [])).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(5, 100)] + [(200, 201), (201, 200)]
    found = {r.node: r.component for r in near_dedup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert set(found.values()) == {0, 200} and found[149] == 0 and found[201] == 200


def test_shingle_hashes_count_like_plain_sets():
    texts = corpus(3) + ["", None, "a", "a b a b a b", "é\x0bÜ\x0c x"]
    for width in (1, 2, 5):
        assert [len(s) for s in near_dedup.shingle_sets(texts, width)] == [len(shingles(t, width)) for t in texts]


def test_estimate_follows_similarity():
    draw = np.random.default_rng(2)
    for share in (0.3, 0.6, 0.9):
        errors = []
        for _ in range(40):
            pool = draw.integers(0, 2**64, 1000, dtype=np.uint64)
            k = int(1000 * share)
            rest = draw.integers(0, 2**64, 1000 - k, dtype=np.uint64)
            regs = near_dedup.registers([np.sort(pool), np.sort(np.concatenate([pool[:k], rest]))])
            errors.append(near_dedup.estimate((regs[0] == regs[1]).sum(), 1000, 1000) - k / (2000 - k))
        assert abs(np.mean(errors)) < 0.03
