"""Nearest neighbours and the whole pipeline against plain versions."""

import math

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.test_near_dedup import brute
from tests.llm.test_texts import plain_features, plain_lines
from tierworks.llm import ann, near_dedup
from tierworks.llm.common import WORD_BPE

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, cell int"


def plain_search(rows, k=10):
    good = [(i, [float(x) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = set()
    for q, a in good:
        if q % 100:
            continue
        near = sorted((math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b))), i) for i, b in good if i != q)[:k]
        out |= {(q, r, i, round(d, 9)) for r, (d, i) in enumerate(near, 1)}
    return out


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA).repartition(3)
    return {(r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in ann.search(df, "id % 100 = 0", centroids=6, enough=20, **options).collect()}


@pytest.mark.parametrize("kind", ["spread", "clusters"])
def test_search_is_exact(spark, kind):
    draw = np.random.default_rng(4)
    data = draw.normal(size=(600, 8))
    if kind == "clusters":
        data = draw.normal(size=(10, 8))[draw.integers(0, 10, 600)] * 5 + 0.1 * data
        data[100:300] = data[100]  # one vector holds a third of all rows
    rows = [(i, np.float32(v).tolist()) for i, v in enumerate(data)]
    assert found(spark, rows) == plain_search(rows)


def test_search_with_odd_vectors(spark):
    draw = np.random.default_rng(5)
    rows = [(i, np.float32(v).tolist()) for i, v in enumerate(draw.normal(size=(30, 4)))]
    rows += [(100, None), (200, [0.0] * 4), (300, [1.0, None, 1.0, 1.0]), (400, [1.0, math.nan, 0.0, 0.0]), (500, [math.inf, 1.0, 1.0, 1.0]),
             (None, [1.0, 1.0, 1.0, 1.0]), (600, [1.0, 2.0, 3.0, 4.0]), (601, [1.0, 2.0, 3.0, 4.0]), (700, [])]
    assert found(spark, rows) == plain_search(rows)


def test_search_in_few_or_no_vectors(spark):
    rows = [(0, [1.0, 1.0]), (7, [2.0, 1.0]), (3, [2.0, 1.0])]
    assert found(spark, rows) == plain_search(rows) == {(0, 1, 3, 1.0), (0, 2, 7, 1.0)}
    assert found(spark, [(0, [1.0, 1.0])]) == set()
    assert found(spark, []) == set()


def test_walk_goes_by_summed_distance():
    d1, d2 = np.array([3.0, 0.0, 1.0]), np.array([0.5, 2.0])
    cells = ann.walk(d1, d2, np.ones(6, int), 6)
    sums = [d1[c // 2] + d2[c % 2] for c in cells]
    assert sums == sorted(sums) and len(set(cells)) == 6


def corpus():
    passage = " ".join(f"shared{k}" for k in range(60))
    clean = [" ".join(f"w{(k * 7 + j * j) % 997}" for j in range(40 + k)) + "." for k in range(12)]
    near = clean[3].replace("w21 ", "other ", 1)
    return clean + [None, "", "too short", "### " * 40, near, clean[5], passage + "\n" + clean[0][:80] + " tail of its own",
                    "own head of it all\n" + passage + "\nand more of its own words to be kept here now", "w " * 9000]


def test_pipeline_equals_a_plain_run(spark, tmp_path):
    import corpus_pipeline

    texts = corpus()
    rows = [(i, t, "en", f"src{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    got = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length

    def good(text):
        n, chars, symbols, dup, repeated = plain_features(text)
        return not (n < 10 or 100 * repeated > 20 * n or 10 * symbols > n or chars > 15 * n or chars < 2 * n)

    kept = [(i, t) for i, t in enumerate(texts) if good(t)]
    cut = [(i, t) for (i, _), (t, n) in zip(kept, plain_lines([t for _, t in kept], 50)) if t.strip() or not n]
    parts = brute([t for _, t in cut], 5, ids=[i for i, _ in cut])
    left = [(i, t) for (i, t), (_, _, c) in zip(cut, parts) if c == i]
    tool = Tokenizer.from_file(WORD_BPE)
    assert got == {i: len(tool.encode(t, add_special_tokens=False).ids) + 1 for i, t in left}
    assert 3 in got and 16 not in got and 17 not in got and 19 in got


def test_stages_keep_columns_and_take_empty_tables(spark, tmp_path):
    import corpus_pipeline

    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, _row string, kept boolean"
    docs = spark.createDataFrame([], schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert near_dedup.near_duplicates(docs).count() == 0
