import math

import numpy as np
import pytest

from celltide.llm.topk import Lists, exact_top_k


def brute(rows, every, k, scale=256):
    best = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = tuple(math.floor(scale * y) for y in v)
        at = (i, len(x))
        best[at] = min(best.get(at, x), x)
    out = set()
    for (q, n), x in best.items():
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for (i, m), y in best.items() if m == n and i != q)
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("block", [7, 1000])
def test_against_brute_force(spark, block):
    r = np.random.default_rng(3)
    rows = [(i, [float(x) for x in r.normal(size=6) / 2]) for i in range(120)]
    rows += [(i + 200, rows[5][1]) for i in range(9)]  # ties
    rows += [rows[0], (10, [9.0] * 6), (None, [1.0] * 6), (300, None), (310, [1.0, None] * 3), (320, [float("nan")] * 6), (330, [float("inf")] + [0.0] * 5)]
    rows += [(400, [1.0, 2.0]), (401, [2.0, 1.0]), (410, [3.0, 1.0]), (500, [])]
    frame = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<double>, rank string, block string")
    got = {tuple(x) for x in exact_top_k(frame, every=10, block=block).collect()}
    assert got == brute(rows, 10, 5)


def test_scores_beyond_double_precision():
    lists = Lists(np.array([1, 2, 3]), np.array([[2**40, 1], [2**40, 2], [2**40, 0]]))
    (found,) = lists.search(np.array([9]), np.array([[2**15, 1]]), 2)
    assert list(found[1]) == [2, 1] and int(found[2][0]) == 2**55 + 2


def test_empty_table(spark):
    assert exact_top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_reading_stops_early_on_skewed_lists():
    """Few rows stand out: a small part of the lists is read, and few vectors are looked up."""
    r = np.random.default_rng(5)
    vectors = r.integers(-20, 20, (4000, 16))
    vectors[r.choice(4000, 40, replace=False)] += r.integers(200, 5000, (40, 16)) * r.choice([-1, 1], (40, 1))
    queries = r.integers(0, 50, (30, 16)) * r.choice([-1, 1], (30, 1))
    lists = Lists(np.arange(4000), vectors)
    found = {q: (list(ids), list(map(int, scores))) for q, ids, scores in lists.search(np.arange(10_000, 10_030), queries, 5)}
    for i, query in enumerate(queries):
        want = sorted((-int(v @ query), j) for j, v in enumerate(vectors))[:5]
        assert found[10_000 + i] == ([j for _, j in want], [-s for s, _ in want])
    assert lists.read < 0.25 * 30 * vectors.size and lists.scored <= 30 * 20


def test_search_with_ties_zeros_and_few_rows():
    r = np.random.default_rng(6)
    for n, d, k in ((0, 3, 2), (1, 1, 3), (5, 2, 5), (70, 3, 4), (200, 0, 3)):
        vectors, queries = r.integers(-2, 3, (n, d)), r.integers(-1, 2, (12, d))
        lists = Lists(np.arange(n) * 3, vectors)
        for q, ids, scores in lists.search(np.arange(12), queries, k, resolve=1):
            want = sorted((-int(v @ queries[q]), 3 * j) for j, v in enumerate(vectors) if 3 * j != q)[:k]
            assert (list(ids), list(map(int, scores))) == ([j for _, j in want], [-s for s, _ in want])
