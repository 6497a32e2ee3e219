from collections import defaultdict

import pytest
from llm_cases import awkward, empty, key, prose

from celltide.llm.components import components
from celltide.llm.minhash import near_duplicates


def shingles(text, k=4):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) or frozenset([tuple(words)])


def brute(rows, percent=80):
    """(n_shingles, component) of each row; rows of one id are one node."""
    sets = [(d, shingles(t)) for d, t in rows]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                a_, b_ = sorted((find(a), find(b)))
                parent[b_] = a_
    return [(d, len(x), None if d is None else find(d) if x else d) for d, x in sets]


def near_copies(seed, n):
    """A chain of texts that each differ a little from the last, and copies of one text with one word changed."""
    import random

    r = random.Random(seed)
    base = [f"w{r.randrange(5000)}" for _ in range(120)]
    out, chain = [], list(base)
    for _ in range(n):
        chain[r.randrange(120)] = f"c{r.randrange(10**6)}"
        out.append(" ".join(chain))
        one = list(base)
        for _ in range(r.randrange(1, 7)):
            one[r.randrange(120)] = f"o{r.randrange(10**6)}"
        out.append(" ".join(one))
    return out


@pytest.mark.parametrize("tile", [512, 4])
def test_against_brute_force(spark, tile):
    texts = [*prose(11, 25), *near_copies(1, 30), *near_copies(2, 8), "One Two three", "one two THREE", "É two three", "é two three", "a b c d", "a b c d e"]
    docs = awkward(spark, texts)
    # one id with two texts joins what they are near to
    docs = docs.unionByName(docs.filter("doc_id = 30").selectExpr("5 as doc_id", *[c for c in docs.columns if c != "doc_id"]))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = near_duplicates(docs, tile=tile).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(brute(rows), key=key)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_empty_table(spark):
    assert near_duplicates(empty(spark)).collect() == []


def test_components(spark):
    import random

    r = random.Random(4)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(500 + i, 501 + i) for i in range(60)] + [(700, 701 + i) for i in range(40)] + [(9, 9)]
    near = defaultdict(set)
    for a, b in pairs:
        near[a].add(b)
        near[b].add(a)
    want, seen = {}, set()
    for start in sorted(near):
        stack = [start]
        while stack:
            x = stack.pop()
            if x not in seen:
                seen.add(x)
                want[x] = start
                stack += near[x]
    want = {x: c for x, c in want.items() if near[x] != {x}}
    got = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_words_with_one_polynomial_hash(spark):
    words = ["".join("ab"[(i.bit_count() + x) & 1] for i in range(1024)) for x in (0, 1)]
    rows = [(1, words[0]), (2, words[1]), (3, f"x {words[0]} y"), (4, f"x {words[1]} y"), (5, f"x {words[1]} y")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 4)]


def test_long_texts_and_a_large_class(spark):
    """Texts of 300 kB, near copies of each other; a third of all rows have one text, and as many differ from it by a word."""
    import random

    r = random.Random(3)
    words = [f"w{r.randrange(3000)}" for _ in range(60_000)]
    near, far = list(words), list(words)
    near[100:200] = [f"n{i}" for i in range(100)]
    far[::3] = [f"f{i}" for i in range(20_000)]
    texts = [" ".join(words), " ".join(near), " ".join(far), "x" * 150_000, "x" * 150_000 + " y"]
    common = [f"c{i}" for i in range(80)]
    texts += [" ".join(common)] * 60 + [" ".join([*common[:i % 80], f"d{i}", *common[i % 80 + 1:]]) for i in range(60)] + [" ".join(f"o{r.randrange(10**6)}" for _ in range(30)) for _ in range(60)]
    rows = list(enumerate(texts))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in got) == sorted(brute(rows))


def test_one_centre_of_very_many(spark):
    edges = [(i, 0) for i in range(1, 3000)] + [(i, i - 1) for i in range(3001, 3050)] + [(5000, 2999)]
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys([*range(3000), 5000], 0), **dict.fromkeys(range(3000, 3050), 3000)}
