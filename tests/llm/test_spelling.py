import random
import re
import zlib
from collections import Counter

import pytest
from llm_cases import awkward, empty, key, prose

from celltide.llm.queries import QUERIES
from celltide.llm.spelling import spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def near(a, b):
    """Whether one inserted, deleted or replaced code point makes ``b`` of ``a``."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs, letters=6, least=5, ratio=5, drop=0):
    counts = Counter()
    for doc, text in docs:
        for run in RUN.findall(text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if drop and h % drop == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= letters and c >= least}
    around = {w: [v for v in n if abs(len(v) - len(w)) < 2 and near(w, v)] for w in n}
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        if best and n[best] >= ratio * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(around[w]), n.get(form.get(w))))
    return out


def rows_of(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=key)


def variants(seed):
    """Texts with words of few letters, edits of edits of a few words, runs of one letter, and counts that tie."""
    r = random.Random(seed)
    words = ["aaaaaa", "aaaaaaa", "aaaaaaaa", "baaaaaa", "aabbaab", "aabaab", "Ünïcödé", "ünïcödé", "ÉTÉÉTÉ", "×÷×÷×÷", "letters", "xxxxxx" * 40, "xxxxxx" * 40 + "x"]
    for _ in range(120):
        w = list(r.choice(words))
        at = r.randrange(len(w))
        w[at:at + r.randrange(2)] = r.choice(["", "a", "b", "é", "zz"])
        words.append("".join(w))
    text = []
    for w in words:
        text += [r.choice([w, w.upper(), w.capitalize()]) for _ in range(r.choice([1, 4, 5, 6, 25, 30, 125, 625]))]
    r.shuffle(text)
    return [" ".join(text[i:i + 300]) + r.choice([".", "1x", ", "]) for i in range(0, len(text), 300)]


@pytest.mark.parametrize("parameters", [{"drop_one_in": 199}, {"drop_one_in": 3, "least_letters": 3, "least_count": 2, "ratio": 2}, {}])
def test_against_brute_force(spark, parameters):
    docs = awkward(spark, [*variants(1), *prose(2, 10)])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows, parameters.get("least_letters", 6), parameters.get("least_count", 5), parameters.get("ratio", 5), parameters.get("drop_one_in", 0))
    assert rows_of(spelling_variants(docs, **parameters)) == sorted(want, key=key)
    assert any(x[1] and x[2] != x[1] for x in want)  # chains of forms


def test_many_words_of_one_prefix(spark):
    """A trie whose upper nodes go through all partitions: prefixes are numbered alike across them."""
    r = random.Random(5)
    words = {"common" + "".join(r.choice("abc") for _ in range(7)) for _ in range(900)}
    docs = spark.createDataFrame([(i, " ".join([w] * r.choice([5, 5, 25, 130]))) for i, w in enumerate(sorted(words))], "doc_id long, text string")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rows_of(spelling_variants(docs))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == sorted(brute([(r.doc_id, r.text) for r in docs.collect()]), key=key)


def test_words_of_many_letters(spark):
    """Prefixes are never written out: two runs of 50,000 letters that differ by one."""
    word = "ab" * 25_000
    docs = spark.createDataFrame([(i, word if i % 6 else word + "c") for i in range(36)], "doc_id long, text string")
    assert [(len(w), len(f or ""), n, near) for w, f, _, n, near, _ in rows_of(spelling_variants(docs))] == [(50_000, 0, 30, 1), (50_001, 50_000, 6, 1)]


def test_query_on_the_given_tables(spark):
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet").collect()
    assert rows_of(QUERIES["op12_spelling_variants"](spark, path)) == sorted(brute([(r.doc_id, r.text) for r in docs], drop=199), key=key)


def test_empty_table(spark):
    assert spelling_variants(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        spelling_variants(empty(spark), ratio=1)
