import hashlib
import random

import pytest
from llm_cases import awkward, empty, key, prose

from celltide.llm.substring_dedup import substring_dedup


def brute(rows, window):
    """Rows in (doc_id) order; a row without an id meets only itself, rows of one id do not meet."""
    def windows(words):
        return [tuple(words[i:i + window]) for i in range(len(words) - window + 1)]

    split = [(d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, words in split:
        if d is not None:
            for w in windows(words):
                first[w] = min(first.get(w, d), d)
    out = []
    for d, words in split:
        keep, seen = [True] * len(words), set()
        for i, w in enumerate(windows(words)):
            if w in seen or (d is not None and first[w] < d):
                keep[i:i + window] = [False] * window
            seen.add(w)
        kept = [x for x, k in zip(words, keep) if k]
        out.append((d, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(), kept))
    return out


@pytest.mark.parametrize("window,gram,seed", [(20, 6, 1), (8, 3, 2)])
def test_against_brute_force(spark, window, gram, seed):
    repeated = " ".join(["again and again"] * 40)
    docs = awkward(spark, [*prose(seed, 40), repeated])
    got = substring_dedup(docs, window, gram, with_text=True).collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()], window)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=key) == sorted((x[:4] for x in want), key=key)
    kept = {(x[0], x[3]): x[4] for x in want}
    for r in got:
        assert r.kept_text.encode().split() == kept[r.doc_id, r.kept_sha256]
        assert sum(s.end - s.begin for s in r.removed) == r.n_removed


def test_untouched_text_is_unchanged_and_columns_are_carried(spark):
    docs = spark.createDataFrame([(1, "a  b\n\nc ", "x")], "doc_id long, text string, n_words string")
    row = substring_dedup(docs, with_text=True, carry=("n_words",)).first()
    assert (row.kept_text, row.rest.n_words, row.n_words) == ("a  b\n\nc ", "x", 3)


def test_empty_table(spark):
    assert substring_dedup(empty(spark)).collect() == []


def thue_morse_pairs(seed):
    """Texts that differ in one long word of two letters, whose complement a polynomial hash cannot tell apart."""
    r = random.Random(seed)
    rows = []
    for n in (1024, 2048, 512 * r.randrange(2, 9)):
        a, b = r.sample("abcdefgh", 2)
        word = ["".join(x[i.bit_count() & 1] for i in range(n)) for x in (a + b, b + a)]
        before, after = ([f"w{r.randrange(10**6)}" for _ in range(k)] for k in (10, 20))
        rows += [" ".join([*before, w, *after]) for w in word]
    return rows


def test_words_with_one_polynomial_hash(spark):
    texts = [*thue_morse_pairs(1), *thue_morse_pairs(2)]
    rows = list(enumerate(texts, 1))
    got = substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == [x[:4] for x in brute(rows, 20)]
    assert {r.doc_id: r.n_removed for r in got}[2] == 20


def test_hot_anchors_are_dealt_over_salts(spark, monkeypatch):
    """One passage in two thirds of all rows, once alike and once with different words around it; every anchor may be hot."""
    from celltide.llm import substring_dedup as module

    monkeypatch.setattr(module, "HOT", 3)
    monkeypatch.setattr(module, "SALTS", 5)
    r = random.Random(4)
    passage = [f"p{i}" for i in range(45)]
    texts = []
    for i in range(90):
        own = [f"w{r.randrange(400)}" for _ in range(60)]
        at = r.randrange(60)
        texts.append(" ".join(own[:at] + (passage[r.randrange(3):45 - r.randrange(3)] if i % 3 else []) + own[at:]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = substring_dedup(docs).collect()
    assert sorted((x.doc_id, x.n_words, x.n_removed, x.kept_sha256) for x in got) == sorted(x[:4] for x in brute(list(enumerate(texts)), 20))


def test_long_texts(spark):
    """Texts of 300 kB and more that share a passage, one of them a single line that repeats itself."""
    r = random.Random(6)
    words = [f"w{r.randrange(5000)}" for _ in range(60_000)]
    texts = [" ".join(words), " ".join(words[30_000:30_500]), " ".join(words[59_000:]) + "\n" + " ".join(f"v{i}" for i in range(50_000)), "again and " * 40_000, "x" * 200_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = substring_dedup(docs).collect()
    assert sorted((x.doc_id, x.n_words, x.n_removed, x.kept_sha256) for x in got) == sorted(x[:4] for x in brute(list(enumerate(texts)), 20))
