import random
import re

import pytest
from llm_cases import awkward, empty, key, prose

from celltide.llm.decontaminate import decontaminate, find_contamination

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))


def brute(docs, items, window=10):
    """(doc_id, n_words, hit positions, item ids) of each row."""
    known = {}
    for item, text in items:
        words = words_of(text)
        k = min(len(words), window)
        for i in range(len(words) - k + 1 if k else 0):
            known.setdefault(tuple(words[i:i + k]), set()).add(str(item) if item is not None else "")
    lengths = {len(w) for w in known}
    out = []
    for doc, text in docs:
        words, hit, ids = words_of(text), set(), set()
        for k in lengths:
            for i in range(len(words) - k + 1):
                if (w := tuple(words[i:i + k])) in known:
                    hit |= set(range(i, i + k))
                    ids |= known[w]
        out.append((doc, len(words), sorted(hit), sorted(ids)))
    return out


def digest(row):
    return row.doc_id, row.n_words, [p for s in row.spans for p in range(s.begin, s.end)], list(row.item_ids)


def contaminated(seed, n):
    r = random.Random(seed)
    items = [" ".join(r.choice(["Alpha", "beta", "gamma9", "dél", "É", "zeta"]) + r.choice(["", "", ",", "!"]) for _ in range(r.choice([1, 2, 3, 9, 10, 11, 15, 30]))) for _ in range(25)]
    texts = prose(seed, n)
    for i in range(0, len(texts), 2):
        item = r.choice(items).split()
        a = r.randrange(len(item))
        texts[i] += r.choice(["\n", " - ", "..."]) + r.choice([" ", "-", "\t"]).join(item[a:] if i % 4 else item).swapcase() + " end"
    return texts, [*enumerate(items), (3, items[5]), (None, items[7]), (99, None), (98, ""), (97, " .. "), (5, items[5])]


@pytest.mark.parametrize("set_bytes", [48 << 20, 900])
def test_against_brute_force(spark, set_bytes):
    texts, items = contaminated(3, 30)
    docs = awkward(spark, [*texts, items[0][1], "x" + items[12][1]])
    benchmark = spark.createDataFrame([(*x, "clash", "clash") for x in items], "item_id long, text string, tag string, hash string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = find_contamination(docs, benchmark, set_bytes=set_bytes).collect()
    want = brute(rows, items)
    assert sorted(map(digest, got), key=key) == sorted(want, key=key)
    assert all(r.contaminated == (r.n_hit > 0) and r.n_hit == len(digest(r)[2]) and r.n_items == len(r.item_ids) for r in got)
    assert any(len(x[3]) > 1 for x in want) and any(not x[3] for x in want)
    assert all(a.end < b.begin for r in got for a, b in zip(r.spans, r.spans[1:]))


def test_removing_spans_and_documents(spark):
    item = "one two three four five six seven eight nine ten"
    docs = awkward(spark, [f"Before, {item.upper()}! after  this", item, "Nothing\n\nhere ", f"a {item} b {item}."])
    benchmark = spark.createDataFrame([("q1", item)], "item_id string, text string")
    left = decontaminate(docs, benchmark)
    assert left.columns == docs.columns
    texts = {r.doc_id: r.text for r in left.filter("doc_id < 5").collect()}
    assert texts == {1: "Before, ! after  this", 2: "", 3: "Nothing\n\nhere ", 4: "a b ."}
    assert left.count() == docs.count()
    kept = decontaminate(docs, benchmark, remove="documents")
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - {1, 2, 4} | {None}
    with pytest.raises(ValueError):
        decontaminate(docs, benchmark, remove="lines")


def test_empty_tables(spark):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert find_contamination(empty(spark), benchmark).collect() == []
    rows = find_contamination(awkward(spark, ["some words"]), benchmark).collect()
    assert rows and not any(r.contaminated or r.n_items for r in rows)


def test_a_long_text_and_a_hot_passage(spark):
    """A text of 3 MB, and one passage in a third of all rows and in many items."""
    passage = " ".join(f"p{i}" for i in range(25))
    long = " ".join(f"w{i % 9973}" for i in range(500_000))
    texts = [f"{i} {passage} {i}" if i % 3 == 0 else f"clean {i}" for i in range(300)] + [f"{long} {passage} {long}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, f"{i}a {passage}") for i in range(60)], "item_id long, text string")
    got = {r.doc_id: r for r in find_contamination(docs, benchmark).collect()}
    assert {d for d, r in got.items() if r.contaminated} == {*range(0, 300, 3), 300}
    assert all((r.n_hit, r.n_items) == (25, 60) for r in got.values() if r.contaminated) and got[300].n_words == 1_000_025
