"""Template mining (A9) against a plain Python version, with groups of any size and skew."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from celltide.operators.templates import ANY, mine_templates


def brute(rows, lead=1, max_values=10, max_templates=64, similarity=0.6):
    """(label, template) -> n for rows of (label, line)."""
    groups = defaultdict(Counter)
    for label, line in rows:
        tokens = tuple(ANY if any(c in "0123456789" for c in t) else t for t in (line or "").split()) or ("",)
        groups[label, len(tokens), tokens[:lead]][tokens] += 1
    out = Counter()
    for (label, size, _), found in groups.items():
        limit, first = max_values, True
        while first or (len(found) > max_templates and limit >= 1):
            wild = {i for i in range(lead, size) if len({t[i] for t in found} - {ANY}) > limit}
            wider = Counter()
            for t, n in found.items():
                wider[tuple(ANY if i in wild else x for i, x in enumerate(t))] += n
            found, first = wider, False
            limit = max(limit // 2, 1) if limit > 1 else 0
        leaders = []
        for t, n in sorted(found.items(), key=lambda x: (-x[1], x[0])):
            for i, (other, m) in enumerate(leaders):
                if sum(a == b != ANY for a, b in zip(other, t)) >= similarity * size:
                    leaders[i] = tuple(a if a == b else ANY for a, b in zip(other, t)), m + n
                    break
            else:
                leaders.append((t, n))
        for t, n in leaders:
            out[label, " ".join(t)] += n
    return out


def lines(seed, n):
    r = random.Random(seed)
    word = lambda k: "".join(r.choice("abcdefgh") for _ in range(k))
    shapes = [lambda: f"user {word(5)} logged in from /home/{word(4)}/x", lambda: f"link {r.choice(['top', 'left', 'right'])} clicked", lambda: f"retry {r.randrange(99)} of {r.randrange(9)}",
              lambda: f"state {word(1)} {word(1)} {word(1)} {word(1)}", lambda: " ".join(word(1) for _ in range(r.randrange(1, 7))), lambda: r.choice([None, "", "  ", "\tsame   line\n"])]
    return [(r.choice(["a", None]), r.choice(shapes)()) for _ in range(n)]


@pytest.mark.parametrize("parameters", [{}, {"lead": 2, "max_values": 3, "max_templates": 4}, {"max_templates": 20, "similarity": 0.3}, {"similarity": 1.1}])
def test_against_plain_python(spark, parameters):
    rows = lines(7, 1500)
    df = spark.createDataFrame(rows, "namespace string, msg string")
    got = {(r["namespace"], r["template"]): r["n"] for r in mine_templates(df, by=("namespace",), **parameters).collect()}
    assert got == brute(rows, **parameters) and sum(got.values()) == len(rows)


def test_variable_words_ids_and_paths(spark):
    rows = [(f"user {a}{b} opened /srv/{b}{a}/log",) for a in "abcdef" for b in "ghijkl"] + [("disk full",)] * 3
    got = {r["template"]: r["n"] for r in mine_templates(spark.createDataFrame(rows, "msg string")).collect()}
    assert got == {"user <*> opened <*>": 36, "disk full": 3}


def test_one_group_of_all_lines_is_never_collected(spark):
    """Every line in one group, with more templates than may be collected: the last step reads a bounded list."""
    df = spark.range(40_000).select(F.concat(F.lit("x "), *(F.concat(F.chr(97 + F.floor(F.col("id") / 9 ** i) % 9), F.lit(" ")) for i in range(5))).alias("msg"))
    got = mine_templates(df, max_values=10, max_templates=50).collect()
    assert [(r["template"], r["n"]) for r in got] == [("x <*> <*> <*> <*> <*>", 40_000)]


def test_empty(spark):
    assert mine_templates(spark.createDataFrame([], "msg string")).collect() == []
