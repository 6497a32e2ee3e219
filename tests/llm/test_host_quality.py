import random

from llm_cases import awkward, empty, key, prose
from pyspark.sql import functions as F

from celltide.llm import host_quality
from celltide.llm.host_quality import BASE_RULES, HOST_RULES, VERDICT, host_verdicts, keep_good, measured, quality_rules

SPACES = " \t\n\x0b\x0c\r"


def measures(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    tri = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, t in enumerate(tri) if tri.count(t) > 1 for k in range(3)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines)}


def brute(rows):
    """``rows``: (doc_id, source, text)."""
    ratio = lambda rule, m: tuple(eval(x, {}, m) for x in rule)
    found = [(d, s, m, {r: ratio(rule, m) for r, rule in HOST_RULES.items()}) for d, s, m in ((d, s, measures(t)) for d, s, t in rows)]
    hosts = sorted({s for _, s, _, _ in found if s is not None})
    lift = {}
    for r in HOST_RULES:
        n = {h: sum(s == h for _, s, _, _ in found) for h in hosts}
        f = {h: sum(s == h and b[r][0] > b[r][1] for _, s, _, b in found) for h in hosts}
        rates = [f[h] / n[h] for h in hosts]
        mean = sum(rates) / max(len(rates), 1)
        var = sum((x - mean) ** 2 for x in rates) / max(len(rates), 1)
        strength = max(0, mean * (1 - mean) / var - 1) if var > 0 else sum(n.values())
        lift |= {(h, r): round((f[h] + mean * strength) / (n[h] + strength) / mean, 9) if mean else 1 for h in hosts}
    out = []
    for d, s, m, b in found:
        failed = any(a > b for a, b in (ratio(rule, m) for rule in BASE_RULES.values()))
        far = any(x > limit and x * lift.get((s, r), 0) > VERDICT * limit for r, (x, limit) in b.items())
        out.append((d, *(m[k] for k in host_quality.MEASURES[:-1]), failed, not failed and not far))
    return out


def texts(seed):
    r = random.Random(seed)
    out = prose(seed, 25)
    out += [" ".join(["spam and eggs"] * 40), "line one\n" * 80, "a b c a b c " * 3, "x " * 60, "| # * " * 50 + "é" * 9]
    out += [" ".join(f"v{r.randrange(10**6)}" for _ in range(70)) + " # * | $" * 12 for _ in range(8)]
    return out


def test_against_brute_force(spark):
    docs = awkward(spark, texts(1))
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    assert sorted(map(tuple, quality_rules(docs).collect()), key=key) == sorted(brute(rows), key=key)


def test_host_verdicts(spark):
    """Texts full of symbols are rejected on a host that is full of them, and stay on one that is not; plain ones stay anywhere."""
    r = random.Random(2)
    plain = lambda: " ".join(f"v{r.randrange(10**6)}" for _ in range(80))
    marked = lambda: plain() + " #*|$" * 15
    rows = [(i, "bad" if i % 2 else f"good{i % 6}", marked() if i % 2 and i > 20 or i == 50 else plain()) for i in range(200)]
    docs = spark.createDataFrame([(a, c, b) for a, b, c in rows], "doc_id long, text string, source string")
    got = {r.doc_id: r.kept for r in quality_rules(docs).collect()}
    assert got == {d: not ("#" in t and s == "bad") for d, s, t in rows}
    assert sorted(map(tuple, quality_rules(docs).collect()), key=key) == sorted(brute(rows), key=key)


def test_verdict_weighs_the_excess_by_the_host(spark):
    """Hosts that break a rule alike have lift 1: there a document goes when it is twice over the limit; a small host is shrunk."""
    r = random.Random(4)
    plain = lambda: " ".join(f"v{r.randrange(10**6)}" for _ in range(100))
    rows = [(i, f"h{i % 4}", plain() + (" " + "#" * (60 if i // 4 % 10 == 0 else 150) if i // 4 % 5 == 0 else "")) for i in range(400)]
    docs = spark.createDataFrame([(a, c, b) for a, b, c in rows], "doc_id long, text string, source string")
    got = {x.doc_id: x.kept for x in quality_rules(docs).collect()}
    assert got == {d: t.count("#") != 150 for d, _, t in rows}
    assert sorted(map(tuple, quality_rules(docs).collect()), key=key) == sorted(brute(rows), key=key)
    # one document of a new host that breaks the rule says little of it; a host with many says more
    few = rows + [(1000, "one", plain() + " " + "#" * 60)] + [(2000 + i, "many", plain() + " " + "#" * 60) for i in range(60)]
    table = spark.createDataFrame([(a, c, b) for a, b, c in few], "doc_id long, text string, source string")
    found = measured(table.select(F.struct("source").alias("row"), "text")).select("row.*", *host_quality.MEASURES)
    lift = {x.host: x.symbols_lift for x in host_verdicts(found).collect()}
    assert lift["h0"] < 1 < lift["one"] < lift["many"]
    assert sorted(map(tuple, quality_rules(table).collect()), key=key) == sorted(brute(few), key=key)


def test_stage_keeps_rows_and_columns(spark):
    docs = awkward(spark, texts(3))
    kept = [tuple(x) for x in brute([(r.doc_id, r.source, r.text) for r in docs.collect()]) if x[-1]]
    got = keep_good(docs)
    assert got.columns == docs.columns and sorted(str(r.doc_id) for r in got.collect()) == sorted(str(x[0]) for x in kept)


def test_empty_table(spark):
    assert quality_rules(empty(spark)).collect() == [] and keep_good(empty(spark)).collect() == []


def test_a_long_text(spark):
    """A text of 600 kB, with a passage that comes twice and lines that repeat."""
    r = random.Random(8)
    words = [f"w{r.randrange(10**9)}" for _ in range(50_000)]
    text = " ".join(words) + "\n" + " ".join(words[:1000]) + "\n# line\n" + "# line\n" * 2
    (row,) = quality_rules(spark.createDataFrame([(1, "s", text)], "doc_id long, source string, text string")).collect()
    assert (row.n_words, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == (51_006, 3, 2, 2000 + 6)
    assert not row.base_failed and row.kept
