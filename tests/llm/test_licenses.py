import re

import duckdb
from llm_cases import awkward, empty, key, prose

from celltide.llm.licenses import ALL, ORACLE, SIBLINGS, TEMPLATES, TEXTS, scan_licenses


def grams(text):
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return words, {tuple(words[i:i + 2]) for i in range(len(words) - 1)}


def brute(text, threshold=0.8):
    text = text or ""
    segments = text.split("\n") + [p for p in re.split(r"\n[ \t\r]*\n\s*", text) if "\n" in p] + ([text] if re.search(r"\n[ \t\r]*\n", text) else [])
    known = {n: grams(t)[1] for n, t in TEMPLATES.items()}
    n = matches = 0
    best = None
    for words, own in map(grams, segments):
        n += bool(words)
        scored = [(-2.0 * len(own & t) / (len(own) + len(t)), name) for name, t in known.items()]
        scored = [x for x in scored if x[0] <= -threshold]
        matches += bool(scored)
        best = min([*scored, *([best] if best else [])], default=None)
    return n, matches, best and best[1], best and -best[0]


def test_against_brute_force(spark):
    mit, apache = TEMPLATES["MIT grant"], TEMPLATES["Apache-2.0 header"]
    wrapped = re.sub(r"(.{40}\S*) ", r"\1\n", mit)
    texts = [*prose(5, 10), "x y z\nLicensed under the Apache License, Version 2.0.\nmore", "RELEASED   under the *MIT* license!", "released under the MIT",
             f"A title\n\n{wrapped}\n\nand then code", wrapped, apache.replace("Unless", "Except"), apache[:200], f"{mit} {mit}", "licence " * 200, "One\n \nTwo"]
    docs = awkward(spark, texts)
    got = sorted((tuple(r) for r in scan_licenses(docs).collect()), key=key)
    assert got == sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=key)
    assert {x[3] for x in got} >= {"Apache-2.0 notice", "MIT notice", "MIT grant", "Apache-2.0 header"}


def test_empty_table(spark):
    assert scan_licenses(empty(spark)).collect() == []


def brute_running(text, threshold=0.8):
    """Segments as in ``brute``, and every window of each template's number of words over the whole text."""
    n, matches, name, dice = brute(text, threshold)
    words, _ = grams(text or "")
    best = [(-dice, name)] if name else []
    for name, t in TEMPLATES.items():
        size = len(grams(t)[0])
        for at in range(max(1, len(words) - size + 1) if len(words) > 1 else 0):
            own = set(zip(words[at:at + size], words[at + 1:at + size]))
            d = 2.0 * len(own & grams(t)[1]) / (len(own) + len(grams(t)[1]))
            if d >= threshold:
                best.append((-d, name))
    best = min(best, default=None)
    return n, max(matches, int(best is not None)), best and best[1], best and -best[0]


def test_notices_in_running_text(spark):
    mit, apache = TEMPLATES["MIT grant"], TEMPLATES["Apache-2.0 header"]
    header = "Copyright 2024\n\n" + apache.replace("You may", "\nYou may").replace(" Unless", "\n\nUnless").replace(" See the", "\n\nSee the") + "\n\n" + "some other words here. " * 60
    texts = ["Copyright 2024 Jane Doe. Released under the MIT License. All other rights reserved by the author.", header, f"{'a b c ' * 30}{mit} {'d e f ' * 30}",
             apache[:300], "x Licensed under the\nApache License,\n\nVersion 2.0. y", "the mit", "license of the MIT license of the", mit.replace("copies", "things") + " and so on", *prose(6, 5)]
    docs = awkward(spark, texts)
    got = sorted((tuple(r) for r in scan_licenses(docs, running=True).collect()), key=key)
    assert got == sorted(((r.doc_id, *brute_running(r.text)) for r in docs.collect()), key=key)
    assert {x[0]: x[3] for x in got if x[0] in (1, 2, 3, 5)} == {1: "MIT notice", 2: "Apache-2.0 header", 3: "MIT grant", 5: "Apache-2.0 notice"}


def test_siblings_are_told_apart(spark):
    """The best match names the licence itself, alone, as paragraphs and in running text."""
    known = ALL
    names = sorted(known)
    forms = [lambda t: t, lambda t: t.replace(": ", ":\n\n").replace(". ", ".\n\n"), lambda t: f"Some words go before. {t} Others come after it."]
    docs = awkward(spark, [form(known[n]) for form in forms for n in names])
    got = {r.doc_id: (r.license, r.dice) for r in scan_licenses(docs, known, running=True).collect()}
    assert [got[i + 1] for i in range(len(forms) * len(names))] == [(n, 1.0) for _ in forms for n in names]


def test_licence_files(spark):
    """A licence file is found by its text, with a title, a copyright line and more text after it, also wrapped and with a word changed."""
    wrap = lambda t: re.sub(r"(.{50}\S*) ", r"\1\n", t)
    files = {n: f"{n.split(' ')[0]} License\n\nCopyright (c) 2021 Jane Doe\n\n{wrap(t)}\n\n" + "and other words follow here " * 30 for n, t in TEXTS.items()}
    docs = awkward(spark, list(files.values()))
    got = {r.doc_id: r.license for r in scan_licenses(docs, ALL, running=True).collect()}
    assert [got[i + 1] for i in range(len(files))] == list(files)


def test_query_oracle_on_siblings_running_text_and_parts(spark):
    """The oracle says what the query gives where notices are no lines of their own, overlap, or are parts of others."""
    mit, apache = TEMPLATES["MIT grant"], TEMPLATES["Apache-2.0 header"]
    texts = [f"Some words. {t} More words." for t in SIBLINGS.values()] + [TEXTS["MIT text"][:700], TEXTS["BSD-2-Clause full text"], f"{mit}\n{apache}", f"x {mit} y {mit[:300]}", apache.replace(". ", ".\n\n"),
             "Released under the MIT License. Licensed under CC BY 4.0.", mit.replace("copies", "things"), "the mit license", *prose(9, 8), "a b", "a", *list(TEXTS.values())[:6]]
    docs = awkward(spark, texts)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas())
    want = [tuple(None if x != x else x for x in r) for r in con.execute(ORACLE).fetchall()]
    got = [tuple(r) for r in scan_licenses(docs, ALL, running=True).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert len({x[3] for x in got}) > 25


def test_a_long_text(spark):
    """A notice in the middle of a text of 400 kB, of one line and of many."""
    body = " ".join(f"w{i % 7919}" for i in range(60_000))
    docs = spark.createDataFrame([(1, f"{body} {TEMPLATES['GPL-3.0 notice']} {body}"), (2, (body + " ").replace("w77 ", "w77\n") + SIBLINGS["GPL-2.0 notice"]), (3, body)], "doc_id long, text string")
    assert {r.doc_id: r.license for r in scan_licenses(docs, ALL, running=True).collect()} == {1: "GPL-3.0 notice", 2: "GPL-2.0 notice", 3: None}
